"""Payment splits and allocation over the whole tables."""

from pyspark.sql import functions as F

from loanbook.operators import payments as P
from loanbook.plans.registry import PERIOD, query
from loanbook.plans.sqlviews import m
from loanbook.sources import tables as T

TODAY = "1998-06-30"


def d4(expr):
    return m(expr, 4)


@query("pay_split_prorata", f"""
SELECT legacy_cobro_id, id_cartera, {d4('abono')} AS abono,
 {d4('abono * (1 - tasa)')} AS abono_principal, {d4('abono * tasa')} AS abono_interes
FROM cobros JOIN loans ON legacy_cartera_id = id_cartera""", digits=4)
def pay_split_prorata(spark, d):
    return P.split_prorata(T.loans(spark, d), T.collections(spark, d))


SPLIT = """SELECT c.legacy_cobro_id, c.id_cartera, c.operacion, c.abono,
  least(c.abono, greatest(l.monto - (h.hasta - c.abono), 0)) AS ap, greatest(l.monto - (h.hasta - c.abono), 0) AS room
 FROM cobros c JOIN loans l ON l.legacy_cartera_id = c.id_cartera
 JOIN (SELECT DISTINCT id_cartera, operacion, sum(abono) OVER (PARTITION BY id_cartera ORDER BY operacion
   RANGE UNBOUNDED PRECEDING) AS hasta FROM cobros) h
  ON h.id_cartera = c.id_cartera AND h.operacion = c.operacion
 WHERE c.abono > 0"""


@query("pay_split_principal_first", f"""
SELECT legacy_cobro_id, id_cartera, operacion, {m('abono')} AS abono, {m('ap')} AS abono_principal,
 {m('abono - ap')} AS abono_interes, {m('room')} AS saldo_principal_previo FROM ({SPLIT})""")
def pay_split_principal_first(spark, d):
    return P.split_principal_first(T.loans(spark, d), T.collections(spark, d))


DEBTS = """
 debts AS MATERIALIZED (SELECT c_invoice_id, c_bpartner_id, c_doctype_id, dateinvoiced, grandtotal - coalesce(a, 0) AS open
  FROM invoices LEFT JOIN (SELECT c_invoice_id, sum(amount) AS a FROM alloc WHERE isactive = 'Y' GROUP BY 1) USING (c_invoice_id)
  WHERE ispaid = 'N' AND docstatus = 'CO' AND issotrx = 'Y' AND grandtotal - coalesce(a, 0) > 0)"""
UNALLOC = f"""
 unalloc AS MATERIALIZED (SELECT p.* FROM receipts p WHERE c_doctype_id = 1000050 AND docstatus = 'CO' AND payamt > 0
  AND c_invoice_id IS NULL AND NOT EXISTS (SELECT 1 FROM alloc a WHERE a.c_payment_id = p.c_payment_id)
  AND substr(md5(p.c_payment_id),1,1) <> 'f'
  AND EXISTS (SELECT 1 FROM debts io WHERE io.c_bpartner_id = p.c_bpartner_id AND io.dateinvoiced <= p.dateacct))"""


def _debts(spark, d):
    return P.open_debts(T.invoices(spark, d), T.allocations(spark, d))


def _free_receipts(spark, d):
    """Completed receipts without invoice or allocation."""
    r = T.receipts(spark, d).filter("docstatus = 'CO' AND c_invoice_id IS NULL AND payamt > 0")
    return r.join(T.allocations(spark, d).select("c_payment_id").distinct(), "c_payment_id", "left_anti")


FREE = """
 free AS MATERIALIZED (SELECT p.* FROM receipts p WHERE docstatus = 'CO' AND payamt > 0 AND c_invoice_id IS NULL
  AND NOT EXISTS (SELECT 1 FROM alloc a WHERE a.c_payment_id = p.c_payment_id))"""


def _unallocated(spark, d, on_day=None):
    r = T.receipts(spark, d)
    omitted = r.filter(F.substring(F.md5("c_payment_id"), 1, 1) == "f").select(
        "c_payment_id", F.lit(TODAY).cast("date").alias("dateommited"))
    return P.unallocated(r, T.allocations(spark, d), _debts(spark, d), omitted, TODAY, on_day).select(
        "c_payment_id", "c_bpartner_id", "dateacct", "payamt", "ad_org_id")


FREE_ROWS = f"SELECT c_payment_id, c_bpartner_id, dateacct, {m('payamt')} AS payamt, ad_org_id FROM unalloc"


@query("pay_unallocated", f"WITH {DEBTS}, {UNALLOC} {FREE_ROWS}")
def pay_unallocated(spark, d):
    return _unallocated(spark, d)


@query("pay_unallocated_day", f"WITH {DEBTS}, {UNALLOC} {FREE_ROWS} WHERE datetrx = DATE '{TODAY}'")
def pay_unallocated_day(spark, d):
    """Those whose transaction is dated on one day, whatever their accounting date."""
    return _unallocated(spark, d, TODAY)


@query("pay_candidates", f"""
WITH {DEBTS}
SELECT c_invoice_id, c_bpartner_id, c_doctype_id, dateinvoiced, {d4('open')} AS open,
 CASE c_doctype_id WHEN 1000051 THEN 1 ELSE 2 END AS prioridad,
 row_number() OVER w AS posicion, {d4('sum(open) OVER w')} AS acumulado
FROM debts WINDOW w AS (PARTITION BY c_bpartner_id ORDER BY CASE c_doctype_id WHEN 1000051 THEN 1 ELSE 2 END,
 dateinvoiced, md5(c_invoice_id::VARCHAR) ROWS UNBOUNDED PRECEDING)""", digits=4)
def pay_candidates(spark, d):
    return P.debt_order(_debts(spark, d))


@query("pay_candidate_totals", f"""
WITH {DEBTS}, {FREE},
 cap AS (SELECT c_bpartner_id, count(*) AS n, sum(open) AS o FROM debts WHERE c_doctype_id = 1000048 GROUP BY 1),
 inte AS (SELECT c_payment_id, count(*) AS n, sum(open) AS o FROM free p JOIN debts d ON d.c_bpartner_id = p.c_bpartner_id
  AND d.c_doctype_id = 1000051 AND d.dateinvoiced <= p.dateacct GROUP BY 1)
SELECT p.c_payment_id, p.c_bpartner_id, p.dateacct, {d4('payamt')} AS payamt, coalesce(inte.n, 0) AS n_interes,
 {d4('coalesce(inte.o, 0)')} AS interes_abierto, coalesce(cap.n, 0) AS n_capital, {d4('coalesce(cap.o, 0)')} AS capital_abierto
FROM free p LEFT JOIN inte USING (c_payment_id) LEFT JOIN cap ON cap.c_bpartner_id = p.c_bpartner_id""", digits=4)
def pay_candidate_totals(spark, d):
    return P.candidate_totals(_free_receipts(spark, d), _debts(spark, d))


@query("pay_omitted", f"""
WITH {DEBTS}, {FREE}
SELECT c_payment_id, c_bpartner_id, dateacct FROM free p WHERE NOT EXISTS (
 SELECT 1 FROM debts d WHERE d.c_bpartner_id = p.c_bpartner_id
  AND (d.c_doctype_id = 1000048 OR d.dateinvoiced <= p.dateacct))""")
def pay_omitted(spark, d):
    return P.omitted_payments(_free_receipts(spark, d), _debts(spark, d))


ALLOCATE = f"""
 {DEBTS}, {FREE},
 ev AS (SELECT c_bpartner_id, dateinvoiced AS dia, 0 AS kind, open AS amt, '' AS id, CAST(NULL AS VARCHAR) AS pid FROM debts WHERE c_doctype_id = 1000051
  UNION ALL SELECT c_bpartner_id, dateacct, 1, -payamt, md5(c_payment_id), c_payment_id FROM free),
 x AS (SELECT *, CAST(sum(amt) OVER (PARTITION BY c_bpartner_id ORDER BY dia, kind, id, pid ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,4)) AS x FROM ev),
 b AS (SELECT *, x - least(0, min(x) OVER (PARTITION BY c_bpartner_id ORDER BY dia, kind, id, pid ROWS UNBOUNDED PRECEDING)) AS backlog FROM x),
 paid AS (SELECT *, CASE WHEN kind = 1 THEN coalesce(lag(backlog) OVER (PARTITION BY c_bpartner_id ORDER BY dia, kind, id, pid), 0) - backlog
   END AS to_int FROM b),
 spans AS MATERIALIZED (
  SELECT c_bpartner_id, pid, 1000051 AS kind, sum(to_int) OVER w - to_int AS a, sum(to_int) OVER w AS z FROM paid WHERE kind = 1
   WINDOW w AS (PARTITION BY c_bpartner_id ORDER BY dia, id, pid ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT c_bpartner_id, pid, 1000048, sum(-amt - to_int) OVER w - (-amt - to_int), sum(-amt - to_int) OVER w FROM paid WHERE kind = 1
   WINDOW w AS (PARTITION BY c_bpartner_id ORDER BY dia, id, pid ROWS UNBOUNDED PRECEDING)),
 owed AS MATERIALIZED (SELECT c_bpartner_id, c_invoice_id, c_doctype_id, sum(open) OVER w - open AS a, sum(open) OVER w AS z FROM debts
  WINDOW w AS (PARTITION BY c_bpartner_id, c_doctype_id ORDER BY dateinvoiced, md5(c_invoice_id::VARCHAR) ROWS UNBOUNDED PRECEDING))"""


@query("pay_allocate", f"""
WITH {ALLOCATE}
SELECT s.pid AS c_payment_id, o.c_invoice_id, s.c_bpartner_id, o.c_doctype_id, {d4('least(s.z, o.z) - greatest(s.a, o.a)')} AS amount
FROM spans s JOIN owed o ON o.c_bpartner_id = s.c_bpartner_id AND o.c_doctype_id = s.kind AND s.a < o.z AND o.a < s.z
WHERE least(s.z, o.z) > greatest(s.a, o.a)""", digits=4)
def pay_allocate(spark, d):
    return P.allocate(_free_receipts(spark, d), _debts(spark, d))


@query("pay_allocated_by_type", f"""
WITH sets AS (SELECT legacy_cartera_id, local_id AS c_invoice_id, 1000048 AS c_doctype_id FROM loans WHERE local_id IS NOT NULL
 UNION ALL SELECT legacy_cartera_id, ref_invoice_id, 1000051 FROM sched WHERE ref_invoice_id IS NOT NULL AND processed = 'Y')
SELECT c_payment_id, legacy_cartera_id, c_doctype_id, {m('sum(amount)')} AS monto_asignado
FROM alloc JOIN sets USING (c_invoice_id) WHERE isactive = 'Y' GROUP BY 1, 2, 3""")
def pay_allocated_by_type(spark, d):
    return P.allocated_by_type(T.loans(spark, d), T.schedule(spark, d), T.allocations(spark, d))


@query("pay_mark_paid", f"""
SELECT c_invoice_id, {d4('grandtotal - coalesce(a, 0)')} AS open, 'N' AS ispaid FROM invoices
LEFT JOIN (SELECT c_invoice_id, sum(amount) AS a FROM alloc WHERE isactive = 'Y' GROUP BY 1) USING (c_invoice_id)
WHERE ispaid = 'Y' AND dateinvoiced >= DATE '{PERIOD[0]}' AND grandtotal - coalesce(a, 0) > 0""", digits=4)
def pay_mark_paid(spark, d):
    return P.wrongly_paid(T.invoices(spark, d), T.allocations(spark, d), PERIOD[0])
