"""Data-quality checks and repairs over the whole tables."""

from pyspark.sql import functions as F

from loanbook.operators import quality as Q
from loanbook.operators.balances import with_collected
from loanbook.plans.q_interest import half_up
from loanbook.plans.registry import query
from loanbook.plans.sqlviews import m
from loanbook.sources import tables as T


def base(spark, d):
    return T.collections(spark, d), T.loans(spark, d)


PEND = "(c.synced <> 'Y' OR c.synced IS NULL) AND c.origen = 'native' AND c.abono > 0"
BAL = """
 bal AS MATERIALIZED (SELECT l.*, montototal - coalesce(p, 0) AS saldo, montototal - coalesce(ps, 0) AS saldo_synced
  FROM loans l LEFT JOIN (SELECT id_cartera, sum(abono) AS p, sum(abono) FILTER (synced = 'Y') AS ps FROM cobros GROUP BY 1) ON id_cartera = legacy_cartera_id)"""
MIS = f"""
 mis AS MATERIALIZED (SELECT c_bpartner_id, legacy_cartera_id, count(*) AS cobros FROM cobros c JOIN bal ON legacy_cartera_id = c.id_cartera
  WHERE {PEND} AND saldo <= 0 GROUP BY 1, 2)"""
ONPAID = f"""
 onpaid AS MATERIALIZED (SELECT l.c_bpartner_id, l.legacy_cartera_id, count(*) AS cobros FROM cobros c JOIN loans l ON l.legacy_cartera_id = c.id_cartera
  JOIN invoices i ON i.c_invoice_id = l.local_id WHERE {PEND} AND i.ispaid = 'Y' GROUP BY 1, 2)"""


@query("dq_misassigned", f"WITH {BAL}, {MIS} SELECT c_bpartner_id, nombre, legacy_cartera_id, cobros FROM mis JOIN partners USING (c_bpartner_id)")
def dq_misassigned(spark, d):
    return Q.misassigned(*base(spark, d), T.partners(spark, d))


@query("dq_on_paid_invoice", f"WITH {ONPAID} SELECT c_bpartner_id, nombre, legacy_cartera_id, cobros FROM onpaid JOIN partners USING (c_bpartner_id)")
def dq_on_paid_invoice(spark, d):
    return Q.on_paid_invoice(*base(spark, d), T.invoices(spark, d), T.partners(spark, d))


def oldest(problem, since="true"):
    return f"""
 old AS (SELECT c_bpartner_id, legacy_cartera_id AS nueva FROM (SELECT *, row_number() OVER (PARTITION BY c_bpartner_id ORDER BY fecha, legacy_cartera_id) AS rn
  FROM bal WHERE saldo > 0 AND {since}) WHERE rn = 1),
 rep AS MATERIALIZED (SELECT c_bpartner_id, nueva FROM (SELECT DISTINCT c_bpartner_id FROM {problem}) LEFT JOIN old USING (c_bpartner_id))"""


MOVES = """SELECT legacy_cobro_id, rep.c_bpartner_id, c.id_cartera AS old_cartera, nueva AS id_cartera
FROM cobros c JOIN loans l ON l.legacy_cartera_id = c.id_cartera JOIN rep ON rep.c_bpartner_id = l.c_bpartner_id WHERE c.synced = 'N' AND nueva IS NOT NULL"""
REPORT = "SELECT c_bpartner_id, nueva AS nueva_cartera, CASE WHEN nueva IS NULL THEN 'NO' ELSE 'YES' END AS corregible FROM rep"


def _oldest(spark, d):
    c, ln = base(spark, d)
    return Q.reassign_oldest(Q.misassigned(c, ln, T.partners(spark, d)), c, ln)


def _recent(spark, d):
    c, ln = base(spark, d)
    return Q.reassign_oldest(Q.on_paid_invoice(c, ln, T.invoices(spark, d), T.partners(spark, d)), c, ln, "1999-01-01")


@query("dq_reassign_oldest", f"WITH {BAL}, {MIS}, {oldest('mis')} {MOVES}")
def dq_reassign_oldest(spark, d):
    return _oldest(spark, d)["moves"]


@query("dq_reassign_oldest_report", f"WITH {BAL}, {MIS}, {oldest('mis')} {REPORT}")
def dq_reassign_oldest_report(spark, d):
    return _oldest(spark, d)["report"]


SINCE = "fecha >= DATE '1999-01-01'"


@query("dq_reassign_recent", f"WITH {BAL}, {ONPAID}, {oldest('onpaid', SINCE)} {MOVES}")
def dq_reassign_recent(spark, d):
    return _recent(spark, d)["moves"]


@query("dq_reassign_recent_report", f"WITH {BAL}, {ONPAID}, {oldest('onpaid', SINCE)} {REPORT}")
def dq_reassign_recent_report(spark, d):
    return _recent(spark, d)["report"]


# The walk as a recursion over the position of a collection within its partner.
FIRST_FIT = f"""
WITH {BAL},
 own AS (SELECT c.legacy_cobro_id, c.id_cartera, c.abono, c.operacion, b.c_bpartner_id, b.saldo_synced FROM cobros c JOIN bal b ON b.legacy_cartera_id = c.id_cartera
  WHERE {PEND}),
 prob AS (SELECT DISTINCT c_bpartner_id FROM own WHERE saldo_synced < 0),
 items AS MATERIALIZED (SELECT o.*, row_number() OVER (PARTITION BY c_bpartner_id ORDER BY operacion, md5(legacy_cobro_id), legacy_cobro_id) AS rn
  FROM own o JOIN prob USING (c_bpartner_id)),
 bins AS MATERIALIZED (SELECT c_bpartner_id, list(legacy_cartera_id ORDER BY fecha, md5(legacy_cartera_id::VARCHAR)) AS ids,
  list(CAST(saldo_synced AS DECIMAL(28,2)) ORDER BY fecha, md5(legacy_cartera_id::VARCHAR)) AS rooms
  FROM bal JOIN prob USING (c_bpartner_id) WHERE saldo_synced > 0 GROUP BY 1),
 walk AS (
  SELECT c_bpartner_id, ids, rooms, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS cobro, CAST(NULL AS BIGINT) AS old, CAST(0 AS BIGINT) AS pick FROM bins
  UNION ALL
  SELECT c_bpartner_id, ids, CASE WHEN p IS NULL THEN rooms ELSE list_concat(list_concat(rooms[1:p - 1], [CAST(rooms[p] - abono AS DECIMAL(28,2))]), rooms[p + 1:]) END,
   nrn, legacy_cobro_id, id_cartera, coalesce(p, 0)
  FROM (SELECT w.c_bpartner_id, w.ids, w.rooms, i.rn AS nrn, i.legacy_cobro_id, i.id_cartera, i.abono,
    nullif(coalesce(list_position(list_transform(w.rooms, lambda r: r > i.abono), true), 0), 0) AS p
   FROM walk w JOIN items i ON i.c_bpartner_id = w.c_bpartner_id AND i.rn = w.rn + 1))
SELECT c_bpartner_id, cobro AS legacy_cobro_id, old AS old_cartera, ids[pick] AS id_cartera FROM walk WHERE pick > 0"""


@query("dq_reassign_first_fit", FIRST_FIT, recursive=True)
def dq_reassign_first_fit(spark, d):
    return Q.reassign_first_fit(*base(spark, d))


OWN_FIT = FIRST_FIT.replace("FROM cobros GROUP BY", "FROM cobros_own GROUP BY").replace(
    "b.c_bpartner_id, b.saldo_synced FROM cobros c JOIN bal b", "c.c_bpartner_id, b.saldo_synced FROM cobros_own c LEFT JOIN bal b").replace(
    "WHERE saldo_synced < 0)", "WHERE saldo_synced < 0 OR id_cartera IS NULL)")


@query("dq_reassign_first_fit_owned", OWN_FIT, recursive=True)
def dq_reassign_first_fit_owned(spark, d):
    """Collections that carry their partner, some of them without a loan."""
    return Q.reassign_first_fit(T.partner_collections(spark, d), T.loans(spark, d))


OWN_MOVES = """SELECT legacy_cobro_id, rep.c_bpartner_id, c.id_cartera AS old_cartera, nueva AS id_cartera
FROM cobros_own c JOIN rep ON rep.c_bpartner_id = c.c_bpartner_id WHERE c.synced = 'N' AND nueva IS NOT NULL"""


@query("dq_reassign_oldest_owned", f"WITH {BAL}, {MIS}, {oldest('mis')} {OWN_MOVES}".replace("FROM cobros c JOIN bal", "FROM cobros_own c JOIN bal").replace(
    "FROM cobros GROUP BY", "FROM cobros_own GROUP BY").replace("SELECT c_bpartner_id, legacy_cartera_id, count(*) AS cobros", "SELECT bal.c_bpartner_id, legacy_cartera_id, count(*) AS cobros"))
def dq_reassign_oldest_owned(spark, d):
    c, ln = T.partner_collections(spark, d), T.loans(spark, d)
    return Q.reassign_oldest(Q.misassigned(c, ln, T.partners(spark, d)), c, ln)["moves"]


@query("dq_duplicate_allocations", "SELECT c_payment_id, c_invoice_id, count(*) AS lineas FROM alloc GROUP BY 1, 2 HAVING count(*) > 1")
def dq_duplicate_allocations(spark, d):
    return Q.duplicate_allocations(T.allocations(spark, d))


@query("dq_zero_duplicates", f"""
WITH dup AS (SELECT DISTINCT c_payment_id FROM (SELECT c_payment_id, c_invoice_id FROM alloc GROUP BY 1, 2 HAVING count(*) > 1)),
 x AS (SELECT a.*, row_number() OVER (PARTITION BY c_payment_id ORDER BY c_allocationline_id) > 1 AND c_payment_id IN (SELECT c_payment_id FROM dup) AS z FROM alloc a)
SELECT c_allocationline_id, c_payment_id, {m('CASE WHEN z THEN 0 ELSE amount END')} AS amount, z AS anulada FROM x""")
def dq_zero_duplicates(spark, d):
    return Q.zero_duplicates(T.allocations(spark, d)).select("c_allocationline_id", "c_payment_id", "amount", "anulada")


def _orphans(spark, d):
    return Q.orphan_receipts(T.with_lost(T.receipts(spark, d)), T.collections(spark, d), T.with_lost(T.allocations(spark, d)))


LOST = """lost AS MATERIALIZED (SELECT * FROM receipts_lost p WHERE c_doctype_id = 1000050 AND payamt <> 0
 AND NOT EXISTS (SELECT 1 FROM cobros c WHERE c.local_id = p.c_payment_id))"""


@query("dq_orphan_receipts", f"WITH {LOST} SELECT c_payment_id, {m('payamt')} AS payamt_previo, 0.0::DOUBLE AS payamt FROM lost")
def dq_orphan_receipts(spark, d):
    return _orphans(spark, d)["payments"]


@query("dq_orphan_receipt_lines", f"""
WITH {LOST} SELECT c_allocationline_id, {m('amount')} AS amount_previo, 0.0::DOUBLE AS amount FROM alloc_lost WHERE c_payment_id IN (SELECT c_payment_id FROM lost)""")
def dq_orphan_receipt_lines(spark, d):
    return _orphans(spark, d)["lines"]


UNVALID = f"""SELECT legacy_schedule_id, ref_invoice_id, CAST({half_up('CAST(valorinteres * 10000 AS HUGEINT)', '(dias_cre * 100)', 0)} AS DOUBLE) / 100 AS nuevo_monto
 FROM sched JOIN loans USING (legacy_cartera_id) WHERE ref_invoice_id IS NOT NULL AND (isvalid IS NULL OR isvalid <> 'Y')"""


@query("dq_unvalidated_schedule", UNVALID)
def dq_unvalidated_schedule(spark, d):
    return Q.unvalidated_schedule(T.schedule(spark, d), T.loans(spark, d))


@query("dq_allocation_cleanup", f"""
WITH tgt AS MATERIALIZED (SELECT DISTINCT ref_invoice_id AS c_invoice_id FROM ({UNVALID})),
 hit AS MATERIALIZED (SELECT DISTINCT c_allocationhdr_id, c_payment_id FROM alloc WHERE c_invoice_id IN (SELECT c_invoice_id FROM tgt))
SELECT 'cabecera' AS tipo, c_allocationhdr_id AS id FROM (SELECT DISTINCT c_allocationhdr_id FROM hit)
UNION ALL SELECT 'linea', c_allocationline_id FROM alloc WHERE c_allocationhdr_id IN (SELECT c_allocationhdr_id FROM hit)
UNION ALL SELECT 'linea vigente', c_allocationline_id FROM alloc WHERE c_allocationhdr_id NOT IN (SELECT c_allocationhdr_id FROM hit)
UNION ALL SELECT 'pago', c_payment_id FROM receipts WHERE c_payment_id IN (SELECT c_payment_id FROM hit)
UNION ALL SELECT 'factura', c_invoice_id::VARCHAR FROM invoices WHERE c_invoice_id IN (SELECT c_invoice_id FROM tgt)""")
def dq_allocation_cleanup(spark, d):
    target = Q.unvalidated_schedule(T.schedule(spark, d), T.loans(spark, d)).select(
        F.col("ref_invoice_id").alias("c_invoice_id"))
    out = Q.allocation_cleanup(target, T.allocations(spark, d), T.receipts(spark, d), T.invoices(spark, d))

    def tag(name, frame, column):
        return out[frame].select(F.lit(name).alias("tipo"), F.col(column).cast("string").alias("id"))

    return T.union_all([
        tag("cabecera", "drop_headers", "c_allocationhdr_id"), tag("linea", "drop_lines", "c_allocationline_id"),
        tag("linea vigente", "keep_lines", "c_allocationline_id"), tag("pago", "reopen_payments", "c_payment_id"),
        tag("factura", "reopen_invoices", "c_invoice_id")])


def _void(spark, d):
    c, _ = base(spark, d)
    large = c.filter(F.col("abono") > 60000).select("legacy_cobro_id")
    return Q.void_collections(c, T.receipts(spark, d), large)


@query("dq_void_collections", f"""
SELECT legacy_cobro_id, {m('CASE WHEN abono > 60000 THEN 0 ELSE abono END')} AS abono, abono > 60000 AS anulado FROM cobros""")
def dq_void_collections(spark, d):
    return _void(spark, d)["collections"].select("legacy_cobro_id", "abono", "anulado")


@query("dq_void_collections_payments", """
SELECT p.c_payment_id, p.docstatus, CASE p.docstatus WHEN 'CO' THEN 'revertido' WHEN 'DR' THEN 'eliminado' ELSE 'sin cambio' END AS accion
FROM receipts p JOIN cobros c ON c.local_id = p.c_payment_id WHERE c.abono > 60000""")
def dq_void_collections_payments(spark, d):
    return _void(spark, d)["payments"]


@query("dq_branch_subset", f"""
SELECT 'cartera' AS tabla, ad_org_id, count(*) AS n, {m('sum(montototal)')} AS monto FROM loans WHERE ad_org_id IN (1, 3) GROUP BY 1, 2
UNION ALL SELECT 'cobro', ad_org_id, count(*), {m('sum(abono)')} FROM cobros WHERE ad_org_id IN (1, 3) GROUP BY 1, 2
UNION ALL SELECT 'pago', ad_org_id, count(*), {m('sum(payamt)')} FROM pay WHERE ad_org_id IN (1, 3) GROUP BY 1, 2""")
def dq_branch_subset(spark, d):
    c, ln = base(spark, d)
    frames = {"cartera": ln.withColumn("v", F.col("montototal")), "cobro": c.withColumn("v", F.col("abono")),
              "pago": T.cash_payments(spark, d).withColumn("v", F.col("payamt"))}
    kept = Q.branch_subset(frames, [1, 3])
    return T.union_all([
        df.groupBy("ad_org_id").agg(F.count(F.lit(1)).alias("n"), F.sum("v").cast("decimal(28,2)").alias("monto"))
        .select(F.lit(name).alias("tabla"), "ad_org_id", "n", "monto") for name, df in kept.items()])




def _void_loans(spark, d):
    ln = with_collected(T.loans(spark, d), T.collections(spark, d)).withColumnRenamed("paid", "abono")
    paid = T.invoices(spark, d).select(F.col("c_invoice_id").alias("c_payment_id"), "docstatus")
    return Q.void_loans(ln, paid, ln.filter("legacy_cartera_id % 25 = 0"))


@query("dq_void_loans", f"""
SELECT legacy_cartera_id, {m('CASE WHEN legacy_cartera_id % 25 = 0 THEN 0 ELSE coalesce(p, 0) END')} AS abono, legacy_cartera_id % 25 = 0 AS anulado
FROM loans LEFT JOIN (SELECT id_cartera, sum(abono) AS p FROM cobros GROUP BY 1) x ON x.id_cartera = legacy_cartera_id""")
def dq_void_loans(spark, d):
    return _void_loans(spark, d)["loans"].select("legacy_cartera_id", "abono", "anulado")


@query("dq_void_loans_payments", """
SELECT local_id AS c_payment_id, CASE docstatus WHEN 'CO' THEN 'revertido' WHEN 'DR' THEN 'eliminado' ELSE 'sin cambio' END AS accion
FROM loans JOIN invoices ON c_invoice_id = local_id WHERE loans.legacy_cartera_id % 25 = 0""")
def dq_void_loans_payments(spark, d):
    return _void_loans(spark, d)["payments"]
