"""Interest, schedules and accruals over the whole loan table."""

from pyspark.sql import functions as F

from loanbook.functions.scalars import dec
from loanbook.operators import balances as B
from loanbook.operators import interest as I
from loanbook.plans.q_balances import PAID
from loanbook.plans.registry import AS_OF, PERIOD, query
from loanbook.plans.sqlviews import m
from loanbook.sources import tables as T

BILL_DAY = "1998-07-01"


def d4(expr):
    return m(expr, 4)


def div(num, den, digits):
    """num / den, rounded half up at a number of digits, for non-negative decimal num."""
    k = 10 ** digits
    return (f"(CAST((2 * CAST(({num}) * {k} AS HUGEINT) + ({den})) // (2 * ({den})) AS DECIMAL(24,0))"
            f" * CAST({1 / k:.{digits}f} AS DECIMAL({digits + 1},{digits})))")


@query("int_total_360", f"""
SELECT legacy_cartera_id, {d4('valorinteres')} AS valorinteres, {d4('monto + valorinteres')} AS montototal,
 CAST({div('monto + valorinteres', 'dias_cre', 4)} AS DOUBLE) AS cuota FROM loans""", digits=4)
def int_total_360(spark, d):
    return I.total_360(T.loans(spark, d)).select(
        "legacy_cartera_id", "valorinteres", "montototal", "cuota")


def rate_sql(source: str, key: str, principal: str, interest: str, n: str) -> str:
    """CTEs 'trial' and 'rates': bisection as a recursion over (key, step)."""
    total = ("(b - p0 + (n0 - 1) * q0 + mid::DOUBLE * b)")
    f = ("(p0 * pow(1 + mid::DOUBLE, n0 - 1) - q0 * (pow(1 + mid::DOUBLE, n0 - 1) - 1) / mid::DOUBLE)")
    miss = f"({f} - p0 + (n0 - 1) * q0 + mid::DOUBLE * {f} - i0)"
    mid = "CAST(round((lo2 + hi2) * CAST(0.5 AS DECIMAL(2,1)), 10) AS DECIMAL(12,10))"
    del total
    return f"""
 start AS MATERIALIZED (SELECT {key} AS k, CAST({principal} AS DOUBLE) AS p0, CAST({interest} AS DOUBLE) AS i0,
   CAST({n} AS DOUBLE) AS n0, CAST({div(f'CAST({principal} AS DECIMAL(30,14)) + {interest}', n, 10)} AS DOUBLE) AS q0
  FROM {source} WHERE {principal} > 0 AND {interest} > 0 AND {n} > 0),
 trial AS (
  SELECT k, p0, i0, n0, q0, CAST(0.001 AS DECIMAL(12,10)) AS lo, CAST(0.020 AS DECIMAL(12,10)) AS hi,
   CAST(0.0105 AS DECIMAL(12,10)) AS mid, 1 AS step FROM start
  UNION ALL
  SELECT k, p0, i0, n0, q0, lo2, hi2, {mid}, step + 1 FROM (
   SELECT *, CASE WHEN miss < 0 THEN mid ELSE lo END AS lo2, CASE WHEN miss < 0 THEN hi ELSE mid END AS hi2
   FROM (SELECT *, {miss} AS miss FROM trial) WHERE abs(miss) >= 0.0001 AND step <= 40)),
 rates AS MATERIALIZED (SELECT k, arg_max(mid, step) AS rate FROM trial GROUP BY k)"""


LOAN_RATES = rate_sql("loans", "legacy_cartera_id", "monto", "(montototal - monto)", "dias_cre")


@query("int_hidden_rate", f"""
WITH {LOAN_RATES}
SELECT legacy_cartera_id, CAST(coalesce(rate, 0) AS DOUBLE) AS tasa_oculta,
 coalesce(rate, 0) >= CAST(0.01999999 AS DECIMAL(12,10)) OR coalesce(rate, 0) <= CAST(0.00100001 AS DECIMAL(12,10)) AS rate_clamped
FROM loans LEFT JOIN rates ON k = legacy_cartera_id""", digits=10, recursive=True)
def int_hidden_rate(spark, d):
    return I.with_hidden_rate(T.loans(spark, d)).select(
        "legacy_cartera_id", "tasa_oculta", "rate_clamped")


def fold_sql(source: str, guarded: bool, digits: int = 4) -> str:
    """CTE 'plan' over source(k, principal, rate, level, n): the row-by-row recurrence."""
    raw = f"CAST(round(bal * rate, {digits}) AS DECIMAL(18,4))"
    if guarded:
        int_mid = f"least(greatest({raw}, 0), level)"
        cap = (f"CASE WHEN seq = n THEN bal ELSE least(level - {int_mid}, bal) END")
        interest = f"CASE WHEN seq = n THEN {raw} ELSE {int_mid} END"
    else:
        interest, cap = raw, f"level - {raw}"
    return f"""
 walk AS (
  SELECT k, rate, level, n, 1 AS seq, CAST(principal AS DECIMAL(18,4)) AS bal FROM {source}
  UNION ALL
  SELECT k, rate, level, n, seq + 1, CAST(bal - ({cap}) AS DECIMAL(18,4)) FROM walk WHERE seq < n),
 plan AS (SELECT k, seq, {interest} AS interes, {cap} AS capital FROM walk)"""


def due_sql(first_offset: int = 0, columns: str = "") -> str:
    return f"""SELECT l.legacy_cartera_id, l.ad_org_id, l.local_id AS c_invoice_id, CAST(pl.seq AS INTEGER) AS seq,
 o.d AS duedate, {columns} FROM plan pl JOIN loans l ON l.legacy_cartera_id = pl.k
 JOIN cal c ON c.d = l.fecha + {first_offset} JOIN opendays o ON o.idx = c.idx + pl.seq"""


LEVEL4 = div("montototal", "dias_cre", 4)


INT_CAP = f"{d4('interes')} AS interes, {d4('capital')} AS capital"


@query("int_schedule_declining", f"""
WITH {LOAN_RATES},
 src AS (SELECT legacy_cartera_id AS k, monto AS principal, rate, CAST({LEVEL4} AS DECIMAL(18,4)) AS level, dias_cre AS n
  FROM loans JOIN rates ON k = legacy_cartera_id),
 {fold_sql('src', True)}
{due_sql(0, INT_CAP)}""", digits=4, recursive=True)
def int_schedule_declining(spark, d):
    return I.schedule_declining(T.loans(spark, d))


@query("int_schedule_rate30", f"""
WITH src AS (SELECT legacy_cartera_id AS k, monto AS principal, CAST(0.005 AS DECIMAL(12,10)) AS rate,
  CAST({LEVEL4} AS DECIMAL(18,4)) AS level, dias_cre AS n FROM loans),
 {fold_sql('src', False)}
{due_sql(0, INT_CAP)}""", digits=4, recursive=True)
def int_schedule_rate30(spark, d):
    return I.schedule_rate30(T.loans(spark, d))


PMT = """CAST(round(CAST(0.000125 * CAST(monto AS DOUBLE) * pow(1.000125, dias_cre::DOUBLE)
  / (pow(1.000125, dias_cre::DOUBLE) - 1) AS DECIMAL(28,10)), 2) AS DECIMAL(18,4))"""


@query("int_pmt", f"SELECT legacy_cartera_id, CAST({PMT} AS DOUBLE) AS cuota_nivelada FROM loans")
def int_pmt(spark, d):
    period, _ = I.pmt_rates(F.col("tasa"))
    return T.loans(spark, d).select(
        "legacy_cartera_id",
        I.pmt(period, F.col("dias_cre"), F.col("monto")).alias("cuota_nivelada"))


@query("int_schedule_pmt", f"""
WITH src AS (SELECT legacy_cartera_id AS k, monto AS principal, CAST(0.005 AS DECIMAL(12,10)) AS rate,
  {PMT} AS level, dias_cre AS n FROM loans),
 {fold_sql('src', False, 2)}
SELECT l.legacy_cartera_id, l.ad_org_id, l.local_id AS c_invoice_id, CAST(pl.seq AS INTEGER) AS seq, CAST(l.fecha + pl.seq AS DATE) AS duedate,
 {INT_CAP} FROM plan pl JOIN loans l ON l.legacy_cartera_id = pl.k""", digits=4, recursive=True)
def int_schedule_pmt(spark, d):
    return I.schedule_pmt(T.loans(spark, d))


@query("int_schedule_flat", f"""
WITH plan AS (SELECT legacy_cartera_id AS k, unnest(range(1, dias_cre + 1)) AS seq,
  {div('valorinteres', 'dias_cre', 4)} AS dueamt FROM loans)
{due_sql(0, f"{d4('dueamt')} AS dueamt")}""", digits=4)
def int_schedule_flat(spark, d):
    return I.schedule_flat(T.loans(spark, d))


@query("int_schedule_level_total", f"""
WITH plan AS (SELECT legacy_cartera_id AS k, unnest(range(1, dias_cre + 1)) AS seq,
  {div('montototal', 'dias_cre', 10)} + {div('valorinteres', 'dias_cre', 10)} AS dueamt FROM loans)
{due_sql(1, f"{m('dueamt', 10)} AS dueamt")}""", digits=10)
def int_schedule_level_total(spark, d):
    return I.schedule_level_total(T.loans(spark, d))


OPEN_CAP = f"""open_cap AS MATERIALIZED (SELECT i.c_invoice_id, grandtotal - coalesce(a, 0) AS open FROM invoices i
 LEFT JOIN (SELECT c_invoice_id, sum(amount) AS a FROM alloc WHERE dateacct <= DATE '{BILL_DAY}' GROUP BY 1) USING (c_invoice_id)
 WHERE c_doctype_id = 1000048)"""

def half_up(num, den, digits):
    k = 10 ** digits
    return f"((2 * {num} * {k} + {den}) // (2 * {den}))"


# open / monto at 10 digits in whole numbers: both in units of a ten-thousandth.
SHARE = ("CAST(" + half_up("CAST(o.open * 10000 AS HUGEINT)", "CAST(l.monto * 10000 AS HUGEINT)", 10)
         + " AS DECIMAL(14,0)) * CAST(0.0000000001 AS DECIMAL(11,10))")
RECALC = f"""
 {OPEN_CAP},
 pend AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY legacy_cartera_id ORDER BY duedate, legacy_schedule_id) AS rn,
   count(*) OVER (PARTITION BY legacy_cartera_id) AS n FROM sched
  WHERE (processed IS NULL OR processed = 'N') AND isactive = 'Y' AND duedate >= DATE '{BILL_DAY}'),
 base AS MATERIALIZED (SELECT DISTINCT p.legacy_cartera_id, p.n, CAST(o.open AS DECIMAL(18,4)) AS open,
   CAST(l.valorinteres AS DECIMAL(20,4)) * CAST({SHARE} AS DECIMAL(14,10)) AS pint
  FROM pend p JOIN loans l USING (legacy_cartera_id) JOIN open_cap o ON o.c_invoice_id = l.local_id WHERE o.open > 0),
 {rate_sql('base', 'legacy_cartera_id', 'open', 'pint', 'n')},
 src AS (SELECT legacy_cartera_id AS k, open AS principal, coalesce(rate, 0) AS rate,
   CAST(CAST({half_up('CAST((CAST(open AS DECIMAL(32,14)) + pint) * 10000000000 AS HUGEINT)', '(n * 1000000)', 0)}
    AS DECIMAL(22,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS level, n FROM base LEFT JOIN rates ON k = legacy_cartera_id),
 {fold_sql('src', True)},
 recalc AS MATERIALIZED (SELECT legacy_cartera_id, legacy_schedule_id, duedate, dueamt AS dueamt_previo, interes AS dueamt
  FROM plan JOIN pend ON pend.legacy_cartera_id = plan.k AND pend.rn = plan.seq)"""


def _open_capital(spark, d):
    inv = T.invoices(spark, d).filter("c_doctype_id = 1000048")
    return B.invoice_open(inv, T.allocations(spark, d), BILL_DAY)


def _recalc(spark, d):
    return I.recalc_schedule(T.schedule(spark, d), T.loans(spark, d), _open_capital(spark, d), BILL_DAY)


@query("int_recalc_schedule", f"""
WITH {RECALC}
SELECT legacy_cartera_id, legacy_schedule_id, duedate, {d4('dueamt_previo')} AS dueamt_previo, {d4('dueamt')} AS dueamt
FROM recalc""", digits=4, recursive=True)
def int_recalc_schedule(spark, d):
    return _recalc(spark, d)


PENDING = "(processed IS NULL OR processed = 'N')"


@query("int_due_today", f"""
SELECT legacy_schedule_id, legacy_cartera_id, seq, duedate, {d4('dueamt')} AS dueamt FROM sched
WHERE duedate = DATE '{BILL_DAY}' AND {PENDING} AND isactive = 'Y'""", digits=4)
def int_due_today(spark, d):
    return I.due_on(T.schedule(spark, d), BILL_DAY).select(
        "legacy_schedule_id", "legacy_cartera_id", "seq", "duedate", "dueamt")


BILL = f"""s.legacy_schedule_id, s.legacy_cartera_id, i.c_bpartner_id, s.ad_org_id,
 1000051 AS c_doctype_id, DATE '{BILL_DAY}' AS dateinvoiced"""
BILL_FROM = f"""FROM sched s JOIN invoices i ON i.c_invoice_id = s.c_invoice_id
WHERE s.duedate = DATE '{BILL_DAY}' AND {PENDING} AND s.isactive = 'Y' AND NOT EXISTS (
 SELECT 1 FROM invoices b WHERE b.legacy_data = s.legacy_schedule_id AND b.docstatus IN ('CO', 'CL'))"""


@query("int_bill_daily_plain", f"SELECT {BILL}, {d4('s.dueamt')} AS grandtotal {BILL_FROM}", digits=4)
def int_bill_daily_plain(spark, d):
    return I.bill_daily(T.schedule(spark, d), T.invoices(spark, d), BILL_DAY)


@query("int_bill_daily", f"""
WITH {RECALC}
SELECT {BILL}, {d4('coalesce(r.dueamt, s.dueamt)')} AS grandtotal
{BILL_FROM.replace('WHERE s.duedate', 'LEFT JOIN recalc r ON r.legacy_schedule_id = s.legacy_schedule_id WHERE s.duedate', 1)}
""", digits=4, recursive=True)
def int_bill_daily(spark, d):
    sch = T.schedule(spark, d)
    due = I.due_on(sch, BILL_DAY).select("legacy_cartera_id").distinct()
    touched = sch.join(due, "legacy_cartera_id", "left_semi")
    again = I.recalc_schedule(touched, T.loans(spark, d), _open_capital(spark, d), BILL_DAY)
    return I.bill_daily(sch, T.invoices(spark, d), BILL_DAY, again)


# The model's rule for the id of an instalment's invoice.
def _new_id():
    return F.col("legacy_schedule_id") * 10 + 3


@query("int_bill_daily_updates", f"""
SELECT s.legacy_schedule_id, 'Y' AS processed, s.legacy_schedule_id * 10 + 3 AS ref_invoice_id, 'nueva' AS factura {BILL_FROM}
UNION ALL SELECT legacy_schedule_id, 'Y', NULL, 'existente' FROM sched s
WHERE s.duedate = DATE '{BILL_DAY}' AND {PENDING} AND s.isactive = 'Y' AND EXISTS (
 SELECT 1 FROM invoices b WHERE b.legacy_data = s.legacy_schedule_id AND b.docstatus IN ('CO', 'CL'))""")
def int_bill_daily_updates(spark, d):
    sch, inv = T.schedule(spark, d), T.invoices(spark, d)
    return I.billing_updates(I.due_on(sch, BILL_DAY), inv, I.bill_daily(sch, inv, BILL_DAY), _new_id())


DEBT = f"""
 fut AS (SELECT legacy_cartera_id, sum(dueamt) AS f FROM sched WHERE {PENDING} GROUP BY 1),
 bil AS (SELECT s.legacy_cartera_id, sum(i.grandtotal - coalesce(a, 0)) AS b
  FROM invoices i JOIN sched s ON i.legacy_data = s.legacy_schedule_id
  LEFT JOIN (SELECT c_invoice_id, sum(amount) AS a FROM alloc WHERE isactive = 'Y' GROUP BY 1) x ON x.c_invoice_id = i.c_invoice_id
  WHERE i.ispaid = 'N' AND i.docstatus = 'CO' GROUP BY 1),
 debt AS MATERIALIZED (SELECT legacy_cartera_id, coalesce(f, 0) AS futuro, coalesce(b, 0) AS facturado,
  coalesce(f, 0) + coalesce(b, 0) AS deuda FROM fut FULL JOIN bil USING (legacy_cartera_id))"""


@query("int_debt_total", f"""
WITH {DEBT}
SELECT legacy_cartera_id, {d4('futuro')} AS futuro, {d4('facturado')} AS facturado, {d4('deuda')} AS deuda FROM debt""",
       digits=4)
def int_debt_total(spark, d):
    return I.debt_total(T.schedule(spark, d), T.invoices(spark, d), T.allocations(spark, d))


PREPAID = f"""
 {DEBT},
 target AS (SELECT id_cartera, sum(abono) AS por_cubrir FROM cobros WHERE synced IS NULL OR synced = 'N'
  GROUP BY 1 HAVING sum(abono) > 0),
 judged AS MATERIALIZED (SELECT id_cartera AS legacy_cartera_id, por_cubrir, coalesce(deuda, 0) AS deuda
  FROM target LEFT JOIN debt ON legacy_cartera_id = id_cartera)"""


def _prepaid(spark, d, billed=None):
    return I.bill_prepaid(T.schedule(spark, d), T.invoices(spark, d), T.allocations(spark, d),
                          T.collections(spark, d), BILL_DAY, billed=billed)


@query("int_bill_prepaid", f"""
WITH {PREPAID},
 rows AS (SELECT s.*, por_cubrir, sum(s.dueamt) OVER (PARTITION BY s.legacy_cartera_id
   ORDER BY duedate, legacy_schedule_id) - s.dueamt AS antes
  FROM sched s JOIN judged j USING (legacy_cartera_id) WHERE {PENDING} AND j.deuda >= j.por_cubrir
  AND NOT EXISTS (SELECT 1 FROM invoices b WHERE b.legacy_data = s.legacy_schedule_id AND b.docstatus IN ('CO', 'CL')))
SELECT legacy_schedule_id, legacy_cartera_id, c_bpartner_id, ad_org_id, 1000051 AS c_doctype_id,
 DATE '{BILL_DAY}' AS dateinvoiced, {d4('dueamt')} AS grandtotal FROM rows WHERE antes < por_cubrir""", digits=4)
def int_bill_prepaid(spark, d):
    return _prepaid(spark, d)[0]


@query("int_bill_prepaid_updates", f"""
WITH {PREPAID},
 open AS (SELECT s.* FROM sched s JOIN judged j USING (legacy_cartera_id) WHERE {PENDING} AND j.deuda >= j.por_cubrir),
 known AS (SELECT DISTINCT legacy_data FROM invoices WHERE docstatus IN ('CO', 'CL')),
 rows AS (SELECT s.*, por_cubrir, sum(s.dueamt) OVER (PARTITION BY s.legacy_cartera_id
   ORDER BY duedate, legacy_schedule_id) - s.dueamt AS antes
  FROM open s JOIN judged j USING (legacy_cartera_id) WHERE legacy_schedule_id NOT IN (SELECT legacy_data FROM known WHERE legacy_data IS NOT NULL))
SELECT legacy_schedule_id, 'Y' AS processed, legacy_schedule_id * 10 + 3 AS ref_invoice_id, 'nueva' AS factura FROM rows WHERE antes < por_cubrir
UNION ALL SELECT legacy_schedule_id, 'Y', NULL, 'existente' FROM open JOIN known ON legacy_data = legacy_schedule_id""")
def int_bill_prepaid_updates(spark, d):
    sch, inv = T.schedule(spark, d), T.invoices(spark, d)
    billed = I.billed_instalments(sch, inv, T.allocations(spark, d))
    made, _, accepted = _prepaid(spark, d, billed)
    # Of the instalments looked at only those with an invoice matter here.
    looked = billed.filter("unbilled AND first").join(accepted, "legacy_cartera_id", "left_semi")
    return I.billing_updates(looked, inv, made, _new_id())


@query("int_bill_prepaid_rejects", f"""
WITH {PREPAID}
SELECT legacy_cartera_id, {d4('por_cubrir')} AS por_cubrir, {d4('deuda')} AS deuda FROM judged WHERE deuda < por_cubrir""",
       digits=4)
def int_bill_prepaid_rejects(spark, d):
    return _prepaid(spark, d)[1]


ELAPSED = f"""SELECT l.*, CASE WHEN l.fecha > DATE '{AS_OF}' THEN 0 ELSE least(e.idx - p.idx, dias_cre) END AS dd,
 coalesce(pd.p, 0) AS pagado FROM loans l JOIN cal p ON p.d = l.fecha - 1 JOIN cal e ON e.d = DATE '{AS_OF}'
 LEFT JOIN ({PAID}) pd ON pd.id_cartera = l.legacy_cartera_id"""


@query("int_accrual_full", f"""
SELECT legacy_cartera_id, {m('CASE WHEN montototal - pagado > 0 AND dd = 0 THEN 0 ELSE monto * tasa END')} AS interes
FROM ({ELAPSED})""")
def int_accrual_full(spark, d):
    return I.accrual_full(T.loans(spark, d), T.collections(spark, d), AS_OF)


@query("int_accrual_daily", f"""
SELECT legacy_cartera_id, {m('greatest(CAST(dd AS DECIMAL(6,0)) * CAST(cuota AS DECIMAL(16,4)) * CAST(tasa AS DECIMAL(10,4)), CAST(CAST(pagado AS DECIMAL(18,2)) * tasa AS DECIMAL(30,8)))')} AS interes
FROM ({ELAPSED})""")
def int_accrual_daily(spark, d):
    return I.accrual_daily(T.loans(spark, d), T.collections(spark, d), AS_OF)


# monto x 0.15 x days / n in units of 1e-4, then rounded half up at 2 digits.
LINEAR = "CAST(((2 * CAST(monto * 100 AS HUGEINT) * 15 * dd + 100 * dias_cre) // (200 * dias_cre)) AS DOUBLE) / 100"


@query("int_accrual_linear", f"SELECT legacy_cartera_id, {LINEAR} AS interes FROM ({ELAPSED})")
def int_accrual_linear(spark, d):
    return I.accrual_linear(T.loans(spark, d), AS_OF)


PERIOD_DAYS = f"""SELECT l.*, CASE WHEN greatest(l.fecha, DATE '{PERIOD[0]}') > DATE '{PERIOD[1]}' THEN 0
  ELSE e.idx - p.idx END AS dp FROM loans l JOIN cal p ON p.d = greatest(l.fecha, DATE '{PERIOD[0]}') - 1
 JOIN cal e ON e.d = DATE '{PERIOD[1]}'"""
# monto x 0.15 x days / 365.25 = cents x 15 x days / 36525 cents.
PERIODIC = "CAST((2 * CAST(monto * 100 AS HUGEINT) * 15 * dp + 36525) // 73050 AS DOUBLE) / 100"


@query("int_accrual_period", f"SELECT legacy_cartera_id, {PERIODIC} AS interes FROM ({PERIOD_DAYS})")
def int_accrual_period(spark, d):
    return I.accrual_period(T.loans(spark, d), *PERIOD)


@query("int_reprice_batch", f"""
SELECT legacy_schedule_id, ref_invoice_id, {d4('s.dueamt')} AS dueamt_previo, {d4('i.grandtotal')} AS grandtotal_previo,
 CAST({half_up('CAST(l.valorinteres * 10000 AS HUGEINT)', '(l.dias_cre * 100)', 0)} AS DOUBLE) / 100 AS nuevo_monto, 'Y' AS isvalid, 'N' AS ispaid
FROM sched s JOIN loans l USING (legacy_cartera_id) LEFT JOIN invoices i ON i.c_invoice_id = s.ref_invoice_id
WHERE s.ref_invoice_id IS NOT NULL AND (s.isvalid IS NULL OR s.isvalid <> 'Y')""", digits=4)
def int_reprice_batch(spark, d):
    return I.reprice_batch(T.schedule(spark, d), T.loans(spark, d), T.invoices(spark, d))


REPRICED = """SELECT s.ref_invoice_id FROM sched s JOIN loans l USING (legacy_cartera_id)
 WHERE s.ref_invoice_id IS NOT NULL AND (s.isvalid IS NULL OR s.isvalid <> 'Y')"""


def _repriced(spark, d):
    rows = I.reprice_batch(T.schedule(spark, d), T.loans(spark, d), T.invoices(spark, d))
    return I.reprice_updates(rows, T.allocations(spark, d))


@query("int_reprice_batch_payments", f"SELECT DISTINCT c_payment_id, 'N' AS isallocated FROM alloc WHERE c_invoice_id IN ({REPRICED})")
def int_reprice_batch_payments(spark, d):
    return _repriced(spark, d)["payments"]


@query("int_reprice_batch_lines", f"""
WITH x AS (SELECT s.ref_invoice_id AS c_invoice_id, CAST({half_up('CAST(l.valorinteres * 10000 AS HUGEINT)', '(l.dias_cre * 100)', 0)} AS DOUBLE) / 100 AS p
 FROM sched s JOIN loans l USING (legacy_cartera_id) WHERE s.ref_invoice_id IS NOT NULL AND (s.isvalid IS NULL OR s.isvalid <> 'Y'))
SELECT c_invoice_id, p AS priceactual, p AS linenetamt, p AS priceentered FROM x""")
def int_reprice_batch_lines(spark, d):
    return _repriced(spark, d)["lines"]


NEW = "CAST(monto * CAST(1.1 AS DECIMAL(2,1)) AS DECIMAL(18,2))"
NEW_TOTAL = f"round({NEW} * CAST(1.12 AS DECIMAL(3,2)), 2)"


@query("int_modify_loan", f"""
SELECT legacy_cartera_id, CASE WHEN synced = 'N' THEN 45 ELSE dias_cre END AS dias_cre,
 CASE WHEN synced = 'N' THEN {d4(NEW)} ELSE {d4('monto')} END AS monto,
 CASE WHEN synced = 'N' THEN 0.12 ELSE {d4('tasa')} END AS tasa,
 CASE WHEN synced = 'N' THEN {d4(f'round({NEW} * CAST(0.12 AS DECIMAL(3,2)), 2)')} ELSE {d4('valorinteres')} END AS valorinteres,
 CASE WHEN synced = 'N' THEN {d4(NEW_TOTAL)} ELSE {d4('montototal')} END AS montototal,
 CASE WHEN synced = 'N' THEN CAST({div(NEW_TOTAL, '45', 2)} AS DOUBLE) ELSE {d4('cuota')} END AS cuota,
 CASE WHEN synced = 'N' THEN local_id END AS factura_cambiada,
 CASE WHEN synced = 'N' THEN payment_id END AS desembolso_cambiado, coalesce(synced = 'N', false) AS modificada
FROM loans""", digits=4)
def int_modify_loan(spark, d):
    ln = T.loans(spark, d)
    changes = ln.filter("synced = 'N'").select(
        "legacy_cartera_id",
        F.round(F.col("monto") * dec("1.1", "decimal(2,1)"), 2).cast("decimal(18,2)").alias("nuevomonto"),
        dec("0.12", "decimal(10,4)").alias("nuevatasa"), F.lit(45).alias("nuevoplazo"))
    return I.modify_loans(ln, changes)
