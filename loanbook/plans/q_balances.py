"""As-of balances and loan life over the whole tables."""

from loanbook.operators import balances as B
from loanbook.plans.registry import AS_OF, query
from loanbook.plans.sqlviews import m
from loanbook.sources import tables as T

PAID = f"SELECT id_cartera, sum(abono) AS p, max(operacion) AS u FROM cobros WHERE operacion <= DATE '{AS_OF}' GROUP BY 1"
PAID_ALL = "SELECT id_cartera, sum(abono) AS p, max(operacion) AS u FROM cobros GROUP BY 1"


def lc(spark, d):
    return T.loans(spark, d), T.collections(spark, d)


@query("asof_paid", f"""
SELECT legacy_cartera_id, {m('coalesce(p, 0)')} AS abonos
FROM loans LEFT JOIN ({PAID}) ON id_cartera = legacy_cartera_id""")
def asof_paid(spark, d):
    return B.paid_to_date(*lc(spark, d), AS_OF)


@query("asof_balance", f"""
SELECT legacy_cartera_id, {m('montototal - coalesce(p, 0)')} AS saldo
FROM loans LEFT JOIN ({PAID}) ON id_cartera = legacy_cartera_id""")
def asof_balance(spark, d):
    return B.balance_to_date(*lc(spark, d), AS_OF)


@query("asof_last_payment", f"""
SELECT legacy_cartera_id, coalesce(u, fecha) AS fecha_ultimo_pago
FROM loans LEFT JOIN ({PAID}) ON id_cartera = legacy_cartera_id""")
def asof_last_payment(spark, d):
    return B.last_payment_to_date(*lc(spark, d), AS_OF, fallback=True)


MONTH_ENDS = ["1998-01-31", "1998-02-28", "1998-03-31", "1998-04-30", "1998-05-31", "1998-06-30",
              "1998-07-31", "1998-08-31", "1998-09-30", "1998-10-31", "1998-11-30", "1998-12-31"]


@query("asof_multi", f"""
WITH mv AS (SELECT id_cartera, operacion, sum(abono) AS a FROM cobros
 WHERE operacion <= DATE '1998-12-31' GROUP BY 1, 2),
 p AS (SELECT enddate AS corte FROM periods WHERE year(enddate) = 1998)
SELECT legacy_cartera_id, corte, {m('coalesce(sum(a), 0)')} AS abonos,
 {m('any_value(montototal) - coalesce(sum(a), 0)')} AS saldo
FROM loans JOIN p ON fecha <= corte
LEFT JOIN mv ON id_cartera = legacy_cartera_id AND operacion <= corte
GROUP BY 1, 2""")
def asof_multi(spark, d):
    return B.balances_at(*lc(spark, d), MONTH_ENDS)


META = f"""
SELECT l.legacy_cartera_id, CASE WHEN montototal - coalesce(p, 0) <= 0 THEN u END AS fecha_cancelacion,
 vence6 AS fecha_vencimiento, u AS fecha_ultimo_pago, {m('coalesce(p, 0)')} AS total_abonos,
 {m('montototal - coalesce(p, 0)')} AS saldo_calculado
FROM loans l JOIN due6 USING (legacy_cartera_id)
LEFT JOIN ({PAID_ALL}) ON id_cartera = l.legacy_cartera_id"""


@query("loan_metadata", META)
def loan_metadata(spark, d):
    return B.loan_metadata(*lc(spark, d))


@query("loan_metadata_range", META + " WHERE l.legacy_cartera_id BETWEEN 3000 AND 5999")
def loan_metadata_range(spark, d):
    """One page of loans; the page is the feature."""
    return B.loan_metadata(*lc(spark, d), id_range=(3000, 5999))


def _label(gap):
    return f"""CAST(coalesce({gap}, -99999) AS INTEGER) AS diffdias, CASE WHEN {gap} IS NULL THEN 'NUEVO'
  WHEN {gap} <= 30 THEN 'RENOVACIÓN' ELSE 'REACTIVACIÖN' END AS tipodesembolso"""


RENEWAL = f"""SELECT legacy_cartera_id, c_bpartner_id, fecha, {_label('gap')} FROM (
  SELECT *, fecha - lag(fecha + dias_cre) OVER (PARTITION BY c_bpartner_id
   ORDER BY fecha, md5(legacy_cartera_id::VARCHAR)) AS gap FROM loans)"""


@query("loan_renewal", RENEWAL)
def loan_renewal(spark, d):
    return B.loan_renewal(T.loans(spark, d))


WIDE = f"""
SELECT l.legacy_cartera_id, l.ad_org_id, l.dias_cre, l.c_bpartner_id, codigo, l.fecha,
 nombre AS nombrecliente, {m('monto')} AS monto, {m('tasa')} AS tasa, {m('monto * tasa')} AS interes,
 {m('montototal')} AS montototal, usuario, rubro AS grupotercero, l.synced AS sincronizado, cv_ruta_id,
 ruta AS nombreruta, sucursal AS nombresucursal, split_part(l.coords, '|', 1) AS latitud,
 split_part(l.coords, '|', 2) AS longitud, l.fecha + l.dias_cre AS fechavence, rn.diffdias,
 rn.tipodesembolso, vence6 AS fecha_vencimiento, {m('coalesce(p, 0)')} AS total_abonos,
 u AS fecha_ultimo_pago, {m('montototal - coalesce(p, 0)')} AS saldo_calculado
FROM loans l JOIN pwide USING (c_bpartner_id) JOIN users ON ad_user_id = l.createdby
JOIN due6 USING (legacy_cartera_id) JOIN rn USING (legacy_cartera_id)
LEFT JOIN ({PAID_ALL}) ON id_cartera = l.legacy_cartera_id"""
STRICT_RENEWAL = f"""
 best AS (SELECT a.legacy_cartera_id, arg_max(b.fecha + b.dias_cre,
   (b.fecha::VARCHAR || md5(b.legacy_cartera_id::VARCHAR))) AS vence
  FROM loans a JOIN loans b ON a.c_bpartner_id = b.c_bpartner_id AND b.fecha < a.fecha GROUP BY 1),
 rn AS (SELECT l.legacy_cartera_id, l.c_bpartner_id, l.fecha, {_label('l.fecha - best.vence')}
  FROM loans l LEFT JOIN best USING (legacy_cartera_id))"""


def _view(spark, d, classify):
    loans = T.loans(spark, d)
    return B.loan_view(loans, T.collections(spark, d), T.partners_wide(spark, d), T.users(spark, d), classify(loans))


@query("loan_view", f"WITH rn AS ({RENEWAL}) {WIDE}")
def loan_view(spark, d):
    return _view(spark, d, B.loan_renewal)


@query("loan_view_prior", f"WITH {STRICT_RENEWAL} {WIDE}")
def loan_view_prior(spark, d):
    """The older form: previous loan of a strictly earlier day."""
    return _view(spark, d, B.loan_renewal_strict)


PARTNER_BALANCE = """SELECT c_bpartner_id, sum(montototal) - coalesce(sum(p), 0) AS saldo
 FROM loans LEFT JOIN (SELECT id_cartera, sum(abono) AS p FROM cobros GROUP BY 1) ON id_cartera = legacy_cartera_id
 GROUP BY 1"""


@query("partner_balance_check", f"""
SELECT c_bpartner_id, nombre, {m('totalopenbalance')} AS totalopenbalance, {m('saldo')} AS saldo
FROM partners JOIN ({PARTNER_BALANCE}) USING (c_bpartner_id) WHERE saldo <> totalopenbalance""")
def partner_balance_check(spark, d):
    return B.partner_balance_check(T.partners(spark, d), *lc(spark, d))


@query("partner_balance_fix", f"""
SELECT c_bpartner_id, {m('coalesce(saldo, totalopenbalance)')} AS totalopenbalance,
 coalesce(saldo <> totalopenbalance, false) AS corregido
FROM partners LEFT JOIN ({PARTNER_BALANCE}) USING (c_bpartner_id)""")
def partner_balance_fix(spark, d):
    return B.partner_balance_fix(T.partners(spark, d), *lc(spark, d))


@query("invoice_open", f"""
SELECT i.c_invoice_id, c_bpartner_id, c_doctype_id, dateinvoiced, CAST(round(grandtotal, 4) AS DOUBLE) AS grandtotal,
 CAST(round(grandtotal - coalesce(a, 0), 4) AS DOUBLE) AS open
FROM invoices i LEFT JOIN (SELECT c_invoice_id, sum(amount) AS a FROM alloc WHERE isactive = 'Y' GROUP BY 1) USING (c_invoice_id)
""", digits=4)
def invoice_open(spark, d):
    return B.invoice_open(T.invoices(spark, d), T.allocations(spark, d)).select(
        "c_invoice_id", "c_bpartner_id", "c_doctype_id", "dateinvoiced", "grandtotal", "open")


@query("invoice_open_to_date", f"""
SELECT i.c_invoice_id, c_bpartner_id, c_doctype_id, dateinvoiced, CAST(round(grandtotal, 4) AS DOUBLE) AS grandtotal,
 CAST(round(grandtotal - coalesce(a, 0), 4) AS DOUBLE) AS open
FROM invoices i LEFT JOIN (SELECT c_invoice_id, sum(amount) AS a FROM alloc
 WHERE isactive = 'Y' AND dateacct <= DATE '{AS_OF}' GROUP BY 1) USING (c_invoice_id)
""", digits=4)
def invoice_open_to_date(spark, d):
    return B.invoice_open(T.invoices(spark, d), T.allocations(spark, d), AS_OF).select(
        "c_invoice_id", "c_bpartner_id", "c_doctype_id", "dateinvoiced", "grandtotal", "open")


@query("synced_balance", f"""
SELECT legacy_cartera_id, {m('montototal - coalesce(p, 0)')} AS saldo_synced FROM loans
LEFT JOIN (SELECT id_cartera, sum(abono) AS p FROM cobros WHERE synced = 'Y' GROUP BY 1) ON id_cartera = legacy_cartera_id""")
def synced_balance(spark, d):
    return B.synced_balance(*lc(spark, d)).select("legacy_cartera_id", "saldo_synced")
