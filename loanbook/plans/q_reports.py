"""Portfolio and collection reports over the whole tables."""

from pyspark.sql import functions as F

from loanbook import config
from loanbook.operators import reports as R
from loanbook.plans.q_balances import PAID_ALL
from loanbook.plans.registry import AS_OF, query
from loanbook.plans.sqlviews import m
from loanbook.functions.scalars import emit
from loanbook.session import work_folder
from loanbook.sources import tables as T
from loanbook.sources.sinks import export_csv

CUT = f"DATE '{AS_OF}'"
CONFIG = '{"company-name": "Prestamos SA", "rep-name": "Gerencia"}'
SINCE = "1996-01-01"
RANGE = ("1998-01-01", "1998-06-30")


def lcp(spark, d):
    return T.loans(spark, d), T.collections(spark, d), T.partners_wide(spark, d)


def raw(sum_filter: str = f"operacion <= {CUT}", loan_filter: str = "true") -> str:
    """CTE 'raw': the portfolio rows, written independently."""
    return f"""
 mv AS MATERIALIZED (SELECT id_cartera, CAST(sum(abono) FILTER ({sum_filter}) AS DECIMAL(18,2)) AS paid,
   max(operacion) FILTER (operacion <= {CUT} AND abono > 0) AS lastp FROM cobros GROUP BY 1),
 raw AS MATERIALIZED (SELECT l.*, l.legacy_cartera_id AS recid, codigo, nombre AS tercero, taxid AS cedula, rubro, ruta, ad_org_trx_id, sucursal,
   CAST(year(fecha) AS INTEGER) AS yy_fecha, vence6, CAST(greatest(0, {CUT} - vence6) AS INTEGER) AS dv,
   coalesce(local_id, l.legacy_cartera_id)::VARCHAR AS documentno, coalesce(paid, 0) AS credito,
   montototal - coalesce(paid, 0) AS saldo, coalesce(lastp, fecha) AS ultimo, CAST({CUT} - coalesce(lastp, fecha) AS INTEGER) AS sinabonar
  FROM loans l JOIN due6 USING (legacy_cartera_id) JOIN pwide USING (c_bpartner_id) LEFT JOIN mv ON mv.id_cartera = l.legacy_cartera_id
  WHERE fecha <= {CUT} AND {loan_filter} AND montototal - coalesce(paid, 0) <> 0)"""


BRANCH = f"""recid, fecha, dias_cre AS plazo, vence6 AS fechavence, dv AS diasvencimiento, c_bpartner_id, codigo, tercero, documentno,
 {m('montototal')} AS debito, {m('credito')} AS credito, {m('saldo')} AS saldo, ultimo AS fechaultimoabono, ruta, sinabonar, sucursal"""


@query("rpt_portfolio_branch", f"WITH {raw()} SELECT {BRANCH} FROM raw")
def rpt_portfolio_branch(spark, d):
    return R.portfolio_branch(*lcp(spark, d), AS_OF)


@query("rpt_portfolio_branch_all", f"WITH {raw('true')} SELECT {BRANCH} FROM raw")
def rpt_portfolio_branch_all(spark, d):
    return R.portfolio_branch(*lcp(spark, d), AS_OF, sum_all=True)


def summary(threshold, branch="sucursal"):
    return f"""SELECT {branch} AS sucursal, yy_fecha, ruta, CAST(GROUPING({branch}, yy_fecha, ruta) AS BIGINT) AS nivel,
 count(*) AS totalcreditos, count(*) FILTER (dv > {threshold}) AS creditosvencidos, {m('sum(montototal)')} AS debito,
 {m('sum(saldo)')} AS saldo_cxc, {m(f'coalesce(sum(saldo) FILTER (dv > {threshold}), 0)')} AS saldo_vencido"""


@query("rpt_portfolio_branch_year", f"WITH {raw()} {summary(15)} FROM raw GROUP BY ROLLUP(sucursal, yy_fecha, ruta)")
def rpt_portfolio_branch_year(spark, d):
    return R.portfolio_branch_year(*lcp(spark, d), AS_OF)


@query("rpt_portfolio_global", f"""
WITH {raw(loan_filter=f"fecha >= DATE '{SINCE}'")}
{summary(30, 'org_name')} FROM raw JOIN branches USING (ad_org_id) GROUP BY ROLLUP(org_name, yy_fecha, ruta)""")
def rpt_portfolio_global(spark, d):
    return R.portfolio_global(*lcp(spark, d), T.branches(spark, d), SINCE, AS_OF)


def risk(value):
    parts = []
    for high, code, label, rate in config.RISK_CLASSES:
        v = {"code": f"'{code}'", "label": f"'{label}'", "rate": f"CAST({rate} AS DECIMAL(3,2))"}[value]
        parts.append(f"WHEN sinabonar <= {high} THEN {v}" if high else f"ELSE {v}")
    return f"CASE {' '.join(parts)} END"


@query("rpt_portfolio_risk", f"""
WITH {raw(loan_filter="monto > 0 AND isactive = 'Y'")}
SELECT recid, fecha, dias_cre AS plazo, vence6 AS fechavence, dv AS diasvencimiento, c_bpartner_id, codigo, cedula, tercero, documentno,
 {m('montototal')} AS debito, {m('credito')} AS credito, {m('monto')} AS capital, {m('monto * tasa')} AS interes, {m('saldo')} AS saldo,
 {m('monto - credito * CAST(0.85 AS DECIMAL(3,2))')} AS saldo_principal,
 {m('monto * CAST(0.15 AS DECIMAL(3,2)) - credito * CAST(0.15 AS DECIMAL(3,2))')} AS saldo_interes,
 ultimo AS fechaultimoabono, ruta, rubro, sinabonar, {risk('code')} AS codigo_clasificacion, {risk('label')} AS tipo_clasificacion,
 {m(f"saldo * {risk('rate')}")} AS provision FROM raw""")
def rpt_portfolio_risk(spark, d):
    return R.portfolio_risk(*lcp(spark, d), AS_OF)


@query("rpt_report_sort", f"WITH {raw()} SELECT {BRANCH} FROM raw ORDER BY saldo DESC, sinabonar DESC, recid")
def rpt_report_sort(spark, d):
    return R.sorted_report(R.portfolio_branch(*lcp(spark, d), AS_OF), "saldo")


@query("rpt_schedule_window", f"""
WITH {raw()} SELECT {BRANCH.replace('dv AS', f'CAST({CUT} - vence6 AS INTEGER) AS')} FROM raw
WHERE saldo > 0 AND vence6 BETWEEN {CUT} - 15 AND {CUT} + 15""")
def rpt_schedule_window(spark, d):
    return R.maturing(*lcp(spark, d), AS_OF, 15)


@query("rpt_schedule_window_year", f"WITH {raw()} {summary(30)} FROM raw GROUP BY ROLLUP(sucursal, yy_fecha, ruta)")
def rpt_schedule_window_year(spark, d):
    return R.portfolio_branch_year(*lcp(spark, d), AS_OF, threshold=30)


@query("rpt_promotion", f"""
WITH t AS (SELECT c_bpartner_id, sum(montototal) AS montototal, sum(p) AS cobrototal, sum(montototal - monto) AS interestotal
  FROM loans LEFT JOIN ({PAID_ALL}) ON id_cartera = legacy_cartera_id GROUP BY 1),
 u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_bpartner_id ORDER BY fecha DESC, legacy_cartera_id DESC) AS rn FROM loans) WHERE rn = 1),
 lp AS (SELECT id_cartera, max(operacion) AS lastp FROM cobros WHERE abono > 0 GROUP BY 1)
SELECT t.c_bpartner_id, codigo, nombre, ruta, sucursal, u.legacy_cartera_id AS ud_id, u.dias_cre, u.fecha AS ultimodesembolso,
 {m('t.montototal')} AS montototal, {m('cobrototal')} AS cobrototal, {m('t.montototal - cobrototal')} AS saldototal,
 {m('interestotal')} AS interestotal, CAST(lastp - vence6 AS INTEGER) AS dias_retraso
FROM t JOIN u USING (c_bpartner_id) JOIN due6 USING (legacy_cartera_id) JOIN pwide USING (c_bpartner_id)
LEFT JOIN lp ON lp.id_cartera = u.legacy_cartera_id WHERE t.montototal - cobrototal <= 1000000""")
def rpt_promotion(spark, d):
    return R.promotion(*lcp(spark, d), "1000000")


@query("rpt_no_payment_today", f"""
WITH {raw()}, lp AS (SELECT id_cartera, max(operacion) AS lastp FROM cobros WHERE operacion <= {CUT} GROUP BY 1)
SELECT sucursal, codigo, tercero, legacy_cartera_id, fecha, dias_cre AS plazo, vence6 AS fechavence, dv AS diasvencimiento,
 {m('montototal')} AS debito, {m('credito')} AS credito, {m('saldo')} AS saldocar, {m('cuota')} AS cuota, lastp AS fechaultimoabono,
 CAST({CUT} - lastp AS INTEGER) AS sinabonar, {m(f'cuota * CAST({CUT} - lastp AS INTEGER)')} AS montoretraso, ruta
FROM raw JOIN lp ON lp.id_cartera = legacy_cartera_id WHERE saldo > 0 AND fecha >= DATE '{SINCE}'
 AND NOT EXISTS (SELECT 1 FROM cobros c WHERE c.id_cartera = legacy_cartera_id AND c.operacion = {CUT})""")
def rpt_no_payment_today(spark, d):
    return R.no_payment_on(*lcp(spark, d), AS_OF, SINCE)


LABELS = """CASE genero WHEN 'F' THEN 'Femenino' WHEN 'M' THEN 'Masculino' ELSE 'Pendiente' END AS genero,
 CASE tipo_localizacion WHEN 'U' THEN 'Urbano' WHEN 'R' THEN 'Rural' ELSE 'Pendiente' END AS tipo_localizacion"""


@query("rpt_loans_by_date", f"""
SELECT legacy_cartera_id, c_bpartner_id, codigo, nombre, fecha, dias_cre, {m('monto')} AS monto, {m('valorinteres')} AS valorinteres,
 {m('montototal')} AS montototal, ruta AS nombreruta, sucursal AS nombresucursal, {LABELS}
FROM loans JOIN pwide USING (c_bpartner_id) WHERE fecha BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""")
def rpt_loans_by_date(spark, d):
    return R.loans_between(T.loans(spark, d), T.partners_wide(spark, d), *RANGE)


COLL = f"""FROM cobros c JOIN loans l ON l.legacy_cartera_id = c.id_cartera JOIN pwide p ON p.c_bpartner_id = l.c_bpartner_id
 JOIN users u ON u.ad_user_id = c.createdby JOIN branches b ON b.ad_org_id = c.ad_org_id
 JOIN (SELECT id_cartera, CAST(sum(abono) AS DECIMAL(18,2)) AS paid FROM cobros WHERE operacion <= DATE '{RANGE[1]}' GROUP BY 1) s ON s.id_cartera = c.id_cartera
 WHERE c.operacion BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"""


@query("rpt_collections_global", f"""
SELECT c.legacy_cobro_id, codigo AS codtercero, nombre AS tercero, {m('abono')} AS abono, {m('monto')} AS capital,
 {m('valorinteres')} AS interes, {m('montototal')} AS montototal, {m('montototal - paid')} AS saldoalcorte,
 {m('abono * CAST(0.85 AS DECIMAL(3,2))')} AS abono_a_capital, {m('abono * CAST(0.15 AS DECIMAL(3,2))')} AS abono_a_interes,
 {m('abono')} AS abono_total, dias_cre AS plazo, {m('tasa')} AS tasa, operacion AS fecha, usuario AS creadopor, ruta AS nombreruta,
 org_name AS nombresucursal, {LABELS} {COLL}""")
def rpt_collections_global(spark, d):
    return R.collections_global(T.collections(spark, d), T.loans(spark, d), T.partners_wide(spark, d),
                                T.users(spark, d), T.branches(spark, d), *RANGE)


def _branch_rows(spark, d):
    return R.collections_branch(T.collections(spark, d), T.loans(spark, d), T.partners_wide(spark, d),
                                T.users(spark, d), T.branches(spark, d), *RANGE, CONFIG)


@query("rpt_collections_branch", f"""
SELECT c.legacy_cobro_id, codigo AS codtercero, nombre AS tercero, {m('abono')} AS abono, {m('montototal')} AS montototal,
 {m('montototal - paid')} AS saldoalcorte, operacion AS fecha, usuario AS creadopor, ruta AS nombreruta, org_name AS nombresucursal,
 split_part(c.coords, '|', 1) AS latitud, split_part(c.coords, '|', 2) AS longitud,
 'https://maps.google.com/?q=' || replace(c.coords, '|', ',') AS coordenadalink,
 '{CONFIG}'::JSON ->> '$."company-name"' AS company_name, '{CONFIG}'::JSON ->> '$."rep-name"' AS rep_name {COLL}""")
def rpt_collections_branch(spark, d):
    return _branch_rows(spark, d)


@query("rpt_collections_branch_totals", f"""
SELECT org_name AS nombresucursal, ruta AS nombreruta, CAST(GROUPING(org_name, ruta) AS BIGINT) AS nivel, count(*) AS cobros,
 {m('sum(abono)')} AS abono {COLL} GROUP BY ROLLUP(org_name, ruta)""")
def rpt_collections_branch_totals(spark, d):
    return R.route_subtotals(_branch_rows(spark, d))


@query("rpt_payment_plan", f"""
SELECT codigo AS bpartner_value, nombre AS bpartner_name, l.legacy_cartera_id, s.seq, {m('tasa * 100', 4)} AS tasa, fecha,
 {m('monto', 4)} AS monto, {m('cuota', 4)} AS cuota, {m('cuota - dueamt', 4)} AS cuota_principal, dias_cre,
 {m('valorinteres', 4)} AS valorinteres, {m('montototal', 4)} AS montototal, duedate, {m('dueamt', 4)} AS dueamt,
 {m('cuota + dueamt', 4)} AS cuota_total_dia, org_name AS nombre_organizacion
FROM sched s JOIN loans l USING (legacy_cartera_id) JOIN partners p ON p.c_bpartner_id = l.c_bpartner_id
JOIN branches b ON b.ad_org_id = l.ad_org_id""", digits=4)
def rpt_payment_plan(spark, d):
    return R.payment_plan(T.schedule(spark, d), T.loans(spark, d), T.partners(spark, d), T.branches(spark, d))


@query("rpt_pending_overpaid", """
WITH bal AS (SELECT l.legacy_cartera_id, l.c_bpartner_id, i.ispaid, montototal - coalesce(p, 0) AS s
  FROM loans l JOIN invoices i ON i.c_invoice_id = l.local_id
  LEFT JOIN (SELECT id_cartera, sum(abono) AS p FROM cobros WHERE synced = 'Y' GROUP BY 1) ON id_cartera = l.legacy_cartera_id),
 pend AS (SELECT id_cartera, count(*) AS cobros FROM cobros WHERE (synced <> 'Y' OR synced IS NULL) AND origen = 'native' AND abono > 0 GROUP BY 1)
SELECT DISTINCT c_bpartner_id, nombre, cobros, 'sobregirada' AS motivo FROM pend JOIN bal ON id_cartera = legacy_cartera_id
 JOIN partners USING (c_bpartner_id) WHERE s < 0
UNION ALL SELECT DISTINCT c_bpartner_id, nombre, cobros, 'factura pagada' FROM pend JOIN bal ON id_cartera = legacy_cartera_id
 JOIN partners USING (c_bpartner_id) WHERE ispaid = 'Y'""")
def rpt_pending_overpaid(spark, d):
    return R.pending_overpaid(T.collections(spark, d), T.loans(spark, d), T.invoices(spark, d), T.partners(spark, d))


@query("rpt_receipt_diff", f"""
SELECT p.c_payment_id, p.c_bpartner_id, nombre, docstatus, {m('payamt')} AS payamt, dateacct, {m('abono')} AS abono, {m('payamt - abono')} AS diff
FROM receipts_lost p JOIN partners USING (c_bpartner_id) LEFT JOIN cobros c ON c.local_id = p.c_payment_id WHERE payamt > 0""")
def rpt_receipt_diff(spark, d):
    return R.receipt_differences(T.with_lost(T.receipts(spark, d)), T.collections(spark, d), T.partners(spark, d))


@query("snk_export", f"""
SELECT org_name AS orgname, ruta AS nombreruta, strftime(operacion, '%Y-%m-%d') AS fecha, strftime(operacion_ts, '%H:%M:%S') AS hora, codigo AS codtercero,
 nombre AS tercero, c.c_bpartner_id, {m('abono')} AS abono, usuario AS creadopor, split_part(c.coords, '|', 1) AS latitud,
 split_part(c.coords, '|', 2) AS longitud, 'https://maps.google.com/?q=' || replace(c.coords, '|', ',') AS coordenadalink, legacy_cobro_id
FROM cobros_own c JOIN pwide p ON p.c_bpartner_id = c.c_bpartner_id LEFT JOIN users u ON u.ad_user_id = c.createdby JOIN branches b ON b.ad_org_id = c.ad_org_id WHERE c.origen = 'native' AND abono > 0""")
def snk_export(spark, d):
    """Written as a flat file and read back."""
    rows = emit(R.cobros_export(T.partner_collections(spark, d), T.loans(spark, d), T.partners_wide(spark, d),
                                T.users(spark, d), T.branches(spark, d)))
    path = work_folder(spark, "export")
    export_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)
