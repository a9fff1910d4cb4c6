"""Statements of all partners, loans and boxes."""

from loanbook.operators import statements as S
from loanbook.plans.q_balances import PAID_ALL
from loanbook.plans.registry import CASH_RANGE, query
from loanbook.plans.sqlviews import m
from loanbook.sources import tables as T

RANGE = ("1998-01-01", "1998-12-31")
A, Z = (f"DATE '{x}'" for x in RANGE)
CA, CZ = (f"DATE '{x}'" for x in CASH_RANGE)


@query("stm_partner", f"""
WITH mov AS (
 SELECT c_bpartner_id, 'INI-DEB' AS documentno, 'SALDO INICIAL (DÉBITOS)' AS concepto, CAST({A} - 1 AS DATE) AS fecha,
  CAST(sum(montototal) AS DECIMAL(28,4)) AS debito, CAST(0 AS DECIMAL(28,4)) AS credito FROM loans WHERE fecha < {A} GROUP BY 1
 UNION SELECT c_bpartner_id, 'INI-CRED', 'SALDO INICIAL (CRÉDITOS)', CAST({A} - 1 AS DATE), 0, sum(abono) FROM cobros
  JOIN loans ON legacy_cartera_id = id_cartera WHERE operacion < {A} GROUP BY 1
 UNION SELECT c_bpartner_id, coalesce(local_id, legacy_cartera_id)::VARCHAR, 'Desembolso', fecha, montototal, 0 FROM loans
  WHERE fecha BETWEEN {A} AND {Z}
 UNION SELECT c_bpartner_id, coalesce(c.local_id, legacy_cobro_id), 'Cobro', operacion, 0, abono FROM cobros c
  JOIN loans ON legacy_cartera_id = id_cartera WHERE operacion BETWEEN {A} AND {Z})
SELECT c_bpartner_id, fecha, documentno, concepto, {m('debito')} AS debito, {m('credito')} AS credito,
 {m('CAST(sum(debito - credito) OVER (PARTITION BY c_bpartner_id ORDER BY fecha) AS DECIMAL(28,4))')} AS saldo FROM mov""")
def stm_partner(spark, d):
    return S.partner_statement(T.loans(spark, d), T.collections(spark, d), *RANGE)


@query("stm_partner_owned", f"""
WITH mov AS (
 SELECT c_bpartner_id, 'INI-DEB' AS documentno, 'SALDO INICIAL (DÉBITOS)' AS concepto, CAST({A} - 1 AS DATE) AS fecha,
  CAST(sum(montototal) AS DECIMAL(28,4)) AS debito, CAST(0 AS DECIMAL(28,4)) AS credito FROM loans WHERE fecha < {A} GROUP BY 1
 UNION SELECT c_bpartner_id, 'INI-CRED', 'SALDO INICIAL (CRÉDITOS)', CAST({A} - 1 AS DATE), 0, sum(abono) FROM cobros_own
  WHERE operacion < {A} GROUP BY 1
 UNION SELECT c_bpartner_id, coalesce(local_id, legacy_cartera_id)::VARCHAR, 'Desembolso', fecha, montototal, 0 FROM loans
  WHERE fecha BETWEEN {A} AND {Z}
 UNION SELECT c_bpartner_id, coalesce(c.local_id, legacy_cobro_id), 'Cobro', operacion, 0, abono FROM cobros_own c WHERE operacion BETWEEN {A} AND {Z})
SELECT c_bpartner_id, fecha, documentno, concepto, {m('debito')} AS debito, {m('credito')} AS credito,
 {m('CAST(sum(debito - credito) OVER (PARTITION BY c_bpartner_id ORDER BY fecha) AS DECIMAL(28,4))')} AS saldo FROM mov""")
def stm_partner_owned(spark, d):
    return S.partner_statement(T.loans(spark, d), T.partner_collections(spark, d), *RANGE)


@query("stm_partner_history", f"""
WITH lp AS (SELECT id_cartera, max(operacion) AS lastp FROM cobros WHERE abono > 0 GROUP BY 1)
SELECT c_bpartner_id, legacy_cartera_id AS idcartera, org_name AS codsucursal, fecha, dias_cre, vence6 AS fechavence, {m('monto')} AS monto,
 {m('tasa * 100')} AS tasainteres, {m('montototal')} AS montototal, {m('coalesce(p, 0)')} AS abonos, {m('montototal - coalesce(p, 0)')} AS saldo,
 lastp AS fechaultimoabono, CAST(lastp - vence6 AS INTEGER) AS dias_retraso,
 row_number() OVER (PARTITION BY c_bpartner_id ORDER BY fecha, md5(legacy_cartera_id::VARCHAR)) AS rownumber
FROM loans JOIN due6 USING (legacy_cartera_id) JOIN branches USING (ad_org_id) LEFT JOIN ({PAID_ALL}) x ON x.id_cartera = legacy_cartera_id
LEFT JOIN lp ON lp.id_cartera = legacy_cartera_id""")
def stm_partner_history(spark, d):
    return S.partner_history(T.loans(spark, d), T.collections(spark, d), T.branches(spark, d))


@query("stm_loan", f"""
WITH al AS (SELECT c_payment_id, c_invoice_id, sum(amount) AS amount FROM alloc WHERE isactive = 'Y' GROUP BY 1, 2),
 ap AS (SELECT c_payment_id, l.legacy_cartera_id, sum(amount) AS a FROM al JOIN loans l ON l.local_id = al.c_invoice_id GROUP BY 1, 2),
 ai AS (SELECT c_payment_id, s.legacy_cartera_id, sum(amount) AS a FROM al JOIN sched s ON s.ref_invoice_id = al.c_invoice_id
  WHERE s.processed = 'Y' GROUP BY 1, 2),
 mov AS (
  SELECT 0 AS ordenpresentacion, l.legacy_cartera_id, coalesce(dateinvoiced, fecha) AS fecha_movimiento,
   coalesce(local_id::VARCHAR, 'CAPITAL-' || l.legacy_cartera_id) AS documento, 'CxC Capital' AS concepto,
   CAST(coalesce(grandtotal, montototal) AS DECIMAL(28,4)) AS debito, CAST(0 AS DECIMAL(28,4)) AS credito,
   CAST(0 AS DECIMAL(28,4)) AS asignado_interes, CAST(0 AS DECIMAL(28,4)) AS asignado_principal
  FROM loans l LEFT JOIN invoices i ON i.c_invoice_id = l.local_id
  UNION ALL SELECT 100, s.legacy_cartera_id, dateinvoiced, i.c_invoice_id::VARCHAR, 'CxC Interés', grandtotal, 0, 0, 0
  FROM sched s JOIN invoices i ON i.c_invoice_id = s.ref_invoice_id WHERE s.processed = 'Y' AND i.c_doctype_id = 1000051
  UNION ALL SELECT 999, id_cartera, operacion, coalesce(c.local_id, 'COBRO-' || legacy_cobro_id), 'Pago/Cobro', 0, abono,
   CAST(coalesce(ai.a, 0) AS DECIMAL(28,4)), CAST(coalesce(ap.a, 0) AS DECIMAL(28,4)) FROM cobros c JOIN loans l ON l.legacy_cartera_id = c.id_cartera
  LEFT JOIN ap ON ap.c_payment_id = c.local_id AND ap.legacy_cartera_id = c.id_cartera
  LEFT JOIN ai ON ai.c_payment_id = c.local_id AND ai.legacy_cartera_id = c.id_cartera WHERE abono > 0)
SELECT ordenpresentacion, legacy_cartera_id, fecha_movimiento, documento, concepto, {m('debito')} AS debito, {m('credito')} AS credito,
 {m('asignado_interes')} AS asignado_interes, {m('asignado_principal')} AS asignado_principal,
 {m('CAST(sum(debito - credito) OVER w AS DECIMAL(28,4))')} AS saldo,
 {m("CAST(sum(CASE WHEN concepto = 'CxC Capital' THEN debito ELSE -asignado_principal END) OVER w AS DECIMAL(28,4))")} AS saldo_capital,
 {m("CAST(sum(CASE WHEN concepto = 'CxC Interés' THEN debito ELSE -asignado_interes END) OVER w AS DECIMAL(28,4))")} AS saldo_interes
FROM mov WINDOW w AS (PARTITION BY legacy_cartera_id ORDER BY fecha_movimiento)""")
def stm_loan(spark, d):
    return S.loan_statement(T.loans(spark, d), T.collections(spark, d), T.schedule(spark, d),
                            T.invoices(spark, d), T.allocations(spark, d))


CASHMOV = f"""
 cm AS MATERIALIZED (
 SELECT c_bankaccount_id, docbasetype, 'Saldo Inicial' AS documentno, {CA} AS dateacct, CAST({CA} - 1 AS TIMESTAMP) AS created,
  CAST(sum(CASE WHEN docbasetype = 'ARR' THEN payamt ELSE 0 END) AS DECIMAL(28,4)) AS ingresos,
  CAST(sum(CASE WHEN docbasetype = 'APP' THEN payamt ELSE 0 END) AS DECIMAL(28,4)) AS egresos
 FROM pay WHERE docstatus IN ('CO','CL') AND dateacct < {CA} GROUP BY 1, 2
 UNION SELECT c_bankaccount_id, docbasetype, c_payment_id::VARCHAR, dateacct, created, CASE WHEN docbasetype = 'ARR' THEN payamt ELSE 0 END,
  CASE WHEN docbasetype = 'APP' THEN payamt ELSE 0 END FROM pay WHERE docstatus IN ('CO','CL') AND dateacct BETWEEN {CA} AND {CZ})"""
TIPOMOV = "CASE WHEN docbasetype = 'APP' THEN 'Egresos' ELSE 'Ingresos' END"


@query("stm_cash_account", f"""
WITH {CASHMOV}
SELECT c_bankaccount_id, docbasetype, documentno, dateacct, created, {m('ingresos')} AS ingresos, {m('egresos')} AS egresos, {TIPOMOV} AS tipomov,
 {m('''CAST(sum(ingresos - egresos) OVER (PARTITION BY c_bankaccount_id ORDER BY dateacct, created, documentno, docbasetype
  ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,4))''')} AS saldo FROM cm""")
def stm_cash_account(spark, d):
    return S.cash_statement(T.cash_payments(spark, d), *CASH_RANGE)


@query("stm_cash_account_crosstab", f"""
WITH {CASHMOV}
SELECT c_bankaccount_id, CASE docbasetype WHEN 'ARR' THEN 'Recibo' ELSE 'Pago' END AS tipodoc,
 {m("sum(ingresos + egresos) FILTER (docbasetype <> 'APP')")} AS "Ingresos", {m("sum(ingresos + egresos) FILTER (docbasetype = 'APP')")} AS "Egresos"
FROM cm GROUP BY 1, 2""")
def stm_cash_account_crosstab(spark, d):
    mov = S.cash_movements_with_opening(T.cash_payments(spark, d), *CASH_RANGE)
    return S.cash_crosstab(mov, {"ARR": "Recibo", "APP": "Pago"})


@query("stm_payment_review", f"""
SELECT c_payment_id, c_bpartner_id, dateacct, docbasetype, c_doctype_id, c_charge_id,
 {m("CASE WHEN docbasetype = 'APP' THEN 0 ELSE payamt END")} AS ingresos, {m("CASE WHEN docbasetype = 'ARR' THEN 0 ELSE payamt END")} AS egresos,
 nombrecaja AS cuenta, docstatus FROM pay JOIN boxes USING (c_bankaccount_id) WHERE dateacct BETWEEN {CA} AND {CZ}""")
def stm_payment_review(spark, d):
    return S.payment_review(T.cash_payments(spark, d), T.boxes(spark), *CASH_RANGE)
