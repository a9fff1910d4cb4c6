"""Cash box reports and closings over all boxes and branches."""

from pyspark.sql import functions as F

from loanbook.functions.scalars import dec
from loanbook.operators import cash as C
from loanbook.plans.registry import CASH_DAY, CASH_RANGE, query
from loanbook.plans.sqlviews import m
from loanbook.sources import tables as T

A, Z = (f"DATE '{x}'" for x in CASH_RANGE)


def base(spark, d):
    return T.cash_payments(spark, d), T.boxes(spark), T.branches(spark, d)


def s(cond, amount="payamt"):
    return f"coalesce(sum({amount}) FILTER ({cond}), 0)"


IN = f"dateacct BETWEEN {A} AND {Z}"


def pos(extra="true"):
    return f"""
 pos AS MATERIALIZED (SELECT pay.ad_org_id, org_name AS sucursal, codcaja, nombrecaja,
  {s(f"dateacct < {A} AND docbasetype = 'ARR'")} - {s(f"dateacct < {A} AND docbasetype = 'APP'")} AS inicial,
  {s(f"{IN} AND chargetype_desc ILIKE '%transfer%' AND docbasetype = 'ARR'")} AS ingresos_transfer,
  {s(f"{IN} AND (chargetype_desc ILIKE '%inout%' OR c_doctype_id = 1000050) AND docbasetype = 'ARR'")} AS cobros,
  {s(f"{IN} AND chargetype_desc ILIKE '%transfer%' AND docbasetype = 'APP'")} AS egresos_transfer,
  {s(f"{IN} AND c_doctype_id = 1000009 AND c_charge_id NOT IN (1000034) AND docbasetype = 'APP'")} AS gastos,
  {s(f"{IN} AND c_doctype_id = 1000049 AND docbasetype = 'APP'")} AS desembolsos,
  {s("docbasetype = 'ARR'")} - {s("docbasetype = 'APP'")} AS final
 FROM pay JOIN boxes USING (c_bankaccount_id) JOIN branches ON branches.ad_org_id = pay.ad_org_id LEFT JOIN charges USING (c_charge_id)
 WHERE docstatus IN ('CO','CL') AND dateacct <= {Z} AND {extra} GROUP BY 1, 2, 3, 4)"""


MONEY = ", ".join(f"{m(c)} AS {c}" for c in C.MEASURES)


@query("cash_global", f"WITH {pos()} SELECT ad_org_id, sucursal, codcaja, nombrecaja, {MONEY} FROM pos")
def cash_global(spark, d):
    p, b, o = base(spark, d)
    return C.positions(p, T.charges(spark), b, o, *CASH_RANGE)


@query("cash_global_collectors", f"""
WITH {pos("tipocaja = 'COBRADOR'")}
SELECT sucursal, codcaja, CAST(GROUPING(sucursal, codcaja) AS BIGINT) AS nivel, {', '.join(f"{m(f'sum({c})')} AS {c}" for c in C.MEASURES)}
FROM pos GROUP BY ROLLUP(sucursal, codcaja)""")
def cash_global_collectors(spark, d):
    p, b, o = base(spark, d)
    return C.position_subtotals(C.positions(p, T.charges(spark), b, o, *CASH_RANGE, collectors_only=True))


def dlv(collected, where="true", pays="pay"):
    return f"""
 dlv0 AS (SELECT p.dateacct, p.ad_org_id, org_name AS orgname, c_bankaccount_id, codcaja, nombrecaja, tipocaja, box_org_id,
  {s("docbasetype = 'ARR' AND c_charge_id = 1000034")} AS basediaria, {s("docbasetype = 'APP' AND c_charge_id = 1000030")} AS desembolsos,
  {s(f"docbasetype = 'ARR' AND {collected}")} AS cobros, {s("docbasetype = 'APP' AND c_charge_id NOT IN (1000034, 1000030)")} AS gastos,
  {s("docbasetype = 'ARR' AND c_charge_id = 1000034")} AS recibidos, {s("docbasetype = 'APP' AND c_charge_id = 1000034")} AS enviados,
  {s("docbasetype = 'APP' AND c_charge_id = 1000034 AND tipocaja ILIKE '%sucursal%'")} AS enviados_central
 FROM {pays} p JOIN boxes USING (c_bankaccount_id) JOIN branches ON branches.ad_org_id = p.ad_org_id
 WHERE docstatus IN ('CO','CL') AND {where} GROUP BY ALL),
 dlv AS MATERIALIZED (SELECT d.*, basediaria - desembolsos + cobros - gastos AS efectivo, basediaria - desembolsos + cobros - gastos - enviados AS saldocaja,
  c.c_bankaccount_id AS cajadestinoid, c.codcaja || '-' || c.nombrecaja AS cajadestinoname
 FROM dlv0 d LEFT JOIN boxes c ON c.tipocaja = 'SUCURSAL' AND c.box_org_id = d.box_org_id)"""


DLV_COLS = "dateacct, ad_org_id, orgname, c_bankaccount_id, codcaja, nombrecaja, tipocaja, cajadestinoid, cajadestinoname, " + ", ".join(
    f"{m(c)} AS {c}" for c in ("basediaria", "desembolsos", "cobros", "gastos", "efectivo", "recibidos", "enviados", "enviados_central", "saldocaja"))


@query("cash_deliveries", f"WITH {dlv('c_invoice_id IS NOT NULL')} SELECT {DLV_COLS} FROM dlv")
def cash_deliveries(spark, d):
    return C.deliveries(*base(spark, d))


@query("cash_preclose_check", f"""
WITH n AS (
 SELECT ad_org_id, 'a' AS k FROM loans WHERE montototal > 0 AND synced = 'N' AND origen = 'native' AND fecha <= DATE '{CASH_DAY}'
 UNION ALL SELECT ad_org_id, 'b' FROM cobros WHERE abono > 0 AND synced = 'N' AND origen = 'native' AND operacion <= DATE '{CASH_DAY}'
 UNION ALL SELECT ad_org_id, 'c' FROM pay WHERE docstatus = 'DR' AND dateacct <= DATE '{CASH_DAY}'
 UNION ALL SELECT ad_org_id, 'd' FROM invoices WHERE docstatus = 'DR' AND dateinvoiced <= DATE '{CASH_DAY}')
SELECT ad_org_id, count(*) FILTER (k = 'a') AS desembolsos, count(*) FILTER (k = 'b') AS cobros, count(*) FILTER (k = 'c') AS pagos,
 count(*) FILTER (k = 'd') AS facturas, count(*) AS total FROM n GROUP BY 1""")
def cash_preclose_check(spark, d):
    return C.preclose_counts(T.loans(spark, d), T.collections(spark, d), T.cash_payments(spark, d),
                             T.invoices(spark, d), CASH_DAY)


# Receipts weigh twenty times more here, so that most boxes end a day with a balance.
STRONG = """
 strong AS MATERIALIZED (SELECT * REPLACE (CAST(payamt * CASE WHEN c_doctype_id = 1000050 THEN 20 ELSE 1 END AS DECIMAL(18,2)) AS payamt) FROM pay)"""


def strong(spark, d):
    p = T.cash_payments(spark, d)
    return p.withColumn("payamt", F.when(F.col("c_doctype_id") == 1000050, F.col("payamt") * dec("20", "decimal(2,0)"))
                        .otherwise(F.col("payamt")).cast("decimal(18,2)"))


COLLECTOR_DAYS = dlv("c_doctype_id = 1000050", "tipocaja ILIKE '%cobrador%'", "strong")
TRANSFER = f"""SELECT dateacct, ad_org_id, c_bankaccount_id AS origen,
 'Cierre de Caja ' || codcaja || '-' || nombrecaja || ' al: ' || strftime(dateacct, '%d/%m/%Y') AS description, 1000034 AS c_charge_id,
 0 AS c_bpartner_id, {m('saldocaja')} AS payamt"""


def transfers(source):
    return f"""
 {TRANSFER}, c_bankaccount_id, 1000009 AS c_doctype_id, 'APP' AS docbasetype FROM {source} WHERE saldocaja > 0 AND enviados_central <= 0
 UNION ALL {TRANSFER}, cajadestinoid, 1000008, 'ARR' FROM {source} WHERE saldocaja > 0 AND enviados_central <= 0"""


CLOSABLE = "good AS (SELECT * FROM (SELECT *, min(saldocaja) OVER (PARTITION BY dateacct, ad_org_id) AS worst FROM dlv) WHERE worst >= 0)"


def _strong_days(spark, d):
    return C.deliveries(strong(spark, d), T.boxes(spark), T.branches(spark, d),
                        collections_by="doctype", collectors_only=True)


@query("cash_close", f"WITH {STRONG}, {COLLECTOR_DAYS}, {CLOSABLE} {transfers('good')}")
def cash_close(spark, d):
    return C.closings(_strong_days(spark, d))[0]


@query("cash_close_rejects", f"""
WITH {STRONG}, {COLLECTOR_DAYS}
SELECT dateacct, ad_org_id, c_bankaccount_id, codcaja, {m('saldocaja')} AS saldocaja FROM dlv WHERE saldocaja < 0""")
def cash_close_rejects(spark, d):
    return C.closings(_strong_days(spark, d))[1]


@query("cash_close_period", f"""
WITH {STRONG}, {dlv("c_doctype_id = 1000050", f"tipocaja ILIKE '%cobrador%' AND p.dateacct BETWEEN {A} AND {Z}", "strong")},
 fails AS (SELECT ad_org_id, min(dateacct) AS stop FROM (
  SELECT ad_org_id, dateacct FROM dlv WHERE saldocaja < 0
  UNION ALL SELECT ad_org_id, dateacct FROM pay WHERE docstatus = 'DR' AND dateacct >= DATE '2024-01-15') GROUP BY 1),
 good AS (SELECT dlv.* FROM dlv LEFT JOIN fails USING (ad_org_id) WHERE (stop IS NULL OR dateacct < stop)
  AND EXISTS (SELECT 1 FROM strong p WHERE p.ad_org_id = dlv.ad_org_id AND p.dateacct = dlv.dateacct AND p.payamt > 0))
{transfers('good')}""")
def cash_close_period(spark, d):
    p, b, o = base(spark, d)
    pending = p.filter((F.col("docstatus") == "DR") & (F.col("dateacct") >= F.lit("2024-01-15").cast("date"))).select(
        "ad_org_id", F.col("dateacct").alias("dia"))
    return C.closings_period(strong(spark, d), b, o, pending, *CASH_RANGE)[0]


@query("cash_reopen", f"""
WITH x AS (SELECT c_payment_id, ad_org_id, dateacct, payamt, docbasetype = 'APP' AND c_charge_id = 1000034 AS hit FROM pay)
SELECT c_payment_id, {m(f"CASE WHEN hit AND dateacct >= DATE '{CASH_DAY}' AND payamt > 0 THEN 0 ELSE payamt END")} AS payamt,
 coalesce(hit AND dateacct >= DATE '{CASH_DAY}' AND payamt > 0, false) AS reabierto FROM x""")
def cash_reopen(spark, d):
    p = T.cash_payments(spark, d).withColumn("description", F.when(
        F.col("docbasetype") == "APP", F.concat(F.lit("Cierre de Caja "), F.col("c_bankaccount_id").cast("string"))))
    return C.reopen(p, CASH_DAY).select("c_payment_id", "payamt", "reabierto")


MOVES = """
 mv AS MATERIALIZED (SELECT c_payment_id, ad_org_id AS codsucursal, org_name AS sucursal, c_bankaccount_id, nombrecaja AS caja, tipocaja,
  dateacct AS fecha, CASE c_doctype_id WHEN 1000050 THEN 'Cobro' WHEN 1000049 THEN 'Desembolso' ELSE 'Gasto' END AS tipomov, payamt AS monto
 FROM pay JOIN branches USING (ad_org_id) JOIN boxes USING (c_bankaccount_id)
 WHERE docstatus IN ('CO','CL') AND (c_doctype_id IN (1000050, 1000049) OR (c_doctype_id = 1000009 AND c_charge_id IS DISTINCT FROM 1000034)))"""


def moves(spark, d):
    p, b, o = base(spark, d)
    return C.movements(p, o, b)


@query("cash_movements", f"""
WITH {MOVES} SELECT c_payment_id, codsucursal, sucursal, c_bankaccount_id, caja, tipocaja, fecha, tipomov, {m('monto')} AS monto FROM mv""")
def cash_movements(spark, d):
    return moves(spark, d)


TYPES = f"""{s("tipomov = 'Cobro'", 'monto')} AS cobros, {s("tipomov = 'Desembolso'", 'monto')} AS desembolsos,
 {s("tipomov = 'Gasto'", 'monto')} AS gastos,
 {s("tipomov = 'Cobro'", 'monto')} - {s("tipomov = 'Desembolso'", 'monto')} - {s("tipomov = 'Gasto'", 'monto')} AS saldo"""
FOUR = ("cobros", "desembolsos", "gastos", "saldo")


@query("cash_daily_branch", f"""
WITH {MOVES}, x AS (SELECT fecha, sucursal, CAST(GROUPING(fecha, sucursal) AS BIGINT) AS nivel, {TYPES} FROM mv
 WHERE fecha BETWEEN {A} AND {Z} GROUP BY CUBE(fecha, sucursal))
SELECT fecha, sucursal, nivel, {', '.join(f'{m(c)} AS {c}' for c in FOUR)} FROM x""")
def cash_daily_branch(spark, d):
    return C.daily_by_branch(moves(spark, d), *CASH_RANGE)


BOXDAY = f"""bd AS MATERIALIZED (SELECT caja, fecha, {TYPES} FROM mv WHERE fecha BETWEEN {A} AND {Z} AND tipocaja = 'COBRADOR' GROUP BY 1, 2)"""


@query("cash_daily_box", f"WITH {MOVES}, {BOXDAY} SELECT caja, fecha, {', '.join(f'{m(c)} AS {c}' for c in FOUR)} FROM bd")
def cash_daily_box(spark, d):
    return C.daily_by_box(moves(spark, d), *CASH_RANGE)


@query("cash_daily_box_means", f"""
WITH {MOVES}, {BOXDAY}
SELECT caja, count(DISTINCT fecha) AS dias, {', '.join(f"{m(f'sum({c})')} AS {c}_total" for c in FOUR)},
 {', '.join(f"round(avg({c}::DOUBLE), 4) AS {c}_prom" for c in FOUR)},
 {', '.join(f"round(sum({c})::DOUBLE / count(DISTINCT fecha), 4) AS {c}_prom_dia" for c in FOUR)}
FROM bd GROUP BY ROLLUP(caja)""")
def cash_daily_box_means(spark, d):
    return C.box_means(C.daily_by_box(moves(spark, d), *CASH_RANGE))


CHARGED = f"""
 ch AS MATERIALIZED (SELECT * FROM pay JOIN charges USING (c_charge_id) JOIN branches USING (ad_org_id) JOIN boxes USING (c_bankaccount_id)
 WHERE {IN} AND NOT chargetype ILIKE '%cartera%' AND NOT chargetype ILIKE '%cajas%')"""


def _by_charge(spark, d):
    return C.by_charge(T.cash_payments(spark, d), T.charges(spark), T.branches(spark, d), *CASH_RANGE)


@query("cash_payments_by_charge", f"""
WITH {CHARGED}, x AS (SELECT ad_org_id, org_name AS sucursal, c_charge_id, cargo, sum(payamt) AS monto FROM ch GROUP BY 1, 2, 3, 4)
SELECT ad_org_id, sucursal, c_charge_id, cargo, {m('monto')} AS monto,
 CAST((2 * CAST(monto * 100 AS HUGEINT) + 35) // 70 AS DOUBLE) / 100 AS montousd FROM x""")
def cash_payments_by_charge(spark, d):
    return _by_charge(spark, d)


# Names of the branches, the columns of the crosstab.
NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("cash_payments_by_charge_pivot", f"""
WITH {CHARGED} SELECT cargo, {', '.join(f'''{m(f"sum(payamt) FILTER (org_name = '{n}')")} AS "{n}"''' for n in NAMES)} FROM ch GROUP BY 1""")
def cash_payments_by_charge_pivot(spark, d):
    return C.by_charge_pivot(_by_charge(spark, d), NAMES)


def _detail(spark, d):
    p, b, o = base(spark, d)
    return C.charge_detail(p, T.charges(spark), o, b, *CASH_RANGE)


@query("cash_payments_detail", f"""
WITH {CHARGED} SELECT ad_org_id, org_name AS sucursal, c_charge_id, cargo, dateacct AS fecha, c_payment_id AS documento, nombrecaja AS caja,
 {m('payamt')} AS monto, c_bpartner_id FROM ch""")
def cash_payments_detail(spark, d):
    return _detail(spark, d)


@query("cash_payments_detail_totals", f"""
WITH {CHARGED} SELECT org_name AS sucursal, cargo, CAST(GROUPING(org_name, cargo) AS BIGINT) AS nivel, count(*) AS pagos,
 {m('sum(payamt)')} AS monto FROM ch GROUP BY ROLLUP(org_name, cargo)""")
def cash_payments_detail_totals(spark, d):
    return C.charge_subtotals(_detail(spark, d))


