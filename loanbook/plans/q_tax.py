"""Fiscal reports over all periods."""

from loanbook import config
from loanbook.operators import tax as X
from loanbook.plans.registry import query
from loanbook.plans.sqlviews import m
from loanbook.sources import tables as T

GREETING = 2


def mul(f):
    net = "abono * CAST(0.85 AS DECIMAL(3,2))"
    return ", ".join([f"round({net}, 2) AS neto"] + [
        f"round({net} * CAST({x} AS DECIMAL(3,2)), 2) AS {n}"
        for n, x in (("intereses", f.interest), ("comision", f.commission), ("ingresosfinancieros", f.income))])


def half(num, den):
    return f"(CAST((2 * CAST(abono * 100 AS HUGEINT) * {num} + {den}) // (2 * {den}) AS DECIMAL(24,0)) * CAST(0.01 AS DECIMAL(3,2)))"


# Dividing by 1.15 and then by a factor, as whole-number fractions.
DIV = (f"{half(100, 115)} AS neto, {half(10000, 115 * 13)} AS intereses, {half(10000, 115 * 102)} AS comision,"
       f" {half(10000, 115 * 15)} AS ingresosfinancieros")
KEY_END = "CAST(strftime(enddate, '%Y%m') AS INTEGER)"
KEY_LOAN = "CAST(strftime(l.fecha, '%Y%m') AS INTEGER)"
BACK = "strftime(enddate - INTERVAL 4 MONTH, '%Y%m')"
OLD_INT = f"{KEY_END} - {KEY_LOAN} >= 4"
OLD_MONTHS = "(year(enddate) * 12 + month(enddate)) - (year(l.fecha) * 12 + month(l.fecha)) >= 4"


def voucher_sql(split, old, merged, extra=""):
    return f"""
WITH rows AS (SELECT c.operacion AS fecha, c_period_id, name, {KEY_END} AS cobmes_int, abono,
  CASE WHEN {old} THEN ' <=' || {BACK} ELSE strftime(l.fecha, '%Y%m') END AS credmes_str,
  CASE WHEN {old} THEN {merged} ELSE {KEY_LOAN} END AS credmes_int, {split}
 FROM cobros c JOIN periods p ON c.operacion BETWEEN startdate AND enddate JOIN loans l ON l.legacy_cartera_id = c.id_cartera {extra})
SELECT fecha, c_period_id, name, cobmes_int, credmes_str, CAST(credmes_int AS INTEGER) AS credmes_int, {m('sum(abono)')} AS bruto, {m('sum(neto)')} AS neto,
 {m('sum(intereses)')} AS intereses, {m('sum(comision)')} AS comision, {m('sum(ingresosfinancieros)')} AS ingresosfinancieros
FROM rows GROUP BY 1, 2, 3, 4, 5, 6"""


def args(spark, d):
    return T.collections(spark, d), T.loans(spark, d), T.partners(spark, d), T.periods(spark)


@query("tax_voucher", voucher_sql(mul(config.MULTIPLY_FACTORS), OLD_MONTHS, f"CAST({BACK} AS INTEGER)"))
def tax_voucher(spark, d):
    return X.voucher(*args(spark, d))


@query("tax_voucher_yyyymm", voucher_sql(
    mul(config.MULTIPLY_FACTORS), OLD_INT, f"{KEY_END} - 4",
    f"JOIN partners bp ON bp.c_bpartner_id = l.c_bpartner_id AND c_greeting_id = {GREETING}"))
def tax_voucher_yyyymm(spark, d):
    return X.voucher(*args(spark, d), cohort_mode="yyyymm_int", greeting=GREETING)


@query("tax_voucher_divide", voucher_sql(DIV, OLD_INT, f"{KEY_END} - 4"))
def tax_voucher_divide(spark, d):
    return X.voucher(*args(spark, d), factors=config.DIVIDE_FACTORS, cohort_mode="yyyymm_int")


@query("tax_detail", f"""
WITH rows AS (SELECT operacion AS fecha, legacy_cobro_id, abono, startdate, enddate, name, {mul(config.MULTIPLY_FACTORS)}
 FROM cobros JOIN periods ON operacion BETWEEN startdate AND enddate)
SELECT fecha, legacy_cobro_id, 'Ingresos Financieros clientes varios' AS concepto, {m('abono')} AS bruto, {m('neto')} AS neto,
 {m('intereses')} AS intereses, {m('comision')} AS comision, {m('ingresosfinancieros')} AS ingresosfinancieros, startdate, enddate,
 name AS periodname FROM rows""")
def tax_detail(spark, d):
    return X.detail(*args(spark, d))


DAYS = [f"1998-06-{i:02d}" for i in range(1, 31)]


@query("tax_list", f"""
SELECT c_bpartner_id, codigo, nombre AS nombrecliente, legacy_cartera_id AS creditoid, {m('montototal')} AS montototal,
 {', '.join(f'''{m(f"sum(abono) FILTER (operacion = DATE '{x}')")} AS "{x}"''' for x in DAYS)}
FROM cobros JOIN loans ON legacy_cartera_id = id_cartera JOIN partners USING (c_bpartner_id)
WHERE operacion BETWEEN DATE '1998-06-01' AND DATE '1998-06-30' GROUP BY 1, 2, 3, 4, montototal""")
def tax_list(spark, d):
    c, ln, p, periods = args(spark, d)
    return X.matrix(c, ln, p, periods.filter("c_period_id = 199806"), DAYS)
