"""Fiscal reports: collections matched to accounting periods and split by fixed factors."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import config
from loanbook.functions.dates import period_key
from loanbook.functions.scalars import dec

CALC = "decimal(28,10)"


def in_periods(collections, periods) -> DataFrame:
    """Collections with the period that contains their day.

    Each period is listed once per month it touches (a small table), so the range join is an
    equi join on the month plus a check of the bounds.
    """
    months = periods.withColumn("_month", F.explode(F.sequence(
        F.trunc("startdate", "month"), F.trunc("enddate", "month"), F.expr("INTERVAL 1 MONTH"))))
    c = collections.drop("c_bpartner_id").withColumn("_month", F.trunc("operacion", "month"))
    return c.join(months, "_month").filter(
        F.col("operacion").between(F.col("startdate"), F.col("enddate"))).drop("_month")


def _apply(amount: Column, factor: str, divide: bool) -> Column:
    f = dec(factor, "decimal(4,2)")
    return (amount / f if divide else amount * f).cast(CALC)


def fiscal_split(f: config.FiscalFactors) -> list[Column]:
    """Net, interest, commission and income of a collection, each rounded to cents."""
    net = _apply(F.col("abono").cast("decimal(18,2)"), f.net, f.divide)
    parts = {"neto": net, "intereses": _apply(net, f.interest, f.divide),
             "comision": _apply(net, f.commission, f.divide),
             "ingresosfinancieros": _apply(net, f.income, f.divide)}
    return [F.round(c, 2).cast("decimal(18,2)").alias(n) for n, c in parts.items()]


def _greeting(rows, partners, greeting) -> DataFrame:
    if greeting is None:
        return rows
    keep = partners.filter(F.col("c_greeting_id") == greeting).select("c_bpartner_id")
    return rows.join(keep, "c_bpartner_id", "left_semi")


def cohort(mode: str, merge_after: int = 4) -> list[Column]:
    """Month of the loan; months at least ``merge_after`` before the period become one cohort.

    'months' counts calendar months. 'yyyymm_int' subtracts the YYYYMM integers, which is
    wrong across years but is what the printed report does.
    """
    loan, end = F.col("fecha"), F.col("enddate")
    loan_key, end_key = period_key(loan), period_key(end)
    if mode == "yyyymm_int":
        old = end_key - loan_key >= merge_after
        merged = end_key - merge_after
    elif mode == "months":
        old = F.months_between(F.trunc(end, "month"), F.trunc(loan, "month")) >= merge_after
        merged = period_key(end, merge_after)
    else:
        raise ValueError(f"unknown cohort mode {mode!r}")
    label = F.concat(F.lit(" <="), F.date_format(F.add_months(end, -merge_after), "yyyyMM"))
    return [F.when(old, label).otherwise(F.date_format(loan, "yyyyMM")).alias("credmes_str"),
            F.when(old, merged).otherwise(loan_key).cast("int").alias("credmes_int")]


def voucher(collections, loans, partners, periods, factors=config.MULTIPLY_FACTORS,
            cohort_mode: str = "months", greeting=None) -> DataFrame:
    """Day x loan-month cohort: gross, net, interest, commission and financial income."""
    amounts = ["bruto", "neto", "intereses", "comision", "ingresosfinancieros"]
    place = ["operacion", "c_period_id", "name", "enddate"]
    # Each collection is split and rounded; its loan then sees one row for each day.
    rows = in_periods(collections, periods).select(
        "id_cartera", *place, F.col("abono").alias("bruto"), *fiscal_split(factors))
    daily = rows.groupBy("id_cartera", *place).agg(*[F.sum(c).alias(c) for c in amounts])
    ln = loans.select(F.col("legacy_cartera_id").alias("id_cartera"), "c_bpartner_id", "fecha")
    split = _greeting(daily.join(ln, "id_cartera"), partners, greeting).select(*place, *amounts, *cohort(cohort_mode))
    return split.groupBy(F.col("operacion").alias("fecha"), "c_period_id", "name",
                         period_key(F.col("enddate")).alias("cobmes_int"), "credmes_str", "credmes_int").agg(
        *[F.sum(c).alias(c) for c in amounts])


def detail(collections, loans, partners, periods, factors=config.MULTIPLY_FACTORS, greeting=None) -> DataFrame:
    """One row per collection with its split."""
    rows = in_periods(collections, periods)
    if greeting is not None:
        ln = loans.select(F.col("legacy_cartera_id").alias("id_cartera"), "c_bpartner_id")
        rows = _greeting(rows.join(ln, "id_cartera"), partners, greeting)
    return rows.select(
        F.col("operacion").alias("fecha"), "legacy_cobro_id",
        F.lit("Ingresos Financieros clientes varios").alias("concepto"), F.col("abono").alias("bruto"),
        *fiscal_split(factors), "startdate", "enddate", F.col("name").alias("periodname"))


def matrix(collections, loans, partners, period, days: list[str], greeting=None) -> DataFrame:
    """Client and credit by day: one column per day of the period."""
    ln = loans.select(F.col("legacy_cartera_id").alias("id_cartera"), "c_bpartner_id", "montototal")
    inside = in_periods(collections, period)
    # Summed per loan and day first: the pivot then sees one row per cell.
    cells = inside.groupBy("id_cartera", "operacion").agg(F.sum("abono").alias("abono")).join(ln, "id_cartera")
    cells = _greeting(cells, partners, greeting).withColumn("dia", F.date_format("operacion", "yyyy-MM-dd"))
    wide = cells.groupBy("c_bpartner_id", "id_cartera", "montototal").pivot("dia", days).agg(F.sum("abono"))
    return wide.join(partners.select("c_bpartner_id", "codigo", F.col("nombre").alias("nombrecliente")),
                     "c_bpartner_id").withColumnRenamed("id_cartera", "creditoid")
