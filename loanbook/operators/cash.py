"""Cash boxes: positions, closings and daily behaviour."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanbook import config
from loanbook.functions.scalars import fixed_fx, regex_match
from loanbook.operators.balances import day

DONE = ("CO", "CL")


def _total(cond: Column, amount: str = "payamt") -> Column:
    """Sum where a condition holds; a null condition does not count."""
    return F.coalesce(F.sum(F.when(cond, F.col(amount))), F.lit(0).cast("decimal(18,2)"))


def _with_charges(payments, charges) -> DataFrame:
    return payments.join(charges, "c_charge_id", "left")


def positions(payments, charges, boxes, branches, start, end, collectors_only: bool = False) -> DataFrame:
    """Per branch and box: opening, transfers, collections, expenses, disbursements, closing."""
    p = payments.filter(F.col("docstatus").isin(*DONE) & (F.col("dateacct") <= day(end)))
    inn, out = F.col("docbasetype") == "ARR", F.col("docbasetype") == "APP"
    before = F.col("dateacct") < day(start)
    inside = F.col("dateacct").between(day(start), day(end))
    transfer = regex_match(F.col("chargetype_desc"), "transfer")
    receipt = regex_match(F.col("chargetype_desc"), "inout") | (F.col("c_doctype_id") == config.DOC_RECEIPT)
    expense = (F.col("c_doctype_id") == config.DOC_EXPENSE) & ~F.col("c_charge_id").isin(config.CHARGE_TRANSFER)
    rows = _with_charges(p, charges).groupBy("ad_org_id", "c_bankaccount_id").agg(
        (_total(before & inn) - _total(before & out)).alias("inicial"),
        _total(inside & transfer & inn).alias("ingresos_transfer"),
        _total(inside & receipt & inn).alias("cobros"),
        _total(inside & transfer & out).alias("egresos_transfer"),
        _total(inside & expense & out).alias("gastos"),
        _total(inside & (F.col("c_doctype_id") == config.DOC_DISBURSEMENT) & out).alias("desembolsos"),
        (_total(inn) - _total(out)).alias("final"))
    b = boxes
    if collectors_only:
        b = b.filter(regex_match(F.col("tipocaja"), "cobrador"))
    return rows.join(b.select("c_bankaccount_id", "codcaja", "nombrecaja"), "c_bankaccount_id").join(
        branches, "ad_org_id").withColumnRenamed("org_name", "sucursal").drop("c_bankaccount_id")


MEASURES = ["inicial", "ingresos_transfer", "cobros", "egresos_transfer", "gastos", "desembolsos", "final"]


def position_subtotals(rows) -> DataFrame:
    """Positions with branch subtotals and a grand total."""
    return rows.rollup("sucursal", "codcaja").agg(
        F.grouping_id().cast("bigint").alias("nivel"), *[F.sum(c).alias(c) for c in MEASURES])


def deliveries(payments, boxes, branches, on_day=None, org=None, collections_by: str = "invoice",
               collectors_only: bool = False) -> DataFrame:
    """Day position of each box: base, disbursed, collected, spent, cash, sent, balance, target."""
    p = payments.filter(F.col("docstatus").isin(*DONE))
    if on_day is not None:
        p = p.filter(F.col("dateacct") == day(on_day))
    if org is not None:
        p = p.filter(F.col("ad_org_id") == org)
    inn, out = F.col("docbasetype") == "ARR", F.col("docbasetype") == "APP"
    charge = F.col("c_charge_id")
    collected = (F.col("c_invoice_id").isNotNull() if collections_by == "invoice"
                 else F.col("c_doctype_id") == config.DOC_RECEIPT)
    p = p.join(boxes, "c_bankaccount_id")
    if collectors_only:
        p = p.filter(regex_match(F.col("tipocaja"), "cobrador"))
    moved = charge == config.CHARGE_TRANSFER
    rows = p.groupBy("dateacct", "ad_org_id", "c_bankaccount_id", "codcaja", "nombrecaja", "tipocaja",
                     "box_org_id").agg(
        _total(inn & moved).alias("basediaria"),
        _total(out & (charge == config.CHARGE_DISBURSEMENT)).alias("desembolsos"),
        _total(inn & collected).alias("cobros"),
        _total(out & ~charge.isin(config.CHARGE_TRANSFER, config.CHARGE_DISBURSEMENT)).alias("gastos"),
        _total(inn & moved).alias("recibidos"),
        _total(out & moved).alias("enviados"),
        _total(out & moved & regex_match(F.col("tipocaja"), "sucursal")).alias("enviados_central"))
    cash = F.col("basediaria") - F.col("desembolsos") + F.col("cobros") - F.col("gastos")
    central = boxes.filter(regex_match(F.col("tipocaja"), "sucursal")).select(
        "box_org_id", F.col("c_bankaccount_id").alias("cajadestinoid"),
        F.concat_ws("-", "codcaja", "nombrecaja").alias("cajadestinoname"))
    return (
        rows.withColumn("efectivo", cash).withColumn("saldocaja", F.col("efectivo") - F.col("enviados"))
        .join(central, "box_org_id", "left")
        .join(branches, "ad_org_id").withColumnRenamed("org_name", "orgname").drop("box_org_id")
    )


def preclose_counts(loans, collections, payments, invoices, as_of) -> DataFrame:
    """Per branch: pending loans and collections, draft payments and invoices up to a day."""
    def part(df, cond, kind):
        return df.filter(cond).groupBy("ad_org_id").agg(F.count(F.lit(1)).alias(kind))

    native = (F.col("synced") == "N") & (F.col("origen") == "native")
    parts = {
        "desembolsos": part(loans, native & (F.col("montototal") > 0) & (F.col("fecha") <= day(as_of)), "n"),
        "cobros": part(collections, native & (F.col("abono") > 0) & (F.col("operacion") <= day(as_of)), "n"),
        "pagos": part(payments, (F.col("docstatus") == "DR") & (F.col("dateacct") <= day(as_of)), "n"),
        "facturas": part(invoices, (F.col("docstatus") == "DR") & (F.col("dateinvoiced") <= day(as_of)), "n"),
    }
    rows = None
    for kind, df in parts.items():
        one = df.withColumn("tipo", F.lit(kind))
        rows = one if rows is None else rows.unionByName(one)
    sums = [F.sum(F.when(F.col("tipo") == k, F.col("n")).otherwise(0)).alias(k) for k in parts]
    return rows.groupBy("ad_org_id").agg(*sums, F.sum("n").alias("total"))


def closings(position, partner_id: int = 0):
    """Transfers that close the collectors' boxes, from ``deliveries`` of one or more days.

    Returns (transfers, refused). A branch and day with a negative box is refused as a whole.
    Each box with a positive balance and no earlier transfer to the central box that day
    gives one row out of it and one into the target box.
    """
    w = W.partitionBy("dateacct", "ad_org_id")
    # One row per box, so the window holds the boxes of one branch and day.
    marked = position.withColumn("_worst", F.min("saldocaja").over(w))
    refused = marked.filter((F.col("_worst") < 0) & (F.col("saldocaja") < 0)).select(
        "dateacct", "ad_org_id", "c_bankaccount_id", "codcaja", "saldocaja")
    due = marked.filter((F.col("_worst") >= 0) & (F.col("saldocaja") > 0) & (F.col("enviados_central") <= 0))
    pair = F.array(
        F.struct(F.col("c_bankaccount_id").alias("box"), F.lit(config.DOC_EXPENSE).alias("c_doctype_id"),
                 F.lit("APP").alias("docbasetype")),
        F.struct(F.col("cajadestinoid").alias("box"), F.lit(config.DOC_TRANSFER_IN).alias("c_doctype_id"),
                 F.lit("ARR").alias("docbasetype")))
    text = F.concat(F.lit("Cierre de Caja "), F.col("codcaja"), F.lit("-"), F.col("nombrecaja"),
                    F.lit(" al: "), F.date_format("dateacct", "dd/MM/yyyy"))
    transfers = due.select(
        "dateacct", "ad_org_id", F.col("c_bankaccount_id").alias("origen"), text.alias("description"),
        F.lit(config.CHARGE_TRANSFER).alias("c_charge_id"), F.lit(partner_id).alias("c_bpartner_id"),
        F.col("saldocaja").alias("payamt"), F.inline(pair)).withColumnRenamed("box", "c_bankaccount_id")
    return transfers, refused


def closings_period(payments, boxes, branches, pending_days, start, end):
    """Closings of each day with payments in a range, up to the first day that fails.

    ``pending_days``: ad_org_id, dia of every item still pending; a branch stops at the first
    day with a pending item up to it or a negative box, and keeps the earlier days.
    """
    p = payments.filter(F.col("dateacct").between(day(start), day(end)))
    # Only days with a positive payment, in whatever status, are visited.
    visited = p.filter(F.col("payamt") > 0).select("dateacct", "ad_org_id").distinct()
    position = deliveries(p, boxes, branches, collections_by="doctype", collectors_only=True).join(
        visited, ["dateacct", "ad_org_id"], "left_semi")
    pending_from = pending_days.groupBy("ad_org_id").agg(F.min("dia").alias("dia"))
    # The first visited day on or after the first pending item fails.
    negative_from = position.filter(F.col("saldocaja") < 0).groupBy("ad_org_id").agg(
        F.min("dateacct").alias("dia"))
    stop = pending_from.unionByName(negative_from).groupBy("ad_org_id").agg(F.min("dia").alias("stop"))
    kept = position.join(stop, "ad_org_id", "left").filter(
        F.col("stop").isNull() | (F.col("dateacct") < F.col("stop"))).drop("stop")
    return closings(kept)[0], stop


def reopen(payments, since, org=None) -> DataFrame:
    """Payments with the closing transfers from a day on set to zero."""
    hit = (
        regex_match(F.col("description"), "cierre") & (F.col("dateacct") >= day(since))
        & (F.col("payamt") > 0) & (F.col("c_charge_id") == config.CHARGE_TRANSFER))
    if org is not None:
        hit = hit & (F.col("ad_org_id") == org)
    return payments.withColumn("reabierto", F.coalesce(hit, F.lit(False))).withColumn(
        "payamt", F.when(F.col("reabierto"), F.lit(0).cast("decimal(18,2)")).otherwise(F.col("payamt")))


def movements(payments, branches, boxes) -> DataFrame:
    """Collections, disbursements and expenses as one typed list of movements."""
    kind = (
        F.when(F.col("c_doctype_id") == config.DOC_RECEIPT, "Cobro")
        .when(F.col("c_doctype_id") == config.DOC_DISBURSEMENT, "Desembolso")
        .when((F.col("c_doctype_id") == config.DOC_EXPENSE)
              & ~F.col("c_charge_id").eqNullSafe(F.lit(config.CHARGE_TRANSFER)), "Gasto"))
    return (
        payments.filter(F.col("docstatus").isin(*DONE)).withColumn("tipomov", kind)
        .filter(F.col("tipomov").isNotNull())
        .join(branches, "ad_org_id").join(boxes, "c_bankaccount_id")
        .select("c_payment_id", F.col("ad_org_id").alias("codsucursal"), F.col("org_name").alias("sucursal"),
                "c_bankaccount_id", F.col("nombrecaja").alias("caja"), "tipocaja",
                F.col("dateacct").alias("fecha"), "tipomov", F.col("payamt").alias("monto"))
    )


def _by_type() -> list[Column]:
    def t(kind):
        return F.sum(F.when(F.col("tipomov") == kind, F.col("monto")).otherwise(F.lit(0).cast("decimal(18,2)")))
    return [t("Cobro").alias("cobros"), t("Desembolso").alias("desembolsos"), t("Gasto").alias("gastos"),
            (t("Cobro") - t("Desembolso") - t("Gasto")).alias("saldo")]


def daily_by_branch(moves, start, end) -> DataFrame:
    """Day x branch amounts with totals per day, per branch and overall."""
    fine = moves.filter(F.col("fecha").between(day(start), day(end))).groupBy("fecha", "sucursal").agg(*_by_type())
    return fine.cube("fecha", "sucursal").agg(
        F.grouping_id().cast("bigint").alias("nivel"),
        *[F.sum(c).alias(c) for c in ("cobros", "desembolsos", "gastos", "saldo")])


def daily_by_box(moves, start, end, org=None) -> DataFrame:
    """Day x collector box amounts."""
    m = moves.filter(F.col("fecha").between(day(start), day(end)) & (F.col("tipocaja") == "COBRADOR"))
    if org is not None:
        m = m.filter(F.col("codsucursal") == org)
    return m.groupBy("caja", "fecha").agg(*_by_type())


def box_means(daily) -> DataFrame:
    """Per box and overall: totals, mean per row and mean per distinct day."""
    names = ["cobros", "desembolsos", "gastos", "saldo"]
    sums = [F.sum(c).cast("decimal(28,2)").alias(f"{c}_total") for c in names]
    means = [F.avg(F.col(c).cast("double")).alias(f"{c}_prom") for c in names]
    final = [(F.col(f"{c}_total").cast("double") / F.col("dias")).alias(f"{c}_prom_dia") for c in names]
    out = daily.rollup("caja").agg(F.countDistinct("fecha").alias("dias"), *sums, *means)
    return out.select("caja", "dias", *[f"{c}_total" for c in names], *[
        F.round(f"{c}_prom", 4).alias(f"{c}_prom") for c in names], *[
        F.round(c, 4).alias(f"{n}_prom_dia") for c, n in zip(final, names)])


def _charged(payments, charges, start, end) -> DataFrame:
    p = payments.filter(F.col("dateacct").between(day(start), day(end)))
    skip = regex_match(F.col("chargetype"), "cartera") | regex_match(F.col("chargetype"), "cajas")
    return p.join(charges, "c_charge_id").filter(~skip)


def by_charge(payments, charges, branches, start, end) -> DataFrame:
    """Charge x branch totals with their value at the fixed exchange rate."""
    rows = _charged(payments, charges, start, end).groupBy("ad_org_id", "c_charge_id", "cargo").agg(
        F.sum("payamt").cast("decimal(18,2)").alias("monto"))
    return rows.join(branches, "ad_org_id").select(
        "ad_org_id", F.col("org_name").alias("sucursal"), "c_charge_id", "cargo", "monto",
        fixed_fx(F.col("monto")).alias("montousd"))


def by_charge_pivot(rows, names: list[str]) -> DataFrame:
    """One line per charge, one column per branch."""
    return rows.groupBy("cargo").pivot("sucursal", names).agg(F.sum("monto"))


def charge_detail(payments, charges, branches, boxes, start, end, org=None) -> DataFrame:
    rows = _charged(payments, charges, start, end)
    if org is not None:
        rows = rows.filter(F.col("ad_org_id") == org)
    return rows.join(branches, "ad_org_id").join(boxes, "c_bankaccount_id").select(
        "ad_org_id", F.col("org_name").alias("sucursal"), "c_charge_id", "cargo",
        F.col("dateacct").alias("fecha"), F.col("c_payment_id").alias("documento"),
        F.col("nombrecaja").alias("caja"), F.col("payamt").alias("monto"), "c_bpartner_id")


def charge_subtotals(rows) -> DataFrame:
    fine = rows.groupBy("sucursal", "cargo").agg(F.count(F.lit(1)).alias("n"), F.sum("monto").alias("m"))
    return fine.rollup("sucursal", "cargo").agg(
        F.grouping_id().cast("bigint").alias("nivel"), F.sum("n").alias("pagos"), F.sum("m").alias("monto"))
