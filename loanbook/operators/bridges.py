"""Pending loans, collections and expenses turned into accounting documents.

Each bridge returns a dict of frames: the documents to add, the updates of the source rows
and the rejected rows with a reason. One record at a time becomes one pass over all of them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import config
from loanbook.functions.scalars import payment_term, pending
from loanbook.operators.balances import day, synced_balance
from loanbook.operators.interest import count, schedule_declining, schedule_flat, total_interest

# Charges of the invoice lines besides the principal.
CHARGE_INTEREST = 1000029
CHARGE_PAID_BEFORE = 1000032

AMT = "decimal(18,4)"


def _first_reason(checks: list[tuple[Column, str]]) -> Column:
    out = None
    for bad, text in checks:
        cond = F.coalesce(bad, F.lit(True))
        out = F.when(cond, text) if out is None else out.when(cond, text)
    return out


def _line(number: int, charge: int, amount: Column) -> Column:
    return F.struct(F.lit(number).alias("line"), F.lit(charge).alias("c_charge_id"),
                    amount.cast(AMT).alias("amount"))


def bridge_loans(loans, partners, users, branches, *, origin: str | None = "native",
                 approved_only: bool = True, org: int | None = None, lines: str = "principal",
                 box_of=None, dated: str | None = None, recompute: bool = True,
                 plan: str | None = "declining") -> dict[str, DataFrame]:
    """Pending loans to capital invoices, disbursements, schedules and row updates.

    ``lines``: 'principal', 'two' (principal, interest) or 'three' (also what was paid).
    ``box_of``: partner -> cash box frame when the box is not the user's own.
    ``dated``: one date for all documents instead of the loan date.
    ``recompute``: total from the interest formula; otherwise the stored total is kept.
    """
    c = loans.filter(pending(F.col("synced")))
    if origin is not None:
        c = c.filter(F.col("origen") == origin)
    if approved_only:
        c = c.filter(F.col("aprobado") == "Y")
    if org is not None:
        c = c.filter(F.col("ad_org_id") == org)
    p = partners.select("c_bpartner_id", "has_location", F.lit(True).alias("_bp"))
    b = branches.select("ad_org_id", F.lit(True).alias("_org"))
    j = c.join(p, "c_bpartner_id", "left").join(b, "ad_org_id", "left")
    if box_of is None:
        u = users.select(F.col("ad_user_id").alias("createdby"), F.lit(True).alias("_usr"),
                         F.col("c_bankaccount_id").alias("_box"))
        j = j.join(u, "createdby", "left")
    else:
        j = j.join(box_of.select("c_bpartner_id", F.col("c_bankaccount_id").alias("_box")),
                   "c_bpartner_id", "left").withColumn("_usr", F.lit(True))
    reason = _first_reason([
        (F.coalesce(F.col("local_id") > 0, F.lit(False)), "ya tiene documento"),
        (F.col("_org").isNull(), "sin sucursal"),
        (F.col("_bp").isNull(), "sin tercero"),
        (~F.col("has_location"), "tercero sin direccion"),
        (F.col("_usr").isNull(), "sin usuario"),
        (~(F.coalesce(F.col("_box"), F.lit(0)) > 0), "sin caja"),
        (F.col("monto").isNull() | ~(F.col("tasa") > 0) | F.col("fecha").isNull()
         | ~(F.col("dias_cre") > 0), "credito incompleto"),
    ])
    j = j.withColumn("motivo", reason)
    rejects = j.filter(F.col("motivo").isNotNull()).select("legacy_cartera_id", "c_bpartner_id", "motivo")
    good = j.filter(F.col("motivo").isNull())
    if recompute:
        good = good.withColumn("valorinteres", total_interest(F.col("monto"), F.col("tasa"), F.col("dias_cre"))
                               ).withColumn("montototal", (F.col("monto") + F.col("valorinteres")).cast(AMT))
    good = good.withColumn("local_id", F.col("legacy_cartera_id") * 10 + 1).withColumn(
        "payment_id", F.col("legacy_cartera_id") * 10 + 2).withColumn(
        "_on", F.col("fecha") if dated is None else day(dated))
    parts = [_line(10, config.CHARGE_PRINCIPAL, F.col("monto"))]
    if lines in ("two", "three"):
        parts.append(_line(20, CHARGE_INTEREST, F.col("montototal") - F.col("monto")
                           if lines == "two" else F.col("valorinteres")))
    if lines == "three":
        parts.append(_line(30, CHARGE_PAID_BEFORE, -F.col("abono")))
    invoice_lines = good.select(
        F.col("local_id").alias("c_invoice_id"), "legacy_cartera_id", "c_bpartner_id", "ad_org_id",
        F.lit(config.DOC_CAPITAL).alias("c_doctype_id"), F.col("_on").alias("dateinvoiced"),
        payment_term(F.col("dias_cre")).alias("c_paymentterm_id"), F.inline(F.array(*parts)))
    payments = good.select(
        F.col("payment_id").alias("c_payment_id"), "legacy_cartera_id", "c_bpartner_id", "ad_org_id",
        F.lit(config.DOC_DISBURSEMENT).alias("c_doctype_id"),
        F.lit(config.CHARGE_DISBURSEMENT).alias("c_charge_id"), F.col("_box").alias("c_bankaccount_id"),
        F.col("_on").alias("dateacct"), F.col("monto").alias("payamt"))
    level = F.round(F.col("montototal") / count(F.col("dias_cre")), 4).cast(AMT)
    updates = good.select("legacy_cartera_id", F.lit("Y").alias("synced"), "local_id", "payment_id",
                          F.col("valorinteres").cast(AMT).alias("valorinteres"),
                          F.col("montototal").cast(AMT).alias("montototal"), level.alias("cuota"))
    out = {"invoice_lines": invoice_lines, "payments": payments, "updates": updates, "rejects": rejects}
    if plan == "declining":
        out["schedule"] = schedule_declining(good)
    elif plan == "flat":
        out["schedule"] = schedule_flat(good)
    return out


def route_owner_boxes(partners, owners, users) -> DataFrame:
    """Cash box of the owner of each partner's route."""
    boxes = owners.join(users.select(F.col("ad_user_id").alias("owner_id"), "c_bankaccount_id"), "owner_id")
    return partners.select("c_bpartner_id", "cv_ruta_id").join(
        boxes.select("cv_ruta_id", "c_bankaccount_id"), "cv_ruta_id")


def legacy_partner(loans, legacy_clients) -> DataFrame:
    """Loans whose missing partner is taken from their legacy client of the same branch."""
    cli = legacy_clients.select("id_cliente", "ad_org_id", F.col("c_bpartner_id").alias("_cli_bp"))
    return loans.join(cli, ["id_cliente", "ad_org_id"], "left").withColumn(
        "c_bpartner_id", F.coalesce("c_bpartner_id", F.col("_cli_bp"))).drop("_cli_bp")


def _receipts(good) -> DataFrame:
    return good.select(
        F.concat(F.lit("P-"), F.col("legacy_cobro_id")).alias("c_payment_id"), "legacy_cobro_id",
        "c_bpartner_id", "ad_org_id", F.lit(config.DOC_RECEIPT).alias("c_doctype_id"),
        F.col("_box").alias("c_bankaccount_id"), F.col("operacion").alias("dateacct"),
        F.col("abono").alias("payamt"), "c_invoice_id")


def bridge_collections(collections, partners, users, *, strict: bool = True, checked: bool = False,
                       loans=None, invoices=None, all_collections=None, org=None, cobro_id=None) -> dict[str, DataFrame]:
    """Pending native collections (with their partner) to receipts.

    ``checked`` also requires a partner location, the loan, its unpaid invoice and a synced
    balance that is not negative, and links the invoice.
    """
    c = collections.filter(pending(F.col("synced"), strict) & (F.col("origen") == "native") & (F.col("abono") > 0))
    if org is not None:
        c = c.filter(F.col("ad_org_id") == org)
    if cobro_id is not None:
        c = c.filter(F.col("legacy_cobro_id") == cobro_id)
    u = users.select(F.col("ad_user_id").alias("createdby"), F.lit(True).alias("_usr"),
                     F.col("c_bankaccount_id").alias("_box"))
    p = partners.select("c_bpartner_id", F.lit(True).alias("_bp"), "has_location")
    j = c.join(p, "c_bpartner_id", "left").join(u, "createdby", "left")
    checks = [
        (F.col("local_id").isNotNull(), "ya tiene recibo"),
        (F.col("_bp").isNull(), "sin tercero"),
    ]
    if checked:
        balances = synced_balance(loans.select("legacy_cartera_id", "montototal", "local_id"), all_collections)
        ln = balances.select(F.col("legacy_cartera_id").alias("id_cartera"), F.col("local_id").alias("c_invoice_id"),
                             F.col("saldo_synced"), F.lit(True).alias("_car"))
        inv = invoices.select("c_invoice_id", "ispaid", F.lit(True).alias("_inv"))
        j = j.join(ln, "id_cartera", "left").join(inv, "c_invoice_id", "left")
        checks += [(~F.col("has_location"), "tercero sin direccion")]
    checks += [(F.col("_usr").isNull(), "sin usuario"),
               (~(F.coalesce(F.col("_box"), F.lit(0)) > 0), "sin caja")]
    if checked:
        checks += [(F.col("_car").isNull(), "sin cartera"), (F.col("saldo_synced") < 0, "cartera sobregirada"),
                   (F.col("_inv").isNull(), "sin factura"), (F.col("ispaid") == "Y", "factura pagada")]
    else:
        j = j.withColumn("c_invoice_id", F.lit(None).cast("bigint"))
    j = j.withColumn("motivo", _first_reason(checks))
    good = j.filter(F.col("motivo").isNull())
    return {
        "payments": _receipts(good),
        "updates": good.select("legacy_cobro_id", F.lit("Y").alias("synced"),
                               F.concat(F.lit("P-"), F.col("legacy_cobro_id")).alias("local_id")),
        "rejects": j.filter(F.col("motivo").isNotNull()).select("legacy_cobro_id", "id_cartera", "motivo"),
    }


def bridge_collections_legacy(collections, loans, all_collections, box: int, org=None) -> dict[str, DataFrame]:
    """Pending collections matched on (legacy loan id, branch) with an open, billed loan.

    The loan id becomes the new key and the old one is kept.
    """
    agg = all_collections.groupBy(F.col("id_cartera").alias("legacy_cartera_id")).agg(
        F.sum("abono").cast("decimal(18,2)").alias("_paid"))
    saldo = (F.col("montototal") - F.coalesce("_paid", F.lit(0))).cast("decimal(18,2)")
    ln = loans.join(agg, "legacy_cartera_id", "left").filter((saldo > 0) & (F.col("local_id") > 0)).select(
        F.col("id_cartera_legacy").alias("id_cartera"), "ad_org_id",
        F.col("legacy_cartera_id").alias("nueva_cartera"), F.col("c_bpartner_id"),
        F.col("local_id").alias("c_invoice_id"))
    c = collections.filter((F.col("synced") == "N") & (F.col("abono") > 0)).drop("c_bpartner_id")
    if org is not None:
        c = c.filter(F.col("ad_org_id") == org)
    good = c.join(ln, ["id_cartera", "ad_org_id"]).withColumn("_box", F.lit(box))
    return {
        "payments": _receipts(good),
        "updates": good.select("legacy_cobro_id", F.col("nueva_cartera").alias("id_cartera"),
                               F.col("id_cartera").alias("old_cartera"), "c_bpartner_id",
                               F.col("c_invoice_id").alias("local_invoice_id"), F.lit("Y").alias("synced")),
    }


def bridge_expenses(expenses, partners, users) -> dict[str, DataFrame]:
    """Pending native expenses to expense payments."""
    e = expenses.filter(pending(F.col("synced")) & (F.col("origen") == "native"))
    p = partners.select("c_bpartner_id", F.lit(True).alias("_bp"))
    u = users.select(F.col("ad_user_id").alias("createdby"), F.col("c_bankaccount_id").alias("_box"))
    j = e.join(p, "c_bpartner_id", "left").join(u, "createdby", "left").withColumn("motivo", _first_reason([
        (F.coalesce(F.col("local_id") > 0, F.lit(False)), "ya tiene pago"),
        (F.col("_bp").isNull(), "sin tercero"),
        (~(F.coalesce(F.col("_box"), F.lit(0)) > 0), "sin caja")]))
    good = j.filter(F.col("motivo").isNull())
    return {
        "payments": good.select(
            F.col("legacy_gasto_id").alias("c_payment_id"), "c_bpartner_id", "ad_org_id",
            F.lit(config.DOC_EXPENSE).alias("c_doctype_id"), "c_charge_id", F.col("_box").alias("c_bankaccount_id"),
            F.col("fecha").alias("dateacct"), F.col("monto").alias("payamt"),
            F.concat(F.lit("Gasto en Ruta | "), F.col("concepto")).alias("description")),
        "rejects": j.filter(F.col("motivo").isNotNull()).select("legacy_gasto_id", "motivo"),
    }


def complete_documents(documents, open_periods, date_column: str, org=None) -> DataFrame:
    """Draft documents dated in an open period become completed.

    ``open_periods``: startdate, enddate (months); matched by month, then by bounds.
    """
    months = open_periods.select("startdate", "enddate").withColumn("_m", F.explode(F.sequence(
        F.trunc("startdate", "month"), F.trunc("enddate", "month"), F.expr("INTERVAL 1 MONTH"))))
    # Whether some open period holds the day; one row per month keeps the document count.
    per_month = months.groupBy("_m").agg(F.collect_set(F.struct("startdate", "enddate")).alias("_open"))
    d = documents.withColumn("_m", F.trunc(date_column, "month")).join(per_month, "_m", "left")
    inside = F.coalesce(F.exists("_open", lambda p: F.col(date_column).between(p.startdate, p.enddate)), F.lit(False))
    hit = (F.col("docstatus") == "DR") & inside
    if org is not None:
        hit = hit & (F.col("ad_org_id") == org)
    return d.withColumn("completado", hit).withColumn(
        "docstatus", F.when(hit, "CO").otherwise(F.col("docstatus"))).drop("_m", "_open")


def relink_paid(payments, invoices) -> DataFrame:
    """Draft receipts on a paid invoice move to the partner's first unpaid invoice, if any."""
    inv = invoices.select("c_invoice_id", F.col("ispaid").alias("_paid"))
    first = invoices.filter(F.col("ispaid") == "N").groupBy("c_bpartner_id").agg(
        F.min_by("c_invoice_id", F.struct("dateinvoiced", "c_invoice_id")).alias("nueva"))
    j = payments.join(inv, "c_invoice_id").filter((F.col("_paid") == "Y") & (F.col("docstatus") == "DR"))
    return j.join(first, "c_bpartner_id", "left").select(
        "c_payment_id", "c_bpartner_id", F.col("c_invoice_id").alias("factura_pagada"), "nueva",
        F.when(F.col("nueva").isNull(), "sin factura").otherwise("asociado").alias("resultado"))
