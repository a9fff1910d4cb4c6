"""Splitting payments into principal and interest, and allocating them to open debts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanbook import config
from loanbook.operators.balances import day, invoice_open
from loanbook.operators.ordered import (
    any_hot, day_buckets, day_running, equal_buckets, neighbours, plain_window, running_total, tie_key)
from loanbook.session import written

AMT = "decimal(18,4)"
POS = "decimal(28,4)"


def prorata(amount: Column, tasa: Column) -> tuple[Column, Column]:
    """(principal, interest): the rate's share of the amount is interest."""
    return amount * (1 - tasa), amount * tasa


def split_prorata(loans, collections) -> DataFrame:
    terms = loans.select(F.col("legacy_cartera_id").alias("id_cartera"), "tasa")
    principal, interest = prorata(F.col("abono"), F.col("tasa"))
    return collections.join(terms, "id_cartera").select(
        "legacy_cobro_id", "id_cartera", "abono",
        principal.cast("decimal(18,6)").alias("abono_principal"),
        interest.cast("decimal(18,6)").alias("abono_interes"))


def split_principal_first(loans, collections, start=None, end=None) -> DataFrame:
    """Principal until the loan amount is covered by the other payments, then interest.

    The other payments are those up to the same day, so payments of one day count each
    other. With a period, earlier days collapse into one before the running sum.
    """
    c = collections if end is None else collections.filter(F.col("operacion") <= day(end))
    stamped = c.select("id_cartera", "abono", (
        F.col("operacion") if start is None else F.greatest("operacion", F.date_sub(day(start), 1))
    ).alias("dia"))
    running = day_running(stamped, ["id_cartera"], "dia", {"hasta": F.col("abono")}).drop("hasta_day")
    # The loan amount joins the day totals, which are fewer than the payments.
    terms = loans.select(F.col("legacy_cartera_id").alias("id_cartera"), "monto")
    running = running.join(terms, "id_cartera")
    rows = c if start is None else c.filter(F.col("operacion") >= day(start))
    rows = rows.filter(F.col("abono") > 0).withColumn("dia", F.col("operacion"))
    before = (F.col("hasta") - F.col("abono")).cast("decimal(28,2)")
    room = F.greatest(F.col("monto") - before, F.lit(0).cast("decimal(18,2)"))
    principal = F.least(F.col("abono"), room).cast("decimal(18,2)")
    return (
        rows.join(running, ["id_cartera", "dia"])
        .select("legacy_cobro_id", "id_cartera", "operacion", "abono",
                principal.alias("abono_principal"),
                (F.col("abono") - principal).cast("decimal(18,2)").alias("abono_interes"),
                room.cast("decimal(18,2)").alias("saldo_principal_previo"))
    )


def open_debts(invoices, allocations=None) -> DataFrame:
    """Completed unpaid interest and capital sales invoices with what is still open."""
    inv = invoices.filter(
        (F.col("ispaid") == "N") & (F.col("docstatus") == "CO") & (F.col("issotrx") == "Y")
        & F.col("c_doctype_id").isin(config.DOC_INTEREST, config.DOC_CAPITAL))
    if allocations is None:
        opened = inv.withColumn("open", F.col("grandtotal").cast(AMT))
    else:
        opened = invoice_open(inv, allocations)
    return opened.filter(F.col("open") > 0).select(
        "c_invoice_id", "c_bpartner_id", "c_doctype_id", "dateinvoiced", "open")


def unallocated(payments, allocations, open_items, omitted, today, on_day=None, org=None) -> DataFrame:
    """Completed receipts without allocation whose partner has an open item by then.

    The open item check needs only the partner's earliest item. ``omitted``:
    c_payment_id, dateommited; payments omitted today are left out.
    """
    first = open_items.groupBy("c_bpartner_id").agg(F.min("dateinvoiced").alias("_first"))
    p = payments.filter(
        (F.col("c_doctype_id") == config.DOC_RECEIPT) & (F.col("docstatus") == "CO")
        & (F.col("payamt") > 0) & F.col("c_invoice_id").isNull())
    if on_day is not None:
        p = p.filter(F.col("datetrx") == day(on_day))
    if org is not None:
        p = p.filter(F.col("ad_org_id") == org)
    skipped = omitted.filter(F.col("dateommited") == day(today)).select("c_payment_id")
    return (
        p.join(allocations.select("c_payment_id").distinct(), "c_payment_id", "left_anti")
        .join(skipped.distinct(), "c_payment_id", "left_anti")
        .join(first, "c_bpartner_id").filter(F.col("_first") <= F.col("dateacct")).drop("_first")
    )


def _is_interest() -> Column:
    return F.col("c_doctype_id") == config.DOC_INTEREST


def debt_order(debts, hot_rows=None) -> DataFrame:
    """The order in which a partner's debts are paid: interest before capital, oldest first.

    One row per debt with its position and the open amount up to and including it. A payment
    skips interest dated after it; ``candidate_totals`` gives what is left for each payment.
    """
    d = debts.withColumn("prioridad", F.when(_is_interest(), 1).otherwise(2)).withColumn(
        "_tie", tie_key("c_invoice_id"))
    out = running_total(
        d, ["c_bpartner_id"], [F.col("prioridad"), F.col("dateinvoiced"), F.col("_tie")],
        {"posicion": F.lit(1).cast("decimal(10,0)"), "acumulado": F.col("open")},
        [F.col("prioridad"), *day_buckets("dateinvoiced", "c_invoice_id")], hot_rows)
    return out.drop("_tie").withColumn("posicion", F.col("posicion").cast("bigint"))


def candidate_totals(payments, debts) -> DataFrame:
    """Per payment: number and open amount of its candidate debts, by type.

    Debts and payments are summed per (partner, day) before the running sum; no pair of a
    payment and a debt is formed.
    """
    zero, none = F.lit(0).cast(AMT), F.lit(0).cast("bigint")
    events = debts.filter(_is_interest()).select(
        "c_bpartner_id", F.col("dateinvoiced").alias("dia"), F.col("open").alias("amt"),
        F.lit(1).cast("bigint").alias("cnt")
    ).unionByName(payments.select(
        "c_bpartner_id", F.col("dateacct").alias("dia"), zero.alias("amt"), none.alias("cnt")))
    running = day_running(events, ["c_bpartner_id"], "dia", {
        "interes_abierto": F.col("amt"), "n_interes": F.col("cnt")}).drop(
        "interes_abierto_day", "n_interes_day")
    capital = debts.filter(~_is_interest()).groupBy("c_bpartner_id").agg(
        F.sum("open").alias("capital_abierto"), F.count(F.lit(1)).alias("n_capital"))
    return (
        payments.withColumn("dia", F.col("dateacct")).join(running, ["c_bpartner_id", "dia"])
        .join(capital, "c_bpartner_id", "left")
        .select("c_payment_id", "c_bpartner_id", "dateacct", "payamt",
                F.coalesce("n_interes", none).alias("n_interes"),
                F.coalesce("interes_abierto", zero).alias("interes_abierto"),
                F.coalesce("n_capital", none).alias("n_capital"),
                F.coalesce("capital_abierto", zero).alias("capital_abierto"))
    )


def omitted_payments(payments, debts) -> DataFrame:
    """Payments without any candidate debt."""
    totals = candidate_totals(payments, debts)
    return totals.filter((F.col("n_interes") == 0) & (F.col("n_capital") == 0)).select(
        "c_payment_id", "c_bpartner_id", "dateacct")


def _interest_by_day(payments, interest, by_partner=False) -> DataFrame:
    """Per (partner, day with payments): how much of the day's money goes to interest.

    X is interest billed minus payments so far. The interest backlog after a day is X above
    its running minimum (or above 0), so what a day pays to interest is the backlog before
    it, plus the day's new interest, minus the backlog after it. ``by_partner``: no partner is hot, so one shuffle does.
    """
    zero = F.lit(0).cast(AMT)
    events = interest.select(
        "c_bpartner_id", F.col("dateinvoiced").alias("dia"), F.col("open").alias("owed"), zero.alias("paid")
    ).unionByName(payments.select("c_bpartner_id", "dia", zero.alias("owed"), F.col("payamt").alias("paid")))
    if by_partner:  # dealt by number: Spark would merge parts by their few bytes
        events = events.repartition(int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")), "c_bpartner_id")
    per_day = events.groupBy("c_bpartner_id", "dia").agg(
        F.sum("owed").cast(POS).alias("owed"), F.sum("paid").cast(POS).alias("paid"))
    w = W.partitionBy("c_bpartner_id").orderBy("dia")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    earlier = w.rowsBetween(W.unboundedPreceding, -1)
    z = F.lit(0).cast(POS)
    return (
        per_day.withColumn("x", F.sum((F.col("owed") - F.col("paid")).cast(POS)).over(upto).cast(POS))
        .withColumn("backlog", (F.col("x") - F.least(z, F.min("x").over(upto))).cast(POS))
        .withColumn("int_day", (F.coalesce(F.lag("backlog").over(w), z) + F.col("owed")
                                - F.col("backlog")).cast(POS))
        .withColumn("int_from", F.coalesce(F.sum("int_day").over(earlier), z).cast(POS))
        .withColumn("cap_from", F.coalesce(F.sum((F.col("paid") - F.col("int_day")).cast(POS))
                                           .over(earlier), z).cast(POS))
        .filter(F.col("paid") > 0)
        .select("c_bpartner_id", "dia", "int_day", "int_from", "cap_from")
    )


def allocate(payments, debts, hot_rows=None) -> DataFrame:
    """Allocation lines: payments by date, each paying interest dated up to it, then capital.

    Payments and debts become adjoining intervals on a line of money, per partner and debt
    type. The ends of all intervals cut the line into pieces; each piece belongs to the
    payment and the debt whose ends come next. The number of pieces is at most the number of
    payments plus debts. Payments that tie on their date go in the order of tie_key.

    Payments and debts are read several times, so they are written once. If no partner can have more than ``HOT_ROWS``
    cut points, each step is one plain window after one shuffle; else keys are split, and the cut points are written too.
    """
    p = written(payments.select(
        "c_payment_id", "c_bpartner_id", F.col("dateacct").alias("dia"), F.col("payamt").cast(AMT).alias("payamt")), "payments")
    debts = written(debts.select(
        "c_invoice_id", "c_bpartner_id", "c_doctype_id", "dateinvoiced", F.col("open").cast(AMT).alias("open")), "debts")
    split = any_hot([p, p, debts], "c_bpartner_id", hot_rows)  # a payment has two ends at most
    per_day = _interest_by_day(p, debts.filter(_is_interest()), not split)
    keys, order = ["c_bpartner_id", "dia"], [tie_key("c_payment_id"), F.col("c_payment_id")]
    if split:
        ran = running_total(p.withColumn("_tie", order[0]), keys, [F.col("_tie"), order[1]],
                            {"after": F.col("payamt")}, [F.substring("_tie", 1, 2)], hot_rows)
    else:
        ran, w, _ = plain_window(p, keys, order)
        ran = ran.withColumn("after", F.sum("payamt").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("decimal(38,4)"))
    j = ran.join(per_day, keys)
    before = F.col("after") - F.col("payamt")
    i1, i2 = F.least(before, F.col("int_day")), F.least(F.col("after"), F.col("int_day"))
    ends = F.array(
        F.struct(F.lit(config.DOC_INTEREST).alias("c_doctype_id"),
                 (F.col("int_from") + i2).cast(POS).alias("pos"), (i2 - i1).cast(POS).alias("len")),
        F.struct(F.lit(config.DOC_CAPITAL).alias("c_doctype_id"),
                 (F.col("cap_from") + F.col("after") - i2).cast(POS).alias("pos"),
                 (F.col("payamt") - (i2 - i1)).cast(POS).alias("len")))
    pay_ends = j.select("c_bpartner_id", "c_payment_id", F.inline(ends)).filter(F.col("len") > 0)
    keys, order = ["c_bpartner_id", "c_doctype_id"], [F.col("dateinvoiced"), tie_key("c_invoice_id")]
    if split:
        debt_ends = running_total(debts.withColumn("_tie", order[1]), keys, [order[0], F.col("_tie")],
                                  {"pos": F.col("open")}, day_buckets("dateinvoiced", "c_invoice_id"), hot_rows)
    else:
        debt_ends, w, _ = plain_window(debts, keys, order)
        debt_ends = debt_ends.withColumn("pos", F.sum("open").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("decimal(38,4)"))
    points = pay_ends.select(
        "c_bpartner_id", "c_doctype_id", F.col("pos").cast(POS).alias("pos"), "c_payment_id",
        F.lit(None).cast("bigint").alias("c_invoice_id"), F.lit(0).alias("side")
    ).unionByName(debt_ends.select(
        "c_bpartner_id", "c_doctype_id", F.col("pos").cast(POS).alias("pos"),
        F.lit(None).cast("string").alias("c_payment_id"), "c_invoice_id", F.lit(1).alias("side")))
    order = [F.col("pos"), F.col("side")]
    if split:
        fine, stats = equal_buckets("pos")
        owned = neighbours(written(points, "points"), keys, order, {"prev": "pos"}, ["c_payment_id", "c_invoice_id"], fine, hot_rows, stats)
    else:
        owned, w, _ = plain_window(points, keys, order)
        owned = owned.withColumns({
            "prev": F.lag("pos").over(w),
            **{c: F.first(c, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing)) for c in ("c_payment_id", "c_invoice_id")}})
    amount = (F.col("pos") - F.coalesce("prev", F.lit(0).cast(POS))).cast(AMT)
    return owned.filter(F.col("c_payment_id").isNotNull() & F.col("c_invoice_id").isNotNull()
                        & (amount > 0)).select(
        "c_payment_id", "c_invoice_id", "c_bpartner_id", "c_doctype_id", amount.alias("amount"))


def allocated_by_type(loans, schedule, allocations) -> DataFrame:
    """Active allocated amount per payment, loan and invoice type."""
    sets = loans.filter(F.col("local_id").isNotNull()).select(
        "legacy_cartera_id", F.col("local_id").alias("c_invoice_id"),
        F.lit(config.DOC_CAPITAL).alias("c_doctype_id")
    ).unionByName(schedule.filter(F.col("ref_invoice_id").isNotNull() & (F.col("processed") == "Y")).select(
        "legacy_cartera_id", F.col("ref_invoice_id").alias("c_invoice_id"),
        F.lit(config.DOC_INTEREST).alias("c_doctype_id")))
    lines = allocations.filter(F.col("isactive") == "Y").groupBy("c_payment_id", "c_invoice_id").agg(
        F.sum("amount").alias("amount"))
    return lines.join(sets, "c_invoice_id").groupBy(
        "c_payment_id", "legacy_cartera_id", "c_doctype_id").agg(F.sum("amount").alias("monto_asignado"))


def wrongly_paid(invoices, allocations, since) -> DataFrame:
    """Invoices flagged as paid since a day that still have an open amount."""
    inv = invoices.filter((F.col("ispaid") == "Y") & (F.col("dateinvoiced") >= day(since)))
    return invoice_open(inv, allocations).filter(F.col("open") > 0).select(
        "c_invoice_id", "open", F.lit("N").alias("ispaid"))
