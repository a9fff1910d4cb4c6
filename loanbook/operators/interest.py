"""Interest, amortization schedules and accruals.

Money is decimal with explicit HALF_UP rounding at each step. A schedule is computed
inside its loan row (Arrow batches, see functions.plans) and expanded once: no shuffle.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanbook import config
from loanbook.functions import plans
from loanbook.functions.dates import add_six_day, effective_days
from loanbook.functions.scalars import dec
from loanbook.operators.balances import collected, day, invoice_open
from loanbook.operators.runs import packed, unpacked
from loanbook.session import written

RATE = "decimal(12,10)"
D4 = "decimal(18,4)"
#: Low bits of the ids of instalments that stay together when they meet their invoices, and groups of them for each shuffle partition.
NEIGHBOURS, BUCKETS = 12, 16


def count(n: Column) -> Column:
    return n.cast("decimal(6,0)")


def total_interest(monto: Column, tasa: Column, n: Column) -> Column:
    """monto x tasa x 12 x n / 360 at 4 digits."""
    return F.round(monto * tasa * count(n) * dec("12", "decimal(2,0)") / dec("360", "decimal(3,0)"),
                   4).cast(D4)


def total_360(loans) -> DataFrame:
    """Total interest, total and level instalment of each loan."""
    i = total_interest(F.col("monto"), F.col("tasa"), F.col("dias_cre"))
    return (
        loans.withColumn("valorinteres", i)
        .withColumn("montototal", (F.col("monto") + F.col("valorinteres")).cast(D4))
        .withColumn("cuota", F.round(F.col("montototal") / count(F.col("dias_cre")), 4).cast(D4))
    )


def _units(c: Column, unit: int) -> Column:
    """A decimal column as a whole number of units."""
    return (c * F.lit(unit)).cast("bigint")


def hidden_rate(principal: Column, interest: Column, n: Column) -> Column:
    """Daily rate whose declining plan yields exactly the fixed interest (bisection).

    The trial points and their 10-digit rounding are part of the result: the first point
    within tolerance is taken, and a root outside the interval pins to its edge.
    """
    level = F.round((principal + interest) / count(n), 10).cast("decimal(28,10)")
    units = plans.rate_units(principal.cast("decimal(22,4)"), level, interest.cast("decimal(32,14)"), n.cast("int"))
    return (units.cast("decimal(12,0)") * dec("0.0000000001", "decimal(10,10)")).cast(RATE)


def with_hidden_rate(loans) -> DataFrame:
    """Loans with the rate and whether it sits at an edge of the search interval."""
    interest = (F.col("montototal") - F.col("monto")).cast(D4)
    edge = dec("0.00000001", RATE)
    low = dec("0.001", RATE)
    high = dec("0.020", RATE)
    return loans.withColumn(
        "tasa_oculta", hidden_rate(F.col("monto"), interest, F.col("dias_cre"))
    ).withColumn(
        "rate_clamped",
        (F.col("tasa_oculta") >= high - edge)
        | (F.col("tasa_oculta") <= low + edge))


def plan_interests(principal: Column, rate: Column, level: Column, n: Column,
                   digits: int = 4, guarded: bool = True) -> Column:
    """Array of (seq, interes, capital) of a declining plan, amounts in ten-thousandths.

    Guarded: interest never below 0 nor above the instalment, capital never above the
    balance, and the last row clears the balance. Unguarded: the plain recurrence.
    """
    return plans.plan_function(digits, guarded)(
        _units(principal.cast(D4), plans.MONEY_UNIT), _units(rate.cast(RATE), plans.RATE_UNIT),
        _units(level.cast(D4), plans.MONEY_UNIT), n.cast("int"))


def _money(units: Column) -> Column:
    return (units.cast("decimal(18,0)") * dec("0.0001", "decimal(4,4)")).cast(D4)


def _expand(loans, plan: Column, first_offset: int = 0, skip_sundays: bool = True) -> DataFrame:
    rows = loans.select("legacy_cartera_id", "ad_org_id", "local_id", "fecha", F.inline(plan))
    start = F.date_add("fecha", first_offset) if first_offset else F.col("fecha")
    due = add_six_day(start, F.col("seq")) if skip_sundays else F.date_add("fecha", F.col("seq"))
    amounts = [F.col("dueamt")] if "dueamt" in rows.columns else [
        _money(F.col(c)).alias(c) for c in ("interes", "capital")]
    return rows.select(
        "legacy_cartera_id", "ad_org_id", F.col("local_id").alias("c_invoice_id"), "seq",
        due.alias("duedate"), *amounts)


def schedule_declining(loans) -> DataFrame:
    """Current schedule: interest on the balance at the hidden rate, Sundays skipped."""
    level = F.round(F.col("montototal") / count(F.col("dias_cre")), 4).cast(D4)
    plan = plan_interests(F.col("monto"), F.col("tasa_oculta"), level, F.col("dias_cre"))
    rated = with_hidden_rate(loans) if "tasa_oculta" not in loans.columns else loans
    return _expand(rated, plan)


def schedule_rate30(loans, level: Column | None = None, floor: bool = False) -> DataFrame:
    """Earlier schedule: daily rate is the monthly one over 30; the last interest may be negative."""
    rate = F.round(F.col("tasa") / dec("30", "decimal(2,0)"), 10).cast(RATE)
    if level is None:
        level = F.round(F.col("montototal") / count(F.col("dias_cre")), 4).cast(D4)
    out = _expand(loans, plan_interests(
        F.col("monto"), rate, level, F.col("dias_cre"), guarded=False))
    return out.withColumn("interes", F.greatest("interes", dec("0", D4))) if floor else out


def pmt(rate: Column, n: Column, principal: Column) -> Column:
    """Level payment at 2 digits; principal / n without interest."""
    r = rate.cast("double")
    factor = F.pow(1 + r, n.cast("double"))
    exact = (r * principal.cast("double") * factor / (factor - 1)).cast("decimal(28,10)")
    return F.when(rate == 0, F.round(principal / count(n), 10).cast("decimal(28,10)")).otherwise(
        F.round(exact, 2).cast("decimal(28,10)"))


def pmt_rates(tasa: Column) -> tuple[Column, Column]:
    """Period rate of the payment and daily factor of its interest, from a rate in percent."""
    net = F.round(tasa / dec("100", "decimal(3,0)"), 10).cast(RATE)
    period = F.round(net / dec("12", "decimal(2,0)"), 10).cast(RATE)
    daily = F.round(net * dec("12", "decimal(2,0)") / dec("360", "decimal(3,0)"), 10).cast(RATE)
    return period, (daily * dec("100", "decimal(3,0)")).cast(RATE)


def schedule_pmt(loans) -> DataFrame:
    """Declining schedule by PMT: 2-digit interest, one row per calendar day."""
    period, daily = pmt_rates(F.col("tasa"))
    level = pmt(period, F.col("dias_cre"), F.col("monto")).cast(D4)
    rated = loans.withColumn("_level", level)
    return _expand(rated, plan_interests(
        F.col("monto"), daily, F.col("_level"), F.col("dias_cre"), digits=2, guarded=False),
        skip_sundays=False)


def _equal_rows(loans, amount: Column, kind: str, first_offset: int) -> DataFrame:
    rows = F.transform(F.sequence(F.lit(1), F.col("dias_cre")), lambda i: F.struct(
        i.cast("int").alias("seq"), amount.cast(kind).alias("dueamt")))
    return _expand(loans, rows, first_offset)


def schedule_flat(loans) -> DataFrame:
    """Equal interest per instalment at 4 digits."""
    each = F.round(F.col("valorinteres") / count(F.col("dias_cre")), 4)
    return _equal_rows(loans, each, D4, 0)


def schedule_level_total(loans, net_of_interest: bool = False) -> DataFrame:
    """Instalment total/n + interest/n at 10 digits from the second day on.

    ``net_of_interest`` is the older form: interest is first taken out of the instalment.
    """
    n = count(F.col("dias_cre"))
    level = F.round(F.col("montototal") / n, 10).cast("decimal(28,10)")
    share = F.round(F.col("valorinteres") / n, 10).cast("decimal(28,10)")
    amount = (level - share) + share if net_of_interest else level + share
    return _equal_rows(loans, amount, "decimal(28,10)", 1)


def unbilled() -> Column:
    return F.col("processed").isNull() | (F.col("processed") == "N")


def recalc_schedule(schedule, loans, open_capital, process_date) -> DataFrame:
    """Replan the pending instalments of loans with open capital.

    ``open_capital``: c_invoice_id, open. The instalments of a loan (at most its term) are
    gathered in due order and get their new interest by position.
    """
    pending_rows = schedule.filter(
        unbilled() & (F.col("isactive") == "Y") & (F.col("duedate") >= day(process_date)))
    grouped = pending_rows.groupBy("legacy_cartera_id").agg(
        F.array_sort(F.collect_list(F.struct("duedate", "legacy_schedule_id", "dueamt"))).alias("rows"),
        F.count(F.lit(1)).cast("int").alias("n"))
    base = (
        grouped.join(
            loans.select("legacy_cartera_id", "monto", "valorinteres", "local_id"),
            "legacy_cartera_id")
        .join(open_capital.select(F.col("c_invoice_id").alias("local_id"), F.col("open")), "local_id")
        .filter(F.col("open") > 0)
    )
    share = F.when(F.col("monto") > 0, F.round(
        F.col("open").cast("decimal(18,4)") / F.col("monto"), 10)).otherwise(dec("0", RATE))
    base = base.withColumn("pending_interest", (
        F.col("valorinteres") * share.cast("decimal(14,10)")).cast("decimal(32,14)"))
    total = (F.col("open") + F.col("pending_interest")).cast("decimal(34,14)")
    level = F.round(total / count(F.col("n")), 4).cast(D4)
    base = base.withColumn("_rate", hidden_rate(F.col("open"), F.col("pending_interest"), F.col("n"))
                           ).withColumn("_level", level)
    plan = plan_interests(F.col("open"), F.col("_rate"), F.col("_level"), F.col("n"))
    return base.withColumn("plan", plan).select(
        "legacy_cartera_id", F.inline(F.arrays_zip("rows", "plan"))).select(
        "legacy_cartera_id", F.col("rows.legacy_schedule_id").alias("legacy_schedule_id"),
        F.col("rows.duedate").alias("duedate"), F.col("rows.dueamt").alias("dueamt_previo"),
        _money(F.col("plan.interes")).alias("dueamt"))


def due_on(schedule, process_date) -> DataFrame:
    """Pending instalments due on a day."""
    out = schedule.filter(
        (F.col("duedate") == day(process_date)) & unbilled() & (F.col("isactive") == "Y"))
    return out


def _already_billed(invoices) -> DataFrame:
    return invoices.filter(F.col("docstatus").isin("CO", "CL") & F.col("legacy_data").isNotNull()
                           ).select(F.col("legacy_data").alias("legacy_schedule_id")).distinct()


def _interest_invoices(rows, process_date) -> DataFrame:
    return rows.select(
        "legacy_schedule_id", "legacy_cartera_id", "c_bpartner_id", "ad_org_id",
        F.lit(config.DOC_INTEREST).alias("c_doctype_id"),
        day(process_date).alias("dateinvoiced"), F.col("dueamt").alias("grandtotal"))


def bill_daily(schedule, invoices, process_date, recalculated=None) -> DataFrame:
    """Interest invoices for the instalments due on a day.

    Skips instalments already billed and those without their capital invoice. With
    ``recalculated`` rows (from recalc_schedule) the amounts are the replanned ones.
    """
    due = due_on(schedule, process_date).drop("c_bpartner_id")
    if recalculated is not None:
        new = recalculated.select("legacy_schedule_id", F.col("dueamt").alias("_new"))
        due = due.join(new, "legacy_schedule_id", "left").withColumn(
            "dueamt", F.coalesce("_new", F.col("dueamt"))).drop("_new")
    parent = invoices.select("c_invoice_id", "c_bpartner_id")
    open_rows = due.join(_already_billed(invoices), "legacy_schedule_id", "left_anti").join(
        parent, "c_invoice_id")
    return _interest_invoices(open_rows, process_date)


def billing_updates(pending, invoices, billed, new_id: Column) -> DataFrame:
    """Flags of the instalments a billing run has dealt with.

    ``pending``: the instalments it looked at; ``billed``: its new invoices, whose ids ``new_id``
    gives. Instalments that already had an invoice are only marked as processed.
    """
    flags = F.lit("Y").alias("processed")
    old = pending.join(_already_billed(invoices), "legacy_schedule_id", "left_semi").select(
        "legacy_schedule_id", flags, F.lit(None).cast("bigint").alias("ref_invoice_id"), F.lit("existente").alias("factura"))
    return billed.select("legacy_schedule_id", flags, new_id.cast("bigint").alias("ref_invoice_id"),
                         F.lit("nueva").alias("factura")).unionByName(old)


def _matcher(names: list[str]):
    """Function for a cogroup: rows of packed instalments and of invoices that share the instalment's id."""

    def match(instalments: pa.Table, billed: pa.Table) -> pa.Table:
        ids = instalments["legacy_schedule_id"].combine_chunks()
        size = ids.value_lengths().to_numpy()
        run = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(run)) - (np.cumsum(size) - size)[run]
        ids = ids.flatten().to_numpy() + place * instalments["_step"].to_numpy()[run]
        known = billed["legacy_data"].to_numpy()
        order = np.argsort(known, kind="stable")
        low, high = (np.searchsorted(known[order], ids, side) for side in ("left", "right"))
        hit = np.repeat(np.arange(len(ids)), high - low)
        nth = np.arange(len(hit)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        rows = instalments.take(pa.array(run[hit]))
        return pa.table([pa.array(ids[hit]), rows["legacy_cartera_id"], rows["unbilled"],
                         billed["open"].take(pa.array(order[low[hit] + nth])), pa.array(nth == 0)], names=names)

    return match


def billed_instalments(schedule, invoices, allocations) -> DataFrame:
    """Instalments that an invoice names, whatever their flag: one row for each such invoice, ``first`` marks one for each instalment.

    legacy_schedule_id, legacy_cartera_id, unbilled, open (of unpaid invoices, else null), first. The instalments pass
    one shuffle, in runs by neighbouring ids, and only those with an invoice leave it.
    """
    parts = int(schedule.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("block"), F.lit(parts * BUCKETS)).cast("int").alias("bucket")
    rows = schedule.filter(F.col("legacy_schedule_id").isNotNull()).select(
        F.shiftright("legacy_schedule_id", NEIGHBOURS).alias("block"), "legacy_cartera_id",
        F.coalesce(unbilled(), F.lit(False)).alias("unbilled"), "legacy_schedule_id")
    left = packed(rows, ["block", "legacy_cartera_id", "unbilled"]).select("*", bucket).drop("block")
    known = invoices.filter(F.col("docstatus").isin("CO", "CL") & F.col("legacy_data").isNotNull()).drop("legacy_cartera_id")
    unpaid = (F.col("ispaid") == "N") & (F.col("docstatus") == "CO")
    right = invoice_open(known, allocations).select(
        F.shiftright("legacy_data", NEIGHBOURS).alias("block"), "legacy_data", F.when(unpaid, F.col("open")).alias("open")).select(
        bucket, "legacy_data", "open")
    names = ["legacy_schedule_id", "legacy_cartera_id", "unbilled", "open", "first"]
    kinds = ["long", schedule.schema["legacy_cartera_id"].dataType.simpleString(), "boolean", right.schema["open"].dataType.simpleString(), "boolean"]
    left, right = (x.repartition(parts, "bucket").groupBy("bucket") for x in (left, right))
    return written(left.cogroup(right).applyInArrow(_matcher(names), ", ".join(map(" ".join, zip(names, kinds)))), "billed")


def debt_total(schedule, invoices, allocations, billed=None) -> DataFrame:
    """Interest debt per loan: unbilled instalments plus what billed interest is still open.

    ``billed``: billed_instalments of the same tables, where they are there already.
    """
    future = schedule.filter(unbilled()).groupBy("legacy_cartera_id").agg(
        F.sum("dueamt").alias("futuro"))
    if billed is None:
        billed = billed_instalments(schedule, invoices, allocations)
    billed = billed.filter(F.col("open").isNotNull()).groupBy("legacy_cartera_id").agg(F.sum("open").alias("facturado"))
    zero = F.lit(0).cast(D4)
    return future.join(billed, "legacy_cartera_id", "full").select(
        "legacy_cartera_id", F.coalesce("futuro", zero).alias("futuro"),
        F.coalesce("facturado", zero).alias("facturado"),
        (F.coalesce("futuro", zero) + F.coalesce("facturado", zero)).alias("deuda"))


def bill_prepaid(schedule, invoices, allocations, collections, process_date, loan_ids=None, billed=None):
    """Bill coming instalments in due order until the pending collections are covered.

    Returns (new invoices, rejected loans, accepted loans). A loan is rejected when its interest debt is
    smaller than the amount to cover. The running sum is per loan, at most its term. Instalments meet their loan in runs.
    ``billed``: billed_instalments of the same tables, where they are there already.
    """
    if billed is None:
        billed = billed_instalments(schedule, invoices, allocations)
    target = collections.filter(F.col("synced").isNull() | (F.col("synced") == "N")).groupBy(
        F.col("id_cartera").alias("legacy_cartera_id")).agg(F.sum("abono").alias("por_cubrir"))
    target = target.filter(F.col("por_cubrir") > 0)
    if loan_ids is not None:
        target = target.join(loan_ids.select("legacy_cartera_id").distinct(), "legacy_cartera_id", "left_semi")
    judged = target.join(debt_total(schedule, invoices, allocations, billed), "legacy_cartera_id", "left")
    debt = F.coalesce("deuda", F.lit(0).cast(D4))
    rejected = judged.filter(debt < F.col("por_cubrir")).select(
        "legacy_cartera_id", "por_cubrir", debt.alias("deuda"))
    accepted = judged.filter(debt >= F.col("por_cubrir")).select("legacy_cartera_id", "por_cubrir")
    moved, keys = ["legacy_schedule_id", "duedate", "dueamt"], ["legacy_cartera_id", "c_bpartner_id", "ad_org_id"]
    pending = schedule.filter(unbilled()).select(*keys, *moved)
    done = billed.filter("unbilled AND first").groupBy("legacy_cartera_id").agg(F.collect_set("legacy_schedule_id").alias("_done"))
    rows = unpacked(packed(pending, keys).join(accepted, "legacy_cartera_id").join(done, "legacy_cartera_id", "left"), pending, moved).filter(
        ~F.coalesce(F.array_contains("_done", F.col("legacy_schedule_id")), F.lit(False)))
    w = W.partitionBy("legacy_cartera_id").orderBy("duedate", "legacy_schedule_id").rowsBetween(
        W.unboundedPreceding, -1)
    rows = rows.withColumn("_covered", F.coalesce(F.sum("dueamt").over(w), F.lit(0))).filter(
        F.col("_covered") < F.col("por_cubrir"))
    return _interest_invoices(rows, process_date), rejected, accepted.select("legacy_cartera_id")


def _elapsed(as_of) -> Column:
    """Effective days since the loan date, between 0 and the term."""
    d = F.greatest(F.lit(0), effective_days(F.col("fecha"), day(as_of)))
    return F.least(d, F.col("dias_cre"))


def accrual_full(loans, collections, as_of) -> DataFrame:
    """Accrual A: monto x tasa once at least one day counts; a settled loan counts its term."""
    w = loans.join(collected(collections, as_of), "legacy_cartera_id", "left")
    settled = F.col("montototal") - F.coalesce("paid", F.lit(0)) <= 0
    days = F.when(settled, F.col("dias_cre")).otherwise(_elapsed(as_of))
    return w.select("legacy_cartera_id", F.when(days != 0, F.col("monto") * F.col("tasa"))
                    .otherwise(F.lit(0)).cast("decimal(18,6)").alias("interes"))


def accrual_daily(loans, collections, as_of) -> DataFrame:
    """Accrual B: the larger of days x instalment x rate and paid x rate."""
    w = loans.join(collected(collections, as_of), "legacy_cartera_id", "left")
    earned = (count(_elapsed(as_of)) * F.col("cuota") * F.col("tasa")).cast("decimal(28,8)")
    paid = (F.coalesce("paid", F.lit(0)) * F.col("tasa")).cast("decimal(28,8)")
    return w.select("legacy_cartera_id", F.coalesce(F.greatest(earned, paid), F.lit(0))
                    .cast("decimal(28,8)").alias("interes"))


def linear_interest(as_of) -> Column:
    """monto x tasa x elapsed days / term."""
    return (F.col("monto") * F.col("tasa") * count(_elapsed(as_of)) / count(F.col("dias_cre"))
            ).cast("decimal(28,10)")


def accrual_linear(loans, as_of) -> DataFrame:
    return loans.select("legacy_cartera_id", linear_interest(as_of).alias("interes"))


def period_interest(start, end) -> Column:
    """monto x tasa / 365.25 x effective days inside the period."""
    days = effective_days(F.greatest(F.col("fecha"), day(start)), day(end))
    return (F.col("monto") * F.col("tasa") * count(days) / dec("365.25", "decimal(5,2)")
            ).cast("decimal(28,10)")


def accrual_period(loans, start, end) -> DataFrame:
    return loans.select("legacy_cartera_id", period_interest(start, end).alias("interes"))


def reprice_batch(schedule, loans, invoices) -> DataFrame:
    """Unvalidated billed instalments and their invoices with the amount valorinteres / n."""
    rows = schedule.filter(
        F.col("ref_invoice_id").isNotNull() & ~F.col("isvalid").eqNullSafe(F.lit("Y")))
    terms = loans.filter(F.col("dias_cre") > 0).select(
        "legacy_cartera_id",
        F.round(F.col("valorinteres") / count(F.col("dias_cre")), 2).cast("decimal(18,2)").alias("nuevo_monto"))
    inv = invoices.select(F.col("c_invoice_id").alias("ref_invoice_id"),
                          F.col("grandtotal").alias("grandtotal_previo"))
    return rows.join(terms, "legacy_cartera_id").join(inv, "ref_invoice_id", "left").select(
        "legacy_schedule_id", "ref_invoice_id", F.col("dueamt").alias("dueamt_previo"),
        "grandtotal_previo", "nuevo_monto", F.lit("Y").alias("isvalid"), F.lit("N").alias("ispaid"))


def reprice_updates(repriced, allocations) -> dict[str, DataFrame]:
    """What follows new amounts (reprice_batch): payments to allocate again and invoice lines."""
    hit = repriced.select(F.col("ref_invoice_id").alias("c_invoice_id"), "nuevo_monto")
    paid = allocations.join(hit.select("c_invoice_id").distinct(), "c_invoice_id", "left_semi")
    return {"payments": paid.select("c_payment_id").distinct().withColumn("isallocated", F.lit("N")),
            "lines": hit.select("c_invoice_id", *[F.col("nuevo_monto").alias(c) for c in ("priceactual", "linenetamt", "priceentered")])}


def modify_loans(loans, adjustments) -> DataFrame:
    """Loans after a batch change of amount, rate and term.

    ``adjustments``: legacy_cartera_id, nuevomonto, nuevatasa, nuevoplazo. Changed loans get
    the new interest, total and instalment; invoice and disbursement follow ``monto``.
    """
    j = loans.join(adjustments, "legacy_cartera_id", "left")
    hit = F.col("nuevomonto").isNotNull()
    interest = F.round(F.col("nuevomonto") * F.col("nuevatasa"), 2)
    total = F.round(F.col("nuevomonto") + F.col("nuevomonto") * F.col("nuevatasa"), 2)
    level = F.round(total / count(F.col("nuevoplazo")), 2)

    def pick(new, old):
        return F.when(hit, new).otherwise(F.col(old))

    return j.select(
        "legacy_cartera_id",
        pick(F.col("nuevoplazo"), "dias_cre").alias("dias_cre"),
        pick(F.col("nuevomonto"), "monto").cast("decimal(18,2)").alias("monto"),
        pick(F.col("nuevatasa"), "tasa").cast("decimal(10,4)").alias("tasa"),
        pick(interest, "valorinteres").cast(D4).alias("valorinteres"),
        pick(total, "montototal").cast("decimal(18,2)").alias("montototal"),
        pick(level, "cuota").cast(D4).alias("cuota"),
        F.when(hit & F.col("local_id").isNotNull(), F.col("local_id")).alias("factura_cambiada"),
        F.when(hit & F.col("local_id").isNotNull(), F.col("payment_id")).alias("desembolso_cambiado"),
        hit.alias("modificada"))
