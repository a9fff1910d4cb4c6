"""Data-quality detection and set-based repair."""

from itertools import count as count_from

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanbook import config
from loanbook.functions.scalars import pending
from loanbook.operators.balances import day, owned, synced_balance, with_collected
from loanbook.operators.interest import count
from loanbook.operators.ordered import tie_key
from loanbook.session import work_folder, written

ZERO = "decimal(18,2)"


def _pending_native(collections) -> DataFrame:
    return collections.filter(pending(F.col("synced")) & (F.col("origen") == "native") & (F.col("abono") > 0))


def _pending_counts(collections, loans) -> DataFrame:
    """Pending native collections per loan, for the given loans."""
    n = _pending_native(collections).groupBy(F.col("id_cartera").alias("legacy_cartera_id")).agg(
        F.count(F.lit(1)).alias("cobros"))
    return n.join(loans, "legacy_cartera_id")


def misassigned(collections, loans, partners) -> DataFrame:
    """Pending collections on loans without an open balance, by partner and loan."""
    closed = with_collected(loans, collections).filter(F.col("balance") <= 0).select(
        "legacy_cartera_id", "c_bpartner_id")
    return _pending_counts(collections, closed).join(
        partners.select("c_bpartner_id", "nombre"), "c_bpartner_id").select(
        "c_bpartner_id", "nombre", "legacy_cartera_id", "cobros")


def on_paid_invoice(collections, loans, invoices, partners) -> DataFrame:
    """Pending collections whose loan's invoice is already paid."""
    paid = invoices.filter(F.col("ispaid") == "Y").select(F.col("c_invoice_id").alias("local_id"))
    hit = loans.join(paid, "local_id", "left_semi").select("legacy_cartera_id", "c_bpartner_id")
    return _pending_counts(collections, hit).join(
        partners.select("c_bpartner_id", "nombre"), "c_bpartner_id").select(
        "c_bpartner_id", "nombre", "legacy_cartera_id", "cobros")


def reassign_oldest(problem, collections, loans, since=None) -> dict[str, DataFrame]:
    """Move the unsynced collections of partners with a problem to their oldest open loan.

    ``problem`` holds c_bpartner_id. Returns the moves and, per partner, whether it can be fixed.
    """
    ids = problem.select("c_bpartner_id").distinct()
    bal = with_collected(loans, collections)
    open_loans = bal.filter(F.col("balance") > 0)
    if since is not None:
        open_loans = open_loans.filter(F.col("fecha") >= day(since))
    oldest = open_loans.groupBy("c_bpartner_id").agg(
        F.min_by("legacy_cartera_id", F.struct("fecha", "legacy_cartera_id")).alias("nueva_cartera"))
    report = ids.join(oldest, "c_bpartner_id", "left").withColumn(
        "corregible", F.when(F.col("nueva_cartera").isNull(), "NO").otherwise("YES"))
    targets = report.filter(F.col("nueva_cartera").isNotNull()).select("c_bpartner_id", "nueva_cartera")
    moves = owned(collections.filter(F.col("synced") == "N"), loans).join(targets, "c_bpartner_id").select(
        "legacy_cobro_id", "c_bpartner_id", F.col("id_cartera").alias("old_cartera"),
        F.col("nueva_cartera").alias("id_cartera"))
    return {"moves": moves, "report": report}


def first_fit_inputs(collections, loans) -> tuple[DataFrame, DataFrame]:
    """Items and bins of the partners that have a pending collection on an overdrawn loan.

    Items are their pending collections, bins their loans with a positive synced balance. A
    collection without a loan is a problem of its own.
    """
    bal = synced_balance(loans, collections).select(
        F.col("legacy_cartera_id").alias("id_cartera"), "c_bpartner_id", "fecha", "saldo_synced")
    pend = owned(_pending_native(collections), loans).select(
        "legacy_cobro_id", "id_cartera", "c_bpartner_id", "abono", "operacion")
    overdrawn = pend.join(bal.select("id_cartera", "saldo_synced"), "id_cartera", "left")
    problem = overdrawn.filter((F.col("saldo_synced") < 0) | F.col("id_cartera").isNull()).select("c_bpartner_id").distinct()
    items = pend.select("c_bpartner_id", "legacy_cobro_id", "id_cartera", "abono", "operacion").join(
        problem, "c_bpartner_id", "left_semi").withColumn("_tie", tie_key("legacy_cobro_id"))
    bins = bal.filter(F.col("saldo_synced") > 0).join(problem, "c_bpartner_id", "left_semi").select(
        "c_bpartner_id", F.col("id_cartera").alias("bin"), F.col("fecha").alias("bin_fecha"),
        F.col("saldo_synced").cast("decimal(28,2)").alias("room"), tie_key("id_cartera").alias("bin_tie"))
    return items, bins


class _Rooms:
    """Rooms in order, and the first one above an amount: a tree of maxima over them."""

    def __init__(self, rooms: list):
        self.size = 1 << max(0, len(rooms) - 1).bit_length()
        self.tree = [0] * self.size + rooms + [0] * (self.size - len(rooms))
        for k in range(self.size - 1, 0, -1):
            self.tree[k] = max(self.tree[2 * k], self.tree[2 * k + 1])

    def take(self, amount):
        """Number of the first room above the amount, which is taken from it; None if there is none."""
        if not self.tree[1] > amount:
            return None
        k = 1
        while k < self.size:
            k = 2 * k if self.tree[2 * k] > amount else 2 * k + 1
        found = k - self.size
        self.tree[k] -= amount
        while k > 1:
            k //= 2
            self.tree[k] = max(self.tree[2 * k], self.tree[2 * k + 1])
        return found


MOVES = "c_bpartner_id long, legacy_cobro_id string, old_cartera long, id_cartera long"
MONEY = "decimal(28,2)"


def _place(batches):
    """Moves of sorted rows: a partner's bins come first, then its items in order."""
    for batch in _walked(batches):
        moves = batch.filter(pc.is_valid(batch.column("legacy_cobro_id")))
        yield moves.select(["c_bpartner_id", "legacy_cobro_id", "old_cartera", "id_cartera"])


def _walked(batches):
    """The moves, and the room that is left in each of a partner's bins (rows without a collection)."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.decimal128(28, 2)]
    names = ["c_bpartner_id", "legacy_cobro_id", "old_cartera", "id_cartera", "place", "room"]
    partner, bins, rooms, tree = object(), [], [], None

    def left():
        rest = tree.tree[tree.size:tree.size + len(bins)] if tree else rooms
        return [(partner, None, None, b, k, r) for k, (b, r) in enumerate(zip(bins, rest))]

    for batch in batches:
        out = []
        columns = [batch.column(k).to_pylist() for k in range(5)]
        for owner, kind, ident, loan, amount in zip(*columns):
            if owner != partner:
                out += left()
                partner, bins, rooms, tree = owner, [], [], None
            if not kind:
                bins.append(loan)
                rooms.append(amount)
                continue
            tree = tree or _Rooms(rooms)
            found = tree.take(amount)
            if found is not None:
                out.append((owner, ident, loan, bins[found], None, None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
    if bins:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*left()), kinds)], names)


# Partners with more items hand their rooms on from one part of their items to the next.
ITEMS_AT_ONCE = 1_000_000


def _rows(bins, items) -> DataFrame:
    """Bins (place, bin, room) and items (place, ...) of partners, in order, for one walk."""
    rows = bins.select(
        "c_bpartner_id", F.lit(0).alias("kind"), "place", F.lit(None).cast("string").alias("ident"), F.col("bin").alias("loan"),
        F.col("room").cast(MONEY).alias("amount")).unionByName(items.select(
            "c_bpartner_id", F.lit(1).alias("kind"), "place", F.col("legacy_cobro_id").alias("ident"), F.col("id_cartera").alias("loan"),
            F.col("abono").cast(MONEY).alias("amount")))
    # By the hash of the partner: a repartition by the column itself would be dropped where both parts
    # of the union already have it, and their partitions are then merged independently.
    return (rows.repartition(F.xxhash64("c_bpartner_id")).sortWithinPartitions("c_bpartner_id", "kind", "place")
            .select("c_bpartner_id", "kind", "ident", "loan", "amount"))


def reassign_first_fit(collections, loans, items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """Each pending collection, by date, goes to the oldest loan with more room than its amount.

    First fit is sequential: what fits depends on all earlier items of the partner. Partners are
    spread over the tasks; a task passes a partner's items by a tree over its loans, so
    memory holds the loans of one partner and each item costs the logarithm of their number.
    A partner with more than ``items_at_once`` items is walked in parts of at most so many, which follow its order. Each round
    takes the next part of every such partner in which some item is less than its largest room (parts
    without one are skipped unread), and hands the rooms on as a written table; a lost task costs a part.
    """
    items, bins = first_fit_inputs(collections, loans)
    order = ["c_bpartner_id", "operacion", "_tie", "legacy_cobro_id"]
    items = written(items.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.monotonically_increasing_id().alias("place")), "items")
    first = Window.partitionBy("c_bpartner_id").orderBy("bin_fecha", "bin_tie", "bin")
    bins = written(bins.select("c_bpartner_id", "bin", "room", F.row_number().over(first).cast("long").alias("place")), "bins")
    sizes = items.groupBy("c_bpartner_id").agg(F.count(F.lit(1)).alias("_n"))
    hot = written(sizes.filter(F.col("_n") > items_at_once).select("c_bpartner_id"), "hot")
    if hot.isEmpty():
        return _rows(bins, items).mapInArrow(_place, MOVES)
    calm = _rows(*[x.join(hot, "c_bpartner_id", "left_anti") for x in (bins, items)]).mapInArrow(_place, MOVES)
    return calm.unionByName(_in_parts(*[x.join(hot, "c_bpartner_id", "left_semi") for x in (bins, items)], items_at_once))


def _in_parts(bins, items, size: int) -> DataFrame:
    """First fit of partners with very many items, part by part."""
    spark = items.sparkSession
    items = written(items.withColumn("part", F.floor(F.col("place") / size)), "hot-items")
    parts = written(items.groupBy("c_bpartner_id", "part").agg(F.min("abono").alias("least")), "parts")
    folder, rooms, done = work_folder(spark, "first-fit"), bins, None
    for k in count_from(0):
        largest = rooms.groupBy("c_bpartner_id").agg(F.max("room").alias("largest"))
        open_ = parts.join(largest, "c_bpartner_id").filter(F.col("least") < F.col("largest"))
        if done is not None:
            open_ = open_.join(done, "c_bpartner_id").filter(F.col("part") > F.col("last"))
        # One row for each partner that goes on.
        next_ = written(open_.groupBy("c_bpartner_id").agg(F.min("part").alias("part"), F.max("largest").alias("largest")), "next")
        if next_.isEmpty():
            break
        fitting = items.join(next_, ["c_bpartner_id", "part"]).filter(F.col("abono") < F.col("largest"))
        walked = _rows(rooms.join(next_, "c_bpartner_id", "left_semi"), fitting).mapInArrow(
            _walked, f"{MOVES}, place long, room {MONEY}")
        walked.write.parquet(f"{folder}/round={k}")
        state = spark.read.schema(walked.schema).parquet(f"{folder}/round={k}").filter("legacy_cobro_id is null")
        rooms = state.select("c_bpartner_id", F.col("id_cartera").alias("bin"), "room", "place")
        done = next_.select("c_bpartner_id", F.col("part").alias("last"))
    if not k:
        return spark.createDataFrame([], MOVES)
    return spark.read.schema(walked.schema).parquet(folder).filter("legacy_cobro_id is not null").select(
        "c_bpartner_id", "legacy_cobro_id", "old_cartera", "id_cartera")


def duplicate_allocations(allocations) -> DataFrame:
    """(payment, invoice) pairs with more than one line."""
    return allocations.groupBy("c_payment_id", "c_invoice_id").agg(
        F.count(F.lit(1)).alias("lineas")).filter(F.col("lineas") > 1)


def zero_duplicates(allocations) -> DataFrame:
    """Every line but the first of a payment set to zero, for payments with a duplicate pair.

    The first line is the payment's lowest id, whatever its invoice.
    """
    hit = duplicate_allocations(allocations).select("c_payment_id").distinct()
    first = allocations.join(hit, "c_payment_id", "left_semi").groupBy("c_payment_id").agg(
        F.min("c_allocationline_id").alias("_first"))
    j = allocations.join(first, "c_payment_id", "left")
    drop = F.col("_first").isNotNull() & (F.col("c_allocationline_id") != F.col("_first"))
    return j.withColumn("anulada", drop).withColumn(
        "amount", F.when(drop, F.lit(0).cast(ZERO)).otherwise(F.col("amount"))).drop("_first")


def orphan_receipts(payments, collections, allocations) -> dict[str, DataFrame]:
    """Non-zero receipts without a collection, and their allocation lines, set to zero."""
    known = collections.filter(F.col("local_id").isNotNull()).select(
        F.col("local_id").alias("c_payment_id")).distinct()
    lost = payments.filter((F.col("c_doctype_id") == config.DOC_RECEIPT) & (F.col("payamt") != 0)).join(
        known, "c_payment_id", "left_anti")
    lines = allocations.join(lost.select("c_payment_id").distinct(), "c_payment_id", "left_semi")
    zero = F.lit(0).cast(ZERO)
    return {"payments": lost.select("c_payment_id", F.col("payamt").alias("payamt_previo"), zero.alias("payamt")),
            "lines": lines.select("c_allocationline_id", F.col("amount").alias("amount_previo"), zero.alias("amount"))}


def unvalidated_schedule(schedule, loans) -> DataFrame:
    """Billed instalments not yet validated, with the amount they should have."""
    terms = loans.filter(F.col("dias_cre") > 0).select(
        "legacy_cartera_id", F.round(F.col("valorinteres") / count(F.col("dias_cre")), 2)
        .cast("decimal(18,2)").alias("nuevo_monto"))
    return schedule.filter(
        F.col("ref_invoice_id").isNotNull() & ~F.col("isvalid").eqNullSafe(F.lit("Y"))).join(
        terms, "legacy_cartera_id").select("legacy_schedule_id", "ref_invoice_id", "nuevo_monto")


# Target invoices and all invoices that one task compares.
INVOICES_AT_ONCE = 3_000_000


def allocation_cleanup(target_invoices, allocations, payments, invoices) -> dict[str, DataFrame]:
    """What to drop and reopen to rebuild the allocations of some invoices.

    ``target_invoices``: c_invoice_id. Dropped: the headers that touch them, with all their
    lines and ledger entries. Reopened: the payments of those headers and the target invoices.

    Semi joins take a target or a header that comes several times as it is. The ids of the targets, of the invoices and of what
    is touched are written; the rows counted there say into how many tasks the invoices go, so that a
    task's memory does not grow with them.
    """
    target = written(target_invoices.select("c_invoice_id").filter(F.col("c_invoice_id").isNotNull()), "targets")
    ids = written(invoices.select("c_invoice_id").filter(F.col("c_invoice_id").isNotNull()), "invoice-ids")
    touched = written(allocations.join(target, "c_invoice_id", "left_semi").select(
        "c_allocationhdr_id", "c_payment_id"), "touched")
    headers = touched.select("c_allocationhdr_id")
    # The ids follow the targets: no fewer parts than Spark's own joins have, or it deals both anew.
    parts = max(int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(ids.count() + target.count()) // INVOICES_AT_ONCE))
    return {
        "drop_headers": headers.distinct(),
        "drop_lines": allocations.join(headers, "c_allocationhdr_id", "left_semi"),
        "keep_lines": allocations.join(headers, "c_allocationhdr_id", "left_anti"),
        "reopen_payments": payments.join(touched.select("c_payment_id"), "c_payment_id", "left_semi")
        .select("c_payment_id", F.lit("N").alias("isallocated")),
        "reopen_invoices": ids.join(target.repartition(parts, "c_invoice_id"), "c_invoice_id", "left_semi")
        .select("c_invoice_id", F.lit("N").alias("ispaid")),
    }


def void_collections(collections, payments, ids) -> dict[str, DataFrame]:
    """Cancel a batch: amount to zero; completed payments are reversed, drafts removed."""
    hit = ids.select("legacy_cobro_id").distinct().withColumn("_hit", F.lit(True))
    c = collections.join(hit, "legacy_cobro_id", "left").withColumn("anulado", F.coalesce("_hit", F.lit(False)))
    docs = c.filter("anulado").filter(F.col("local_id").isNotNull()).select(F.col("local_id").alias("c_payment_id"))
    p = payments.join(docs, "c_payment_id", "left_semi").select(
        "c_payment_id", "docstatus",
        F.when(F.col("docstatus") == "CO", "revertido").when(F.col("docstatus") == "DR", "eliminado")
        .otherwise("sin cambio").alias("accion"))
    return {"collections": c.withColumn("abono", F.when(F.col("anulado"), F.lit(0).cast(ZERO)).otherwise(F.col("abono")))
            .drop("_hit"), "payments": p}


def void_loans(loans, payments, ids) -> dict[str, DataFrame]:
    """The same on loans (with what was collected as ``abono``): that to zero, the linked payment undone."""
    hit = ids.select("legacy_cartera_id").distinct().withColumn("anulado", F.lit(True))
    ln = loans.join(hit, "legacy_cartera_id", "left").withColumn("anulado", F.coalesce("anulado", F.lit(False)))
    docs = ln.filter("anulado").filter(F.col("local_id").isNotNull()).select(F.col("local_id").alias("c_payment_id"))
    p = payments.join(docs, "c_payment_id", "left_semi").select(
        "c_payment_id", F.when(F.col("docstatus") == "CO", "revertido").when(
            F.col("docstatus") == "DR", "eliminado").otherwise("sin cambio").alias("accion"))
    return {"loans": ln.withColumn("abono", F.when(F.col("anulado"), F.lit(0).cast(ZERO)).otherwise(F.col("abono"))),
            "payments": p}


def branch_subset(frames: dict[str, DataFrame], branches: list[int], column: str = "ad_org_id") -> dict[str, DataFrame]:
    """Only the rows of the listed branches in every table."""
    return {name: df.filter(F.col(column).isin(branches)) for name, df in frames.items()}

