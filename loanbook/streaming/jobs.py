"""Incremental jobs over newly arrived files.

Each job reads new files only (the stream's checkpoint remembers which), handles them as
one batch and writes that batch under its own folder. A batch that runs again after a
failure overwrites its folder, so every row counts once. What has to be remembered of earlier
rows is state of the stream, in a store on disk.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.operators.balances import invoice_open
from loanbook.operators.bridges import bridge_collections
from loanbook.session import written


STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _run(stream: DataFrame, each, checkpoint: str, mode: str = "append") -> None:
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    q = (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode(mode)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()


def first_seen(stream: DataFrame, key: str) -> DataFrame:
    """One row for each key of a batch, with whether the key is ``new`` in this batch; to be written in update mode.

    The state of the stream holds the keys, by hash, with the time of the batch that brought them. A
    batch reads and writes those of its own rows only; one that runs again starts from the state before it and has the
    same time. Of copies within a batch the smallest row counts.
    """
    rest = [c for c in stream.columns if c != key]
    stamped = stream.withColumn("_at", F.current_timestamp())
    found = stamped.groupBy(key).agg(
        F.min(F.struct(*rest)).alias("_row"), F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    return found.select(key, "_row.*", (F.col("_first") == F.col("_last")).alias("new"))


def bridge_collections_stream(stream: DataFrame, loans, partners, users, out: str, checkpoint: str,
                              key: str = "legacy_cobro_id") -> None:
    """Receipts and rejects for newly arrived collections, each collection once.

    However late a copy arrives, it meets its key in the state of the stream (``first_seen``). A row that is
    no pending native collection gives neither a receipt nor a reject. Results and checkpoint belong together: a new
    checkpoint starts anew, into a folder of its own.
    """
    owner = loans.select(F.col("legacy_cartera_id").alias("id_cartera"), "c_bpartner_id")

    def each(batch: DataFrame, batch_id: int) -> None:
        # Written once: each result that read the batch itself would go through the files and the state again.
        fresh = written(batch.where("new").drop("new"), "fresh")
        rows = fresh if "c_bpartner_id" in fresh.columns else fresh.join(owner, "id_cartera", "left")
        made = bridge_collections(rows, partners, users)
        for name in ("payments", "rejects"):
            made[name].write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")

    _run(first_seen(stream, key), each, checkpoint, "update")


def invoice_open_stream(stream: DataFrame, allocations, out: str, checkpoint: str) -> None:
    """Keep the open-item snapshot current on each change of a customer invoice.

    ``stream``: c_invoice_id, c_bpartner_id, dateinvoiced, grandtotal, issotrx, version. A
    batch writes the latest change of each of its invoices; ``open_snapshot`` merges them.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        sales = batch.filter((F.col("issotrx") == "Y") & (F.col("c_bpartner_id") > 0))
        last = sales.groupBy("c_invoice_id").agg(F.max_by(
            F.struct("c_bpartner_id", "dateinvoiced", "grandtotal", "version"), "version").alias("x")).select(
            "c_invoice_id", "x.*")
        invoice_open(last, allocations).select(
            "c_invoice_id", "c_bpartner_id", "dateinvoiced", F.col("open").alias("saldo"), "version"
        ).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(stream, each, checkpoint)


def open_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """Latest state of each invoice over all batches."""
    rows = spark.read.parquet(out)
    return rows.groupBy("c_invoice_id").agg(F.max_by(
        F.struct("c_bpartner_id", "dateinvoiced", "saldo"), F.struct("version", "batch")).alias("x")).select(
        "c_invoice_id", "x.*")


def file_stream(spark: SparkSession, folder: str, schema, pattern: str, files: int | None = None) -> DataFrame:
    """Files of a folder as a stream, with at most ``files`` of them in a batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(folder)
