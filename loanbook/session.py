"""Session for local runs. On a cluster the given session is used as it is."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "loanbook", cpus: str | None = None, partitions: int = 8) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder inside the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: later steps read it, and its lineage ends there."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; only local runs get a folder of their own."""
    if spark.conf.get("spark.checkpoint.dir", None):
        folder = spark.conf.get("spark.checkpoint.dir")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
    elif spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loanbook-"))
