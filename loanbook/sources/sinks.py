"""Writing results: period partitions, upserts by business key, flat exports."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_period(df: DataFrame, path: str, column: str = "c_period_id", periods: list | None = None) -> None:
    """Replace the periods present in the data, and those listed, and leave the others as they are.

    A listed period without rows is left empty. Name the periods of a run, so that one whose
    new result is empty does not keep its old rows. The write itself counts the rows of these periods.
    """
    seen = Observation()
    counted = df.observe(seen, *[F.count(F.when(F.col(column) == F.lit(p), 1)).alias(f"p{k}") for k, p in enumerate(periods)]) if periods else df
    counted.write.partitionBy(column).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").parquet(path)
    for k, period in enumerate(periods or []):
        if not seen.get[f"p{k}"]:
            nothing = df.sparkSession.createDataFrame([], df.drop(column).schema)
            nothing.write.mode("overwrite").parquet(f"{path}/{column}={period}")


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], cols: list[str] | None = None) -> DataFrame:
    """Rows of the target with ``cols`` replaced where a key matches, plus the new keys.

    Keys compare null-safe, so a null key is one key and does not insert again. ``updates``
    must hold one row per key.
    """
    cols = cols or [c for c in updates.columns if c not in keys]
    t, u = target.alias("t"), updates.alias("u")
    on = None
    for k in keys:
        cond = F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}"))
        on = cond if on is None else on & cond
    t = t.withColumn("_old", F.lit(True)).alias("t")
    u = u.withColumn("_new", F.lit(True)).alias("u")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.when(F.col("t._old"), F.col(f"t.{c}")).otherwise(F.col(f"u.{c}")).alias(c))
        elif c in cols:
            out.append(F.when(F.col("u._new"), F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in updates.columns:
            out.append(F.when(F.col("t._old"), F.col(f"t.{c}")).otherwise(F.col(f"u.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return t.join(u, on, "full").select(*out)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
