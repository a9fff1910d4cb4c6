"""Typed readers: tables, semicolon files, a source database and code catalogs."""

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanbook.functions.scalars import pending

LOAN_SCHEMA = T.StructType([
    T.StructField("legacy_cartera_id", T.LongType()), T.StructField("id_cartera", T.LongType()),
    T.StructField("c_bpartner_id", T.LongType()), T.StructField("ad_org_id", T.LongType()),
    T.StructField("fecha", T.TimestampNTZType()), T.StructField("dias_cre", T.IntegerType()),
    T.StructField("cuota", T.DecimalType(18, 4)), T.StructField("monto", T.DecimalType(18, 2)),
    T.StructField("valorinteres", T.DecimalType(18, 4)), T.StructField("montototal", T.DecimalType(18, 2)),
    T.StructField("abono", T.DecimalType(18, 2)), T.StructField("saldo", T.DecimalType(18, 2)),
    T.StructField("tasa", T.DecimalType(10, 4)), T.StructField("isactive", T.StringType()),
    T.StructField("synced", T.StringType()), T.StructField("local_id", T.LongType()),
    T.StructField("payment_id", T.LongType()), T.StructField("origen", T.StringType()),
    T.StructField("aprobado", T.StringType()), T.StructField("coords", T.StringType()),
    T.StructField("minilog", T.StringType()),
])

COLLECTION_SCHEMA = T.StructType([
    T.StructField("legacy_cobro_id", T.LongType()), T.StructField("id_cobro", T.LongType()),
    T.StructField("id_cartera", T.LongType()), T.StructField("c_bpartner_id", T.LongType()),
    T.StructField("abono", T.DecimalType(18, 2)), T.StructField("operacion", T.TimestampNTZType()),
    T.StructField("synced", T.StringType()), T.StructField("local_id", T.LongType()),
    T.StructField("origen", T.StringType()), T.StructField("coords", T.StringType()),
    T.StructField("created", T.TimestampNTZType()), T.StructField("createdby", T.LongType()),
    T.StructField("ad_org_id", T.LongType()),
])


def _read(spark, path, schema, fmt):
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("enforceSchema", False).csv(path)
    return r.format(fmt).load(path)


def dated(df: DataFrame, column: str) -> DataFrame:
    """The column as a day; its time stays in <column>_ts. Filters by day still reach the scan."""
    return df.withColumn(f"{column}_ts", F.col(column)).withColumn(column, F.col(column).cast("date"))


def flag_loans(df: DataFrame) -> DataFrame:
    """Loans with their pending and approved flags."""
    return df.withColumn("pendiente", pending(F.col("synced"))).withColumn(
        "aprobada", F.col("aprobado").eqNullSafe(F.lit("Y")))


def read_loans(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return flag_loans(dated(_read(spark, path, LOAN_SCHEMA, fmt), "fecha"))


def read_collections(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return dated(_read(spark, path, COLLECTION_SCHEMA, fmt), "operacion").filter(F.col("abono") > 0)


def jdbc_extract(spark: SparkSession, url: str, table: str, partition_col: str, lower: int, upper: int,
                 partitions: int, options: dict | None = None) -> DataFrame:
    """Bulk read of a source database in ranges of a numeric column.

    User and password come from the environment variables SOURCE_DB_USER and
    SOURCE_DB_PASSWORD, so that no secret is written down.
    """
    return spark.read.format("jdbc").options(**jdbc_options(
        url, table, partition_col, lower, upper, partitions, options)).load()


def jdbc_options(url, table, partition_col, lower, upper, partitions, options=None) -> dict:
    if lower >= upper or partitions < 1:
        raise ValueError("a range with at least one partition is required")
    out = {"url": url, "dbtable": table, "partitionColumn": partition_col, "lowerBound": str(lower),
           "upperBound": str(upper), "numPartitions": str(partitions), "fetchsize": "10000"}
    for key, name in (("user", "SOURCE_DB_USER"), ("password", "SOURCE_DB_PASSWORD")):
        if os.environ.get(name):
            out[key] = os.environ[name]
    return {**out, **(options or {})}


def _fields(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_f", F.split("value", ";"))


def _at(i: int):
    return F.trim(F.try_element_at(F.col("_f"), F.lit(i + 1)))


def parse_opening_balances(lines: DataFrame) -> DataFrame:
    """Card, name, date, principal, total, balance and maturity of semicolon lines.

    Fields 0-4, 6 and 7 by position. A line with a missing or unreadable field keeps its text
    in ``corrupt``.
    """
    out = _fields(lines).withColumn("tarjeta", _at(0)).withColumn("name", _at(1)).withColumn(
        "fecha", _at(2).try_cast("date"))
    for name, i in (("monto", 3), ("montototal", 4), ("saldo", 6)):
        out = out.withColumn(name, _at(i).try_cast("decimal(18,2)"))
    out = out.withColumn("vencimiento", _at(7).try_cast("date"))
    return _mark_corrupt(out, ["tarjeta", "name", "fecha", "monto", "montototal", "saldo", "vencimiento"])


def parse_partners(lines: DataFrame) -> DataFrame:
    """National id, name, address, phone, route and group: fields 2, 3, 4, 5, 7 and 10."""
    out = _fields(lines)
    for name, i in (("cedula", 2), ("nombre", 3), ("direccion", 4), ("telefono", 5)):
        out = out.withColumn(name, _at(i))
    out = out.withColumn("cv_ruta_id", _at(7).try_cast("int")).withColumn("c_bp_group_id", _at(10).try_cast("int"))
    return _mark_corrupt(out, ["cedula", "nombre", "cv_ruta_id", "c_bp_group_id"])


def _mark_corrupt(df, needed):
    bad = F.col(needed[0]).isNull()
    for c in needed[1:]:
        bad = bad | F.col(c).isNull()
    return df.withColumn("corrupt", F.when(bad, F.col("value"))).drop("_f", "value")


def read_opening_balances(spark: SparkSession, path: str) -> DataFrame:
    return parse_opening_balances(spark.read.text(path))


def read_partners(spark: SparkSession, path: str) -> DataFrame:
    return parse_partners(spark.read.text(path))


def catalogs(frames: dict[str, DataFrame], tenant: int = 1_000_000) -> DataFrame:
    """Code tables (code, value) as one long dimension (tenant, catalog, code, value)."""
    out = None
    for name, df in frames.items():
        one = df.select(F.lit(tenant).alias("tenant"), F.lit(name).alias("catalogo"),
                        F.col("code").cast("string").alias("codigo"), F.col("value").cast("string").alias("valor"))
        out = one if out is None else out.unionByName(one)
    return out


def catalog_duplicates(cat: DataFrame) -> DataFrame:
    """Codes that occur more than once in a catalog of a tenant."""
    return cat.groupBy("tenant", "catalogo", "codigo").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
