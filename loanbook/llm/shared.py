"""Intermediate tables in the folder that driver and executors share."""

from pyspark.sql import DataFrame, SparkSession

from loanbook.session import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below spark.checkpoint.dir and read it back.

    This cuts the lineage: a lost executor costs only the tasks of the step that is running.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
