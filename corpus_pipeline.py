"""A corpus pipeline in five stages, each by one of the operators of loanbook.llm.

Every stage works on all rows that its predecessor kept. The first four return the columns of
documents, the last one the pieces of the packed sequences.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanbook.llm import decontaminate, line_dedup, minhash, packing, quality_rules
from loanbook.llm.shared import keep, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie beyond a fence of their language and source go."""
    return quality_rules.passing(docs).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go; n_chars follows the text. No document goes."""
    kept = line_dedup.deduplicated(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars")
    return kept.select("row.doc_id", "text", "row.lang", "row.source", n_chars)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    gone = keep(minhash.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    return docs.join(gone, docs.doc_id == gone.gone, "left_anti").select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where("not contaminated").select("row.*").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and offset."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
          ("benchmark decontamination", benchmark), ("best-fit packing", pack)]

#: Packing has no SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
