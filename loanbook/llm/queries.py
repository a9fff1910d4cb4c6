"""Queries of this subpackage: name -> (function of the session and the folder, SQL or None)."""

import string

import public_tokenizers
from pyspark.sql import functions as F

from loanbook.llm import decontaminate, language_model, line_dedup, merkle, minhash, oracles, packing, perspectives, pieces, preference, quality_rules, repair, substring_dedup, warc
from loanbook.llm.shared import table

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return add


@query("op8_minhash_near_dedup", oracles.OP8)
def near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_benchmark_decontamination", oracles.OP10)
def decontamination(spark, sf_dir):
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        "items_sha256", "contaminated")


@query("op2_quality_rules", oracles.op2(quality_rules.MEASURES, quality_rules.LEAST, quality_rules.SPREADS))
def rules(spark, sf_dir):
    found = quality_rules.judged(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


@query("op1_line_dedup", oracles.op1(line_dedup.RARITY))
def lines(spark, sf_dir):
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "text", "n_lines", "n_removed")


@query("op5_best_fit_packing")
def pack(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_lm_scoring")
def scores(spark, sf_dir):
    return language_model.scored(table(spark, sf_dir, "documents"))


@query("op6_warc", oracles.OP6)
def archives(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_substring_dedup")
def passages(spark, sf_dir):
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))


@query("op3_quality_classifier")
def classifier(spark, sf_dir):
    return preference.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_chat_formatting", oracles.OP9)
def chat(spark, sf_dir):
    return perspectives.rotated(table(spark, sf_dir, "conversations"))


@query("op13_sentencepiece")
def encoding(spark, sf_dir):
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_merkle_manifest", oracles.op12())
def witnesses(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    leaves = merkle.document_leaves(docs, F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, lower))
    return merkle.manifest(leaves).withColumnRenamed("id", "doc_id")


@query("op11_structure_repair", oracles.OP11)
def structure(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return repair.audited(damaged(turns), turns)


def damaged(turns):
    """The faults that the query repairs: what happens to a row follows from its key."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, role, way = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" ")), F.crc32(key) % 20
    return turns.where(way != 0).select(
        "conv_id", "turn", F.when(way == 4, "user").otherwise(role).alias("role"),
        F.when(way == 1, "").when(way == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(way == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")
