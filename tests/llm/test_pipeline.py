"""Each stage of the pipeline against SQL or a plain loop on what it was given."""

import numpy as np
from common import SF, awkward, documents, rows, sql
from test_near import _truth

import corpus_pipeline as cp
from loanbook.llm import line_dedup, oracles
from loanbook.llm.shared import keep
from test_sql import RULES


def test_stages(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    sf = "/root/testdata/sf0.01"
    kept = cp.quality(spark, docs, sf).cache()
    assert kept.columns == cp.COLUMNS
    assert rows(kept.select("doc_id")) == sql(f"SELECT doc_id FROM ({RULES}) AS x WHERE kept", documents=docs)

    lines = cp.lines(spark, kept, sf).cache()
    assert lines.columns == cp.COLUMNS
    assert rows(lines.select("doc_id", "text")) == sql(f"SELECT doc_id, text FROM ({oracles.op1(line_dedup.RARITY)}) AS x", documents=kept)

    alone = cp.near_duplicates(spark, lines, sf).cache()
    texts = {r.doc_id: r.text.lower() for r in lines.collect()}
    assert {r.doc_id for r in alone.collect()} == {i for i, c in _truth({i: t for i, t in texts.items()}).items() if i == c}

    clean = cp.benchmark(spark, alone, sf).cache()
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert rows(clean.select("doc_id")) == sql(
        f"SELECT doc_id FROM ({oracles.OP10}) AS x WHERE NOT contaminated", documents=alone, benchmark=items)

    packed = cp.pack(spark, clean, sf).toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in clean.collect()}
    fill = packed.groupby("sequence_id").length.sum()
    assert fill.max() <= 2048 and len(fill) <= np.ceil(packed.length.sum() / 2048) + 3


def test_run(spark):
    assert [name for name, _ in cp.STAGES] == ["quality rules", "line dedup", "near duplicates", "benchmark decontamination", "best-fit packing"]
    got = cp.run(spark, SF)
    assert got.count() > 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns)


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0, name


def test_awkward_rows(spark):
    """Nulls in any column, repeated rows and ids, very long texts and clashing columns pass through every stage."""
    docs, left = awkward(spark), 20
    for name, stage in cp.STAGES[:-1]:
        docs = keep(stage(spark, docs, SF), "stage")
        assert docs.columns == cp.COLUMNS and docs.count() <= left, name
        left = docs.count()
    ids = {r.doc_id for r in docs.collect()}
    # The passage, the prose under its least id and the long rows stay; blank, short and copied rows go.
    assert 9 in ids and not ids & {3, 4, 5, 6, 8, 14}
    packed = cp.pack(spark, docs, SF)
    assert packed.where("piece = 0").count() == left
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
