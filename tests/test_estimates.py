"""Rows that a step makes many of must not look few to Spark: it would broadcast them."""

import datetime

from pyspark.sql import functions as F

from loanbook.functions.dates import add_six_day
from loanbook.operators import interest, migration, nearest
from loanbook.sources import tables as T


def _estimate(df) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def _orders(spark, path) -> str:
    rows = [(k, k % 7, "FOP"[k % 3], 1000.0 + k, datetime.datetime(1998, 1, 1 + k % 28), f"{k % 6}-X") for k in range(1, 400)]
    rows.append((None, 1, "F", None, None, None))
    spark.createDataFrame(rows, T.SCHEMAS["orders"]).coalesce(1).write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_instalments_are_estimated_by_their_rows(spark, tmp_path):
    d = _orders(spark, tmp_path)
    ids = T.schedule(spark, d).select("legacy_schedule_id")
    assert _estimate(ids) >= 8 * ids.count()


def test_instalments_are_those_of_an_expansion(spark, tmp_path):
    d = _orders(spark, tmp_path)
    plain = T.loans(spark, d).select(
        "legacy_cartera_id", F.col("local_id").alias("c_invoice_id"), "fecha", F.explode(F.sequence(F.lit(1), F.col("dias_cre"))).alias("seq")).select(
        "legacy_cartera_id", "c_invoice_id", "seq", add_six_day(F.col("fecha"), F.col("seq")).alias("duedate"))
    made = T.schedule(spark, d).select(*plain.columns)
    assert made.count() == plain.count() and made.exceptAll(plain).isEmpty()


def test_billed_instalments_are_estimated_by_their_rows(spark, tmp_path):
    d = _orders(spark, tmp_path)
    for df in (T.invoices(spark, d).select("c_invoice_id"), T.schedule(spark, d).filter(interest.unbilled()).select("legacy_schedule_id", "dueamt")):
        assert _estimate(df) >= 8 * df.count()


def test_pieces_of_names_are_not_broadcast(spark):
    """Names and their pieces are written tables of a few bytes, their pieces very many."""
    base = spark.range(300).select(F.format_string("partner %06d", "id").alias("nombre"), F.col("id").alias("c_bpartner_id"))
    rows = base.select(F.col("c_bpartner_id").alias("row_id"), F.concat("nombre", F.lit("x")).alias("name"))
    shown = []
    write = migration.written
    migration.written = lambda df, name: shown.append((name, _plan(df))) or write(df, name)
    try:
        found = migration.nearest_partner(rows, base)
    finally:
        migration.written = write
    joins = [plan.split("_piece")[0] for name, plan in shown if name == "near"]
    assert len(joins) == 2 and all("BroadcastHashJoin" not in j.split("SortMergeJoin")[0] and "SortMergeJoin" in j for j in joins)
    assert {(r.row_id, r.c_bpartner_id, r.distancia) for r in found.collect()} == {(k, k, 1) for k in range(300)}


def test_many_children_are_not_broadcast(spark, monkeypatch):
    """Above FEW_CHILDREN a level is met by key; the nearest names stay the same."""
    base = spark.range(200).select(F.format_string("partner %06d", F.col("id") * 37).alias("member"), F.col("id").alias("ident"))
    names = spark.createDataFrame([("x" * 14,), ("someone 0037",), ("",)], "name string")
    few = nearest.Index(base).nearest(names).collect()
    monkeypatch.setattr(nearest, "FEW_CHILDREN", 0)
    index = nearest.Index(base)
    front = index._at_lengths(index._counted(names, "name"))
    assert "SortMergeJoin" in _plan(index._down(front, 0))
    assert sorted(index.nearest(names).collect()) == sorted(few)
