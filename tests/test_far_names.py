"""Far names against all partners, and how few of them they meet."""

import random

import pytest
from pyspark.sql import functions as F

from loanbook.operators import migration, nearest


def _best(names, base):
    pairs = names.crossJoin(base).groupBy("name").agg(F.min(F.struct(F.levenshtein("name", "bp_name").alias("d"), "c_bpartner_id")).alias("m"))
    return {r.name: (r.m.c_bpartner_id, r.m.d) for r in pairs.collect()}


def _found(far):
    return {r.name: (r.c_bpartner_id, r.distancia) for r in far.collect()}


def test_numbered_names(spark):
    base = spark.range(9_000).select(F.format_string("partner %06d", "id").alias("bp_name"), F.col("id").alias("c_bpartner_id"))
    names = spark.createDataFrame([("x" * 14,), ("partner 00",), ("",), ("une personne inconnue partner 004711",)], "name string")
    far = migration._far(names, base)
    assert "Window" not in far._jdf.queryExecution().optimizedPlan().toString()
    assert _found(far) == {"x" * 14: (0, 14), "partner 00": (0, 4), "": (0, 14), "une personne inconnue partner 004711": (4711, 22)}


@pytest.mark.parametrize("seed, letters, sizes", [(1, "abcdefgh", (5, 9)), (2, "01", (10, 20)), (3, "aé中 xyz", (0, 6)), (4, "abc", (8, 9))])
def test_random_names(spark, seed, letters, sizes):
    """Short and long names of few letters have many ties; ids are not in the order of names."""
    rnd = random.Random(seed)
    words = list({"".join(rnd.choice(letters) for _ in range(rnd.randrange(*sizes))) for _ in range(300)})
    base = spark.createDataFrame([(w, rnd.randrange(10**9)) for w in words[:200]], "bp_name string, c_bpartner_id long")
    names = spark.createDataFrame([(w,) for w in [*words[200:], "someone else " + words[0], "?"]], "name string").distinct()
    assert _found(migration._far(names, base)) == _best(names, base)


def test_few_pairs_meet(spark):
    """Of 4,000 x 400 pairs under 2 % are compared."""
    base = spark.range(4_000).select(F.format_string("Customer#%09d", F.col("id") * 37).alias("member"), F.col("id").alias("ident"))
    index = nearest.Index(base)
    names = spark.range(400).select(F.format_string("Tercero desconocido Customer#%09d", F.col("id") * 370).alias("name"))
    known = index._counted(names, "name")
    guesses = index.first_guesses(known).withColumnRenamed("ident", "guess")
    pairs = index.candidates(known.join(guesses, "name"))
    assert pairs.count() < 0.02 * 4_000 * 400
    assert {(r.distance, r.ident) for r in index.nearest(names).collect()} == {(20, k) for k in range(0, 4_000, 10)}


def test_no_partners(spark):
    base = spark.createDataFrame([], "bp_name string, c_bpartner_id long")
    assert migration._far(spark.createDataFrame([("a",)], "name string"), base).count() == 0
    rows = spark.createDataFrame([(1, "a")], "row_id long, name string")
    found = migration.nearest_partner(rows, base.withColumnRenamed("bp_name", "nombre")).collect()
    assert [(r.row_id, r.c_bpartner_id, r.distancia) for r in found] == [(1, None, None)]
