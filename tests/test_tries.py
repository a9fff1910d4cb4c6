"""Nearest names by blocks and tries, against plain comparisons."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanbook.operators import migration, tries
from loanbook.sources import readers


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def _words(rnd, letters, longest, n):
    return list({"".join(rnd.choice(letters) for _ in range(rnd.randrange(longest))) for _ in range(n)})


@pytest.mark.parametrize("cells", [4_000_000, 40])
@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abcdefgh"), (3, "aé中😀 x"), (4, "0123456789")])
def test_search(monkeypatch, cells, seed, letters):
    """Few cells cut the search into parts. Ids repeat, and some rows have none."""
    monkeypatch.setattr(tries, "CELLS", cells)
    rnd = random.Random(seed)
    texts, names = _words(rnd, letters, 9, 80), _words(rnd, letters + "z", 13, 30)
    idents = np.array([rnd.randrange(50) if rnd.random() < 0.9 else tries._LAST for _ in texts])
    trie, far = tries.Trie(texts, idents), np.full(len(names), tries._LAST)
    q, row, d = trie.search(names, far, far)
    for k, at, most in zip(q, row, d):
        assert (most, idents[at]) == min((_distance(names[k], t), i) for t, i in zip(texts, idents)) and _distance(names[k], texts[at]) == most
    assert list(q) == list(range(len(names)))
    q, row, d = trie.search(names, far, far, 2)
    assert list(q) == list(range(len(names))) and all(_distance(names[k], texts[at]) == f for k, at, f in zip(q, row, d))
    most, ident = (np.array([rnd.randrange(n) for _ in names]) for n in (6, 50))
    got = zip(*(x.tolist() for x in trie.search(names, most, ident, every=True)))
    assert sorted(got) == [(k, j, d) for k, n in enumerate(names) for j, t in enumerate(texts)
                           if ((d := _distance(n, t)), idents[j]) < (most[k], ident[k])]


@pytest.mark.parametrize("seed, letters", [(5, "abcd"), (6, "0123")])
def test_blocks(spark, monkeypatch, seed, letters):
    """Many small blocks and groups; ties across blocks go to the least id, rows without id come last."""
    monkeypatch.setattr(tries, "BLOCK", 20)
    monkeypatch.setattr(tries, "CHUNK", 7)
    rnd = random.Random(seed)
    texts, names = _words(rnd, letters, 9, 200), _words(rnd, letters + "x", 14, 60)
    base = [(rnd.randrange(1000) if rnd.random() < 0.9 else None, t) for t in texts]
    blocks = tries.Blocks(spark.createDataFrame(base, "ident long, member string"))
    assert len({t[0] for t in blocks.tops}) > 4
    got = {r.name: (r.distance, r.ident) for r in blocks.nearest(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    want = {n: min((_distance(n, t), i is None, i or 0) for i, t in base) for n in names}
    assert got == {n: (d, None if none else i) for n, (d, none, i) in want.items()}


def test_far_names_meet_few_blocks(spark, monkeypatch):
    """Names with the same digits in another order are told apart by prefix: hardly any goes to a second block."""
    monkeypatch.setattr(tries, "BLOCK", 250)
    sent, write = [], tries.written
    monkeypatch.setattr(tries, "written", lambda df, name: sent.append(write(df, name)) or sent[-1])
    base = spark.range(5_000).select(F.format_string("Customer#%09d", F.col("id") * 7).alias("bp_name"), F.col("id").alias("c_bpartner_id"))
    names = base.select(F.concat(F.lit("Tercero desconocido "), "bp_name").alias("name"))
    found = migration._far(names, base)
    routes = sent[-1].count()  # those of the second visit
    assert routes < 0.2 * 5_000
    assert found.where("distancia <> 20").isEmpty() and found.join(
        base, F.concat(F.lit("Tercero desconocido "), "bp_name") == F.col("name")).where(base.c_bpartner_id == found.c_bpartner_id).count() == 5_000


def test_no_pieces_of_names_that_are_too_long(spark, monkeypatch):
    """A name whose length differs by more from that of every partner makes no pieces for the near steps."""
    made, pieces = [], migration._deletions
    spot = spark.sparkContext.accumulator(0)
    keep = F.udf(lambda x: spot.add(1) or x)
    monkeypatch.setattr(migration, "_deletions", lambda name, most: made.append(most) or pieces(keep(name), most))
    partners = spark.createDataFrame([(1, "ana maria"), (2, "luis")], "c_bpartner_id long, nombre string")
    rows = spark.createDataFrame([(k, f"nadie que se conozca {k}") for k in range(50)], "row_id long, name string")
    found = migration.nearest_partner(rows, partners).collect()
    assert made and spot.value == 0 and len(found) == 50


def test_opening_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([(1, "1;ana;1998-01-01;10;12;x;6;1998-02-01"), (2, "2;ana;nie;10;12;x;6;1998-02-01"), (3, "3;eva;1998-01-01;10;12;x;6;1998-02-01")], "row_id long, value string")
    partners = spark.createDataFrame([(7, "ana", 4)], "c_bpartner_id long, nombre string, ad_org_trx_id int")
    rows = readers.parse_opening_balances(lines)
    out = migration.opening_loans(rows, migration.nearest_partner(rows, partners), partners, spark.createDataFrame([], "c_bpartner_id long"))
    assert all("split(" not in df._jdf.queryExecution().optimizedPlan().toString() for df in out.values())
    assert [(r.row_id, r.c_bpartner_id) for r in out["loans"].collect()] == [(1, 7)]
    assert {(r.row_id, r.motivo) for r in out["rejects"].collect()} == {(2, "linea no valida"), (3, "tercero con prestamo migrado")}
