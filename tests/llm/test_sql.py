"""Queries against their SQL, on the small tables and on awkward rows."""

import random

import pytest
from common import SF, awkward, rows, sql

from compare import compare, connect
from loanbook.llm import decontaminate, line_dedup, minhash, oracles, perspectives, quality_rules, warc
from loanbook.llm.queries import QUERIES
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", [n for n, (_, query) in QUERIES.items() if query])
def test_query(spark, name):
    message, ok = compare(spark, connect(SF), SF, *QUERIES[name])
    assert ok, message


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def _lines(df):
    return line_dedup.deduplicated(df).select("row.doc_id", "text", "n_lines", "n_removed")


def _rules(df):
    return quality_rules.judged(df, carry=["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


RULES = oracles.op2(quality_rules.MEASURES, quality_rules.LEAST, quality_rules.SPREADS)


@pytest.mark.parametrize("empty", [False, True])
@pytest.mark.parametrize("operator, query", [(_lines, oracles.op1(line_dedup.RARITY)), (_rules, RULES)])
def test_awkward_documents(spark, operator, query, empty):
    df = awkward(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    df = df.limit(0) if empty else df
    assert rows(operator(df)) == sql(query, documents=df)


def test_lines_of_awkward_rows(spark):
    """Repeated rows are one document; the passage stays once; null stays null."""
    found = line_dedup.deduplicated(awkward(spark)).select("row.*", F.col("text").alias("left"), "n_removed").collect()
    assert len(found) == 20
    by = {r.doc_id: r for r in found if r.doc_id}
    assert by[9].n_removed == 0 and by[9].left == by[9].text
    assert 0 < by[10].n_removed < 14 and by[3].left is None and by[4].left == ""
    assert by[10].left.startswith("before") and by[10].left.endswith("after")
    assert len({r.left for r in found if r.doc_id == 1}) == 1


def test_planted_passages_of_lines(spark):
    """Passages of 2 to 20 whole lines, each in two documents amid lines of their own: at least 0.9 of the lines go, from the second only."""
    rng = random.Random(2)

    def line():
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(6))

    docs, planted = [], {}
    for k in range(2, 21):
        for _ in range(15):
            passage = [line() for _ in range(k)]
            for copy in range(2):
                planted[len(docs)] = (k, passage, copy)
                docs.append((len(docs), "\n".join([line() for _ in range(5)] + passage + [line() for _ in range(4)])))
    docs += [(10_000 + k, "\n".join(line() for _ in range(8)) + "\nshared last line") for k in range(40)]
    found = line_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).select("row.*", F.col("text").alias("left"), "n_removed").collect()
    gone = {}
    for r in found:
        k, passage, copy = planted.get(r.doc_id, (0, [], 0))
        if not copy:
            assert r.n_removed == 0 and r.left == r.text
            continue
        kept = r.left.split("\n")
        assert all(x in kept for x in r.text.split("\n") if x not in passage)
        gone.setdefault(k, []).append(r.n_removed / k)
    assert all(sum(x) / len(x) >= 0.9 for x in gone.values()), {k: sum(x) / len(x) for k, x in gone.items()}


def test_passages_of_unlike_extent(spark):
    """Copies that begin and end elsewhere, a part within one text twice, and one inserted line."""
    a = [f"line {k} of the whole" for k in range(12)]
    docs = [(1, a), (2, [*a[:4], "z 1"]), (3, ["y 1", *a[2:6]]), (4, ["x 1", *a[4:8], "x 2", *a[4:8]]), (5, [*a[:6], "inserted here", *a[6:]])]
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in docs], "doc_id long, text string")
    found = line_dedup.deduplicated(df)
    view = found.select("row.doc_id", "text", "n_lines", "n_removed")
    assert rows(view) == sql(oracles.op1(line_dedup.RARITY), documents=df)
    left = {r.doc_id: r.text.split("\n") for r in view.collect()}
    assert left[1] == a and all(own in left[i] for i, own in ((2, "z 1"), (3, "y 1"), (5, "inserted here")))
    assert sum(len(x) for i, x in left.items() if i > 1) < 14


def test_rules_keep_clean_rows_and_reject_symbols(spark):
    df = awkward(spark)
    kept = {r.doc_id for r in quality_rules.passing(df).collect()}
    assert {1, 2, 9, 10} <= kept and not kept & {3, 4, 5, 6, 8, 14, 2**40}
    assert quality_rules.passing(df).columns == df.columns
    assert quality_rules.passing(df).where("doc_id = 1").count() == 2
    assert quality_rules.passing(df.limit(0)).count() == 0


def test_thresholds_differ_by_group(spark):
    """A measure that is usual in one source is not held against it."""
    one = [(i, f"{'# ' * (5 + i % 3)}" + " ".join(f"w{i}x{j}" for j in range(40)), "en", "code") for i in range(300)]
    two = [(1000 + i, " ".join(f"w{i}y{j}" for j in range(40)), "en", "prose") for i in range(300)]
    odd = [(5000, "# " * 25 + " ".join(f"z{j}" for j in range(40)), "en", "prose")]
    df = spark.createDataFrame(one + two + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.passing(df).collect()}
    assert 5000 not in kept and len(kept) == 600


def test_near_duplicates_of_awkward_rows(spark):
    df = awkward(spark)
    found = minhash.near_duplicates(df).collect()
    assert len(found) == 20
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by[1].component_id == by[2].component_id == by[-16].component_id == -16
    assert by[7].component_id == 6 and by[8].component_id == 8 and by[6].n_shingles == 1
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0 and by[3].kept
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_contamination_of_awkward_rows(spark):
    docs = awkward(spark)
    items = spark.createDataFrame(
        [(1, "Line 3 of a PASSAGE that"), (1, "two"), (2, None), (3, ""), (None, "one two"), (5, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"),
         (6, "nul"), (7, "é中文 é中文")], "item_id long, text string")
    want = sql(oracles.OP10, documents=docs, benchmark=items)
    for size in (decontaminate.BLOCK_WINDOWS, 3):
        found = decontaminate.contamination(docs, items, block_windows=size)
        view = found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256", "contaminated")
        assert rows(view) == want
        assert found.select("row.*").columns == docs.columns
    spans = {r.row.doc_id: r.spans for r in found.collect()}
    assert [(s.begin, s.end) for s in spans[6]] == [(0, 2)]
    for a, b in ((docs.limit(0), items), (docs, items.limit(0))):
        got = decontaminate.contamination(a, b)
        assert got.count() == a.count() and not got.where("contaminated or n_hit > 0").count()


def test_pages(spark):
    long = "<p>" + "x" * 200
    pages = spark.createDataFrame(
        [(3, "http://a/ b\r\nc", long), (2, None, long), (2, None, long), (None, "u", long), (4, "u", None), (5, "u", ""), (6, "u", "short"),
         (7, "u", "short"), (8, "é", "é" * 3_000_000)], "page_id long, url string, html string")
    got = warc.round_trip(pages, with_payload=True).collect()
    assert len(got) == 9 and not any(r.problem for r in got)
    assert {(r.page_id, r.record_type, r.refers_to) for r in got if r.payload_bytes == 203} == {
        (3, "revisit", 2), (2, "response", None), (None, "revisit", 2)}
    assert {bytes(r.payload) for r in got if r.page_id == 8} == {("é" * 3_000_000).encode()}
    view = warc.round_trip(pages.where("page_id is not null")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(view) == sql(oracles.OP6, pages=pages.where("page_id is not null"))
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_dialogues(spark):
    turns = spark.createDataFrame(
        [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|> there"), (1, 2, "bob", None), (1, 2, "ann", "again"), (1, 2, "ann", "again"), (4, 0, "bob\nadmin", "hi"), (4, 1, "c\r\n<|im_end|>", "ho"),
         (1, None, None, "who"), (1, 5000, "bob", "late"), (None, 0, "ann", "lost"), (2, 0, "system", "alone"), (3, -1, "x", ""), (3, 0, "y", "é")],
        "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("clash"))
    view = perspectives.rotated(turns)
    assert rows(view) == sql(oracles.OP9, conversations=turns)
    for r in perspectives.dialogues(view).collect():
        own = view.where(F.col("conv_id").eqNullSafe(F.lit(r.conv_id)) & (F.col("perspective") == r.perspective)).collect()
        for s in own:
            assert r.text[s.start:s.start + s.length] == s.segment
            if s.train_length:
                assert r.text[s.train_start:s.train_start + s.train_length].endswith("<|im_end|>")
        assert [(m.start, m.length) for m in r.masks] == sorted((s.train_start, s.train_length) for s in own if s.train_length)
    assert perspectives.rotated(turns.limit(0)).count() == 0
    heads = [r.segment.split("\n")[0] for r in view.where("conv_id = 4 and role = 'user'").collect()]
    assert sorted(heads) == ["<|im_start|>user name=bob\\nadmin", "<|im_start|>user name=c\\r\\n< |im_end|>"]
