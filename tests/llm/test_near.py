"""Near-duplicates, passages and components against plain loops."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from common import awkward, documents

from loanbook.llm import minhash, substring_dedup
from loanbook.llm.components import components
from pyspark.sql import functions as F


def _words(rng, n):
    return [f"w{rng.randrange(100_000)}" for _ in range(n)]


def _edited(rng, words, share):
    return [f"e{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


def _truth(texts):
    """Smallest id reachable over pairs of similar shingle sets, counting common shingles pair by pair."""
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if (w := t.split()) else set() for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders, common = {}, Counter()
    for i in sorted(texts):
        for s in sets[i]:
            for j in holders.setdefault(s, []):
                common[i, j] += 1
            holders[s].append(i)
    for (i, j), n in common.items():
        if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def test_stars_chains_and_strangers(spark):
    """Copies of one text that resemble it but not each other, chains of edits, unrelated texts."""
    rng = random.Random(3)
    texts, n = {}, 0
    for size in (3, 60, 250):
        base = _words(rng, 200)
        for k in range(size):
            texts[n] = " ".join(base if k == size // 2 else _edited(rng, base, 0.022))
            n += 1
    link = _words(rng, 150)
    for _ in range(30):
        texts[n] = " ".join(link)
        link, n = _edited(rng, link, 0.02), n + 1
    for _ in range(100):
        texts[n], n = " ".join(_words(rng, 100)), n + 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert got == _truth(texts)


def test_template_group(spark):
    """A form of 30 fields with two values each besides the usual one: rows are below the threshold to the form, some just over it to each other."""
    rng = random.Random(11)
    form = _words(rng, 190)
    places = range(5, 185, 6)
    texts = [form]

    def filled(values):
        return [f"value{k}x{values[k]}" if k in values else w for k, w in enumerate(form)]

    for k in range(2000):
        values = {p: rng.randrange(2) for p in rng.sample(places, 8)}
        texts.append(filled(values))
        if k < 600:  # another row with five of the values, one field changed, and two others
            keys = rng.sample(sorted(values), 6)
            more = rng.sample([p for p in places if p not in values], 2)
            texts.append(filled({p: values[p] for p in keys[1:]} | {keys[0]: 1 - values[keys[0]]} | {p: rng.randrange(2) for p in more}))
    rng.shuffle(texts)
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in texts]
    number = {x: k for k, x in enumerate(sorted(set().union(*sets)))}
    has = np.zeros((len(sets), len(number)), np.float32)
    for k, own in enumerate(sets):
        has[k, [number[x] for x in own]] = 1
    common, size = has @ has.T, has.sum(axis=1)
    linked = 100 * common >= 75 * (size[:, None] + size[None, :] - common)
    least = np.arange(len(sets))
    while (now := np.where(linked, least[None, :], len(sets)).min(axis=1)).tolist() != least.tolist():
        least = now
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    wrong = [k for k in got if got[k] != least[k]]
    assert not wrong, f"{len(wrong)} of {len(texts)}, {(least != np.arange(len(sets))).sum()} linked to a smaller one"


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5, 5), (None, 7), (9000, 8000), (8000, 9000)]
    links += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(120)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in root if any(i in e and e[0] != e[1] for e in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_planted_passages(spark):
    rng = random.Random(8)
    rows, planted = [], set()
    for k in range(60):
        passage = " ".join(_words(rng, 51))
        for j in range(3):
            planted.add(3 * k + j)
            rows.append((3 * k + j, " ".join([*_words(rng, rng.randrange(80)), passage, *_words(rng, rng.randrange(80))])))
    license = "\nThis work is licensed under the GNU General Public License, version 3."
    clean = [(1000 + k, " ".join(_words(rng, 150)) + license) for k in range(100)]
    texts = dict(rows + clean)
    df = spark.createDataFrame(rows + clean, "doc_id long, text string").repartition(3)
    spans = substring_dedup.repeated_spans(df).collect()
    assert {s.doc_id for s in spans} == planted
    every = "\0".join(texts.values()).encode()
    for s in spans:
        piece = texts[s.doc_id].encode()[s.start:s.start + s.length]
        assert s.n_words >= substring_dedup.LEAST_WORDS and every.count(piece) >= 2
    assert {s.doc_id for s in spans if not s.removed} >= {3 * k for k in range(60)}
    assert {s.doc_id for s in spans if s.removed} == planted - {3 * k for k in range(60)}
    left = {r.doc_id: r.text for r in substring_dedup.deduplicated(df).collect()}
    gone = {}
    for s in spans:
        gone.setdefault(s.doc_id, []).append(s)
    for i, text in texts.items():
        raw, out, at = text.encode(), b"", 0
        for s in sorted((s for s in gone.get(i, []) if s.removed), key=lambda s: s.start):
            out, at = out + raw[at:s.start], s.start + s.length
        assert left[i] == (out + raw[at:]).decode()


def _plain_units(raw):
    """(begin, end) of the units of a text, with plain loops."""
    gear, n, r = substring_dedup._GEAR.tolist(), len(raw), substring_dedup.RADIUS
    hashes = []
    for i in range(n):
        h = sum(gear[raw[i - j]] << j for j in range(min(16, i + 1))) & 0xFFFFFFFF
        h = ((h ^ h >> 15) * 0x2C1B3C6D) & 0xFFFFFFFF
        hashes.append(0xFFFFFFFF if i + 1 < n and raw[i + 1] & 0xC0 == 0x80 else h)
    ends = [i + 1 for i, h in enumerate(hashes) if h < 0xFFFFFFFF and all(h < x for x in hashes[max(0, i - r):i]) and all(h <= x for x in hashes[i + 1:i + 1 + r])]
    ends = sorted({*ends, n}) if n else []
    begins = [0, *ends[:-1]]
    return [(begins[k], ends[min(k + 1, len(ends) - 1)]) for k in range(max(1, len(ends) - 1))] if ends else []


def _plain_spans(rows, least):
    """The whole result: every unit of every document against all others by its bytes."""
    docs = {(r.doc_id is None, r.doc_id or 0, r.h): (r.text or "").encode() for r in rows}
    copies = Counter((r.doc_id is None, r.doc_id or 0, r.h) for r in rows)
    places = defaultdict(list)
    for key, raw in docs.items():
        for x, y in _plain_units(raw):
            places[raw[x:y]] += [(key, x, y)] * copies[key]
    marked = defaultdict(list)
    for found in places.values():
        if len(found) > 1:
            first = min(k for k, _, _ in found)
            seen = set()
            for key, x, y in sorted(set(found)):
                marked[key, key != first or key in seen].append((x, y))
                seen.add(key)
    out = []
    for (key, removed), units in marked.items():
        spans = []
        for x, y in sorted(units):
            if spans and x <= spans[-1][1]:
                spans[-1][1] = max(y, spans[-1][1])
            else:
                spans.append([x, y])
        for x, y in spans:
            begins = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", docs[key])]
            n = sum(x <= b < y for b in begins)
            if n >= least:
                out.append((None if key[0] else key[1], x, y - x, n, removed))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", ["documents", "awkward", "same ids"])
def test_spans_equal_a_plain_version(spark, kind):
    rng = random.Random(3)
    passage = " ".join(_words(rng, 60))
    same = [(7, passage + " one"), (7, "two " + passage), (None, passage), (None, passage + " é中 " + passage), (8, None), (7, passage + " one"), (9, "")]
    df = {"documents": lambda: documents(spark).where("length(text) < 3000").limit(120), "awkward": lambda: awkward(spark).where("length(text) < 9000 or text is null"),
          "same ids": lambda: spark.createDataFrame(same, "doc_id long, text string")}[kind]()
    rows = df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    df = spark.createDataFrame(rows, "doc_id long, text string, h long").withColumn("_id", F.lit("clash")).withColumn("_spans", F.lit("clash"))
    found = substring_dedup.repeated_spans(df, least_words=12).collect()
    assert sorted({tuple(r) for r in found}, key=repr) == sorted(set(_plain_spans(rows, 12)), key=repr) and found
    left = substring_dedup.deduplicated(df, least_words=12)
    assert left.columns == df.columns and left.count() == len(rows)


def test_rows_of_one_id_keep_their_own_bytes(spark):
    """Two texts under one id, and a copy without an id: the first occurrence stays whole, and cuts fall where the copies are."""
    rng = random.Random(5)
    passage, other = " ".join(_words(rng, 90)), " ".join(_words(rng, 90))
    texts = [passage + "\n" + other, other + "\n" + " ".join(_words(rng, 40))]
    df = spark.createDataFrame([(7, texts[0]), (7, texts[1]), (None, passage)], "_id long, _spans string")
    left = [r["_spans"] for r in substring_dedup.deduplicated(df, id_col="_id", text_col="_spans").collect()]
    whole = "\0".join(left)
    for part in (passage, other):
        assert whole.count(part) == 1 and whole.count(part[200:260]) == 1


def test_short_words(spark):
    """Passages of 51 words of one to three letters are found, and lines of 18 words are left alone."""
    rng = random.Random(9)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(1, 4))) for _ in range(n))
    line = words(18)
    rows = [(10_000 + k, words(150) + " " + line) for k in range(50)]
    for k in range(150):
        passage = words(51)
        for j in range(2):
            rows.append((2 * k + j, " ".join([words(70), passage, words(70)])))
    found = {s.doc_id // 2 for s in substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).where("removed").collect()}
    assert len(found & set(range(150))) >= 135 and not any(i >= 5_000 for i in found)


def test_passages_of_awkward_rows(spark):
    df = awkward(spark)
    spans = substring_dedup.repeated_spans(df).collect()
    assert {2, 10, 15} <= {s.doc_id for s in spans if s.removed}
    left = substring_dedup.deduplicated(df)
    assert left.columns == df.columns and left.count() == 20
    assert {r.doc_id: r.text for r in left.collect() if r.doc_id in (3, 4)} == {3: None, 4: ""}
    assert substring_dedup.deduplicated(df.limit(0)).count() == 0
