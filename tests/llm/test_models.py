"""Classifier, language model and packing: held-out accuracy, plain loops, exact round trips."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from common import SF, awkward, documents
from tokenizers import Tokenizer

from loanbook.llm import language_model, packing, preference, warc
from pyspark.sql import functions as F

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = preference.ranked(documents(spark, sf), labels)
    held = found.join(labels, "doc_id").where("held_out").toPandas()
    assert len(held) > 60 and (held.predicted == held.quality).mean() > 0.97
    assert ((found.toPandas().score >= 0.3) == (found.toPandas().predicted == 1)).all()


def test_classifier_of_awkward_rows(spark):
    df = awkward(spark)
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (9, 1), (14, 0), (2**40, 0), (8, 0), (None, 1), (3, None), (1, 1), (99, 0)], "doc_id long, quality int")
    found = preference.ranked(df, labels).collect()
    assert len(found) == 20 and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert {r.score for r in preference.ranked(df, labels.limit(0)).collect()} == {0.5}
    assert preference.ranked(df.limit(0), labels).count() == 0


def _plain_features(text):
    raw = (text or "").encode()
    out = [sum(c in own for c in raw) / max(1, len(raw)) for own in preference._CLASSES.values()]
    out.append(sum(c >= 0x80 for c in raw) / max(1, len(raw)))
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    n = max(1, len(words))
    out += [sum(map(len, words)) / n, sum(len(w) <= 3 for w in words) / n, sum(len(w) >= 10 for w in words) / n]
    words = [bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in w) for w in words]
    out.append(sum(a == b for a, b in zip(words, words[1:])) / n)
    for run in (1, 3, 8):
        own = [tuple(words[k:k + run]) for k in range(len(words) - run + 1)] or ([tuple(words)] if words else [])
        kinds = len(set(own))
        out.append(0 if not own else math.log1p(kinds) / math.log1p(len(own)) if run == 1 else 1 - kinds / len(own))
    return [*out, math.log1p(len(words))]


def test_features_equal_a_plain_version(spark):
    texts = [r.text for r in [*documents(spark).where("length(text) < 4000").limit(80).collect(), *awkward(spark).where("length(text) < 20000 or text is null").collect()]]
    data = [(t or "").encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    got = preference.features(np.frombuffer(b"".join(data), np.uint8), bounds)
    assert np.allclose(got, [_plain_features(t) for t in texts], atol=1e-12)


def test_ranking_equals_a_plain_fit():
    """The same pairs, by small gradient steps; the threshold by trying every gap between two worths."""
    rng = np.random.RandomState(6)
    good = rng.rand(160) < 0.4
    rows = rng.randn(160, len(preference.NAMES)) + good[:, None] * rng.rand(len(preference.NAMES)) * 0.6
    ranking = preference.Ranking(rows, good)
    z = np.clip((rows - rows.mean(axis=0)) / (rows.std(axis=0) + 1e-6), -6, 6)
    x = np.hstack([z, np.maximum(0, z - 0.5), np.maximum(0, z - 2), np.maximum(0, -z - 1)])
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    random_ = np.random.RandomState(5)
    n = min(preference.PAIRS, len(better) * len(worse))
    first = random_.choice(better, n)
    gap = x[first] - x[np.resize(random_.permutation(worse), n)]
    rate = 1 / (np.linalg.norm(gap, 2) ** 2 / 4 + preference.PENALTY)
    weights = ahead = np.zeros(x.shape[1])
    for k in range(20_000):
        slope = gap.T @ (1 / (1 + np.exp(gap @ ahead))) - preference.PENALTY * ahead
        before, weights = weights, ahead + rate * slope
        ahead = weights + k / (k + 3) * (weights - before)
        if np.abs(slope).max() < 1e-7:
            break
    assert np.abs(weights - ranking.weights).max() < 1e-3
    worth = sorted(x @ weights)
    value = x @ weights
    tries = [((good & (value > c)).sum() / good.sum() + (~good & (value <= c)).sum() / (~good).sum()) for c in [(a + b) / 2 for a, b in zip(worth, worth[1:])]]
    reached = (good & (value > ranking.cut)).sum() / good.sum() + (~good & (value <= ranking.cut)).sum() / (~good).sum()
    assert math.isclose(reached, max(tries), abs_tol=1e-9)
    plain = 1 / (1 + np.exp(-(value - ranking.cut + math.log(0.3 / 0.7))))
    assert np.abs(plain - ranking.scores(rows)).max() < 1e-2
    assert ((ranking.scores(rows) >= 0.3) == (value >= ranking.cut)).all()


def _tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w] + ["\uffff"]


@pytest.mark.parametrize("kind", ["documents", "awkward"])
def test_language_model(spark, monkeypatch, kind):
    """Counts are exact; scores agree with a plain model whose weights are learnt without a grid."""
    monkeypatch.setattr(language_model, "CHUNK_TOKENS", 700)
    monkeypatch.setattr(language_model, "GROUP_ENTRIES", 900)
    df = documents(spark).repartition(3) if kind == "documents" else awkward(spark)
    texts = [(r.doc_id, _tokens(r.text), language_model.part_of(r.doc_id)) for r in df.collect()]
    found = collections.defaultdict(list)
    for r in language_model.scored(df).collect():
        found[r.doc_id].append(r)
    assert sum(map(len, found.values())) == len(texts)

    def model(parts):
        words, pairs = collections.Counter(), collections.Counter()
        for _, t, part in texts:
            if part in parts:
                words.update(t)
                pairs.update(zip(["\1", *t], t))
        return words, pairs, sum(words.values()), len(words)

    def estimates(m, a, b):
        words, pairs, total, kinds = m
        seen = words["\uffff"] if a == "\1" else words[a]
        return seen, [pairs[a, b] / max(1, seen), words[b] / max(1, total), 1 / (kinds + 1)]

    def bucket(seen):
        return min(language_model.BUCKETS - 1, seen.bit_length())

    few = model({language_model.COUNTED})
    left_out = [estimates(few, a, b) for _, t, part in texts if part == language_model.TUNED for a, b in zip(["\1", *t], t)]
    weights = language_model.mixture([(bucket(s), 1, p[0], p[1]) for s, p in left_out], few[3])
    full = model({language_model.COUNTED, language_model.TUNED})
    for i, t, part in texts:
        r = found[i].pop(next(k for k, x in enumerate(found[i]) if x.n_tokens == len(t)))
        assert r.held_out == (part == language_model.TEST) and r.n_tokens == len(t) and r.train_tokens == full[2]
        assert r.n_known == sum(full[0][w] > 0 for w in t)
        assert math.isclose(r.base_score, sum(math.log10((full[0][w] + 1) / (full[2] + full[3] + 1)) for w in t), rel_tol=1e-9)
        score = sum(math.log10(np.dot(weights[bucket(s)], p)) for s, p in (estimates(full, a, b) for a, b in zip(["\1", *t], t)))
        assert math.isclose(r.score, score, rel_tol=0.01)
    assert language_model.scored(df.limit(0)).count() == 0


def test_mixture_is_a_maximum():
    rng = np.random.RandomState(0)
    cells = [(3, 1, a, b) for a, b in zip(rng.rand(400) ** 3, rng.rand(400) * 0.1)]

    def likelihood(w):
        return sum(math.log(w[0] * a + w[1] * b + w[2] / 51) for _, _, a, b in cells)

    weights = language_model.mixture(cells, 50)[3]
    assert math.isclose(weights.sum(), 1)
    for _ in range(200):
        other = np.abs(weights + rng.randn(3) * 0.02) + 1e-6
        assert likelihood(other / other.sum()) <= likelihood(weights) + 1e-3


def test_encoder_equals_the_tokenizer():
    rng = random.Random(1)
    parts = ["a", " ", "  ", "\n", " \n", "\t", "'s", "é", "12", "!", "\0", "<|endoftext|>", "中", "\r\n", "\x1c", "\x85", ",", ".", ", ", ". ", "　", "\xa0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(5000)]
    plain = Tokenizer.from_file(BPE)
    encoder = packing.Encoder(BPE)
    assert encoder.ranked is not None
    texts += [" " * 50_000 + "x", "\n" * 1_500, "ab " * 20_000, "a" * 100_000, "<|endoftext|>" * 3]
    assert [encoder.ids(t) for t in texts] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_encoder_takes_every_character_for_the_same_kind():
    """Each character between letters, digits, signs and blanks, and twice: its kind decides where texts are cut."""
    plain, encoder = Tokenizer.from_file(BPE), packing.Encoder(BPE)
    texts = ["".join(f"a{chr(c)}a 1{chr(c)}1 .{chr(c)}. {chr(c)}{chr(c)} " for c in range(k, k + 64) if not 0xD800 <= c < 0xE000)
             for k in range(0, 0x110000, 64)]
    assert [encoder.ids(t) for t in texts] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_every_token_is_the_encoding_of_itself():
    """Merging by rank and by the listed pairs can only differ in a token that the pairs do not build."""
    plain, encoder = Tokenizer.from_file(BPE), packing.Encoder(BPE)
    whole = 0
    for raw in encoder.ranked.token_byte_values():
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        got = encoder.ids(text)
        assert got == plain.encode(text, add_special_tokens=False).ids
        whole += len(got) == 1
    assert whole > 49_000


def test_encoder_without_ranks():
    """A file of another form goes to its tokenizer."""
    other = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.ranked is None
    assert other.ids("Hello there") == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("Hello there", add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["documents", "awkward"])
def test_packing(spark, kind):
    df = documents(spark).repartition(3) if kind == "documents" else awkward(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = packing.packed(df, BPE, with_ids=True).toPandas()
    plain, total = Tokenizer.from_file(BPE), 0
    by = dict(list(got.groupby("doc_id")))
    for r in df.collect():
        ids = np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        own = by[r.doc_id].sort_values("piece")
        assert b"".join(map(bytes, own.ids)) == ids.tobytes()
        assert own.piece.tolist() == list(range(len(own))) and own.start.tolist() == (own.length.cumsum() - own.length).tolist()
        assert (own.length.iloc[1:] == 2048).all() and (len(own) == 1 or len(ids) > 2048)
        assert [zlib.crc32(bytes(x)) for x in own.ids] == own.ids_crc32.tolist()
        total += len(ids)
    placed = got.sort_values(["sequence_id", "offset"])
    ends = (placed.offset + placed.length).groupby(placed.sequence_id).shift().fillna(0)
    assert (ends == placed.offset).all() and (placed.groupby("sequence_id").length.sum() <= 2048).all()
    assert got.sequence_id.nunique() <= -(-total // 2048) + 3
    assert packing.packed(df.limit(0), BPE).count() == 0


def test_packing_of_repeated_rows(spark):
    df = awkward(spark)
    assert packing.packed(df, BPE).where("piece = 0").count() == 20


@pytest.mark.parametrize("times", [1, 1000])
def test_plan_holds_every_piece(times):
    rng = np.random.RandomState(2)
    counts = np.bincount(rng.randint(1, 300, 400), minlength=401) * times
    plan = packing.rounded(counts, packing.fractional(counts.astype(float), 400, rounds=150), 400)
    held = np.zeros(401, np.int64)
    for lengths, n in plan:
        assert sum(lengths) <= 400 and lengths == sorted(lengths, reverse=True) and n > 0
        np.add.at(held, lengths, n)
    assert (held == counts).all()
    assert sum(n for _, n in plan) <= 1.01 * sum(n for _, n in packing.best_fit(counts, 400)) + 1


def _lengths(spark, times):
    """Histogram of the pieces of the documents, so many times; pieces of full length go alone."""
    counts = np.zeros(packing.CAPACITY + 1, np.int64)
    encoder = packing.Encoder(BPE)
    for r in documents(spark, "/root/testdata/sf0.1").select("text").collect():
        counts[len(encoder.ids(r.text or "")) % packing.CAPACITY + 1] += times
    counts[packing.CAPACITY] = 0
    return counts


def test_program_places_nearly_all_pieces(spark):
    """At 25 times the lengths of sf0.1: the gap between plan and dual bound, what the program places, and best fit alone."""
    counts, size = _lengths(spark, 25), packing.CAPACITY
    plan = packing.fractional(counts, size)
    by_program = sum((used * times for used, times in plan), np.zeros(size + 1, np.int64))
    assert (by_program <= counts).all() and all((used * np.arange(size + 1)).sum() == size for used, _ in plan)
    assert by_program.sum() >= 0.9 * counts.sum()
    sequences = packing.rounded(counts, plan, size)
    n = sum(n for _, n in sequences)
    bound = packing.dual_bound(counts, np.arange(size + 1) / size, size)
    assert bound <= n <= 1.0002 * bound + 1
    assert n <= sum(n for _, n in packing.best_fit(counts, size))
    assert sum(len(lengths) for lengths, _ in sequences) < 400_000


@pytest.mark.parametrize("lengths", [[700] * 50, [2047] * 9, [1] * 5000, [1025] * 4 + [1023] * 4, []])
def test_plan_of_few_lengths(lengths):
    counts = np.bincount(lengths, minlength=2049)[:2049]
    sequences = packing.rounded(counts, packing.fractional(counts, 2048), 2048)
    assert sum(n for _, n in sequences) == sum(n for _, n in packing.best_fit(counts, 2048))
    held = np.zeros(2049, np.int64)
    for own, n in sequences:
        np.add.at(held, own, n)
    assert (held == counts).all()


def test_knapsack_is_best():
    rng = np.random.RandomState(4)
    price = np.where(rng.rand(31) < 0.3, 0, rng.rand(31))
    price[0] = 0
    used = packing.best_configuration(price, 30)
    best = [0.0] * 31
    for c in range(1, 31):
        best[c] = max([best[c - 1]] + [best[c - k] + price[k] for k in range(1, c + 1) if price[k] > 0])
    assert (used * np.arange(31)).sum() <= 30 and math.isclose((used * price).sum(), best[30])


def test_broken_archives(spark, tmp_path):
    good = warc.record(5, "http://x", b"payload" * 30, __import__("hashlib").sha256(b"payload" * 30).hexdigest(), None, False, "2024-01-01T00:00:00Z")
    import zstandard
    frame = zstandard.ZstdCompressor(write_checksum=True).compress
    cases = {
        "part-1": frame(good) + frame(good.replace(b"payloadpay", b"payloadPAY", 1)) + frame(good),
        "part-2": frame(good) + b"rubbish that is no frame", "part-3": frame(good)[:-9],
        "part-4": frame(good.replace(b"WARC/1.1", b"WORC/1.1")) + frame(good + b"x"),
        "part-5": frame(good.replace(b"WARC-Date: ", b"Date: ")), "part-6": b""}
    for name, data in cases.items():
        (tmp_path / name).write_bytes(data)
    got = warc.read_archives(spark, f"file://{tmp_path}").collect()
    assert sum(r.problem is None and r.page_id == 5 for r in got) == 3
    assert sum(r.problem is not None for r in got) == 6


def test_dictionary_is_used(spark, tmp_path):
    pages = spark.range(600).selectExpr("id AS page_id", "'u' AS url", "concat(repeat('<div class=\"x\">', 20), id, sha2(cast(cast(id AS string) AS binary), 256)) AS html").coalesce(1)
    warc.write_archives(pages, f"file://{tmp_path}/a")
    [file] = (tmp_path / "a").glob("part-*")
    first, *rest = warc.frames(file.read_bytes())
    assert first[0] == warc.DICTIONARY_MAGIC and sum(m == warc.ZSTD_MAGIC for m, _ in rest) == 600
    assert warc.read_archives(spark, f"file://{tmp_path}/a").where("problem is null and length(payload) > 300").count() == 600
