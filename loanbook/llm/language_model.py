"""Language-model scores by deleted interpolation.

The probability of a token w after v mixes maximum-likelihood estimates,

    l2 * c(v w) / c(v) + l1 * c(w) / N + l0 / (V + 1),

with weights l that depend on how often the context v was seen (by powers of two). One tenth of
the training documents is left out of the counts; the weights maximise its likelihood, found by
expectation-maximisation. Scores then use the counts of all training documents.

Texts are not shuffled token by token. A task turns its texts into chunks: arrays of word codes
with the hashes of the chunk's own vocabulary. Each chunk asks for the counts of its distinct
words and word pairs; the questions, sorted by hash and dealt out by range, carry the chunk's
own counts, so one exchange both counts the corpus and learns who needs what, and a frequent
word costs one entry for each chunk. The answers go back to the chunks.
"""

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from loanbook.llm.shared import keep
from loanbook.llm.words import NOT_SPACE, Words, blocks, mix

#: Tokens of a chunk. A chunk asks each group once, so the rows grow with the chunks alone while the groups stay as many
#: as LEAST_GROUPS says (by level), which is up to GROUP_ENTRIES entries in a group on average, about 30 GB of text. For
#: larger corpora take larger chunks.
CHUNK_TOKENS = 500_000
LEAST_GROUPS = {1: 128, 2: 1024}
GROUP_ENTRIES = 8_000_000
#: Context buckets: never seen, 1, 2-3, 4-7, ... occurrences.
BUCKETS = 24
FOLDS, TEST_FOLD, TUNING = 7, 2, 10
_END, _START = np.uint64(0x656E64), np.uint64(0x7374617274)
_PAIR = np.uint64(0xD6E8FEB86659FD93)

TEST, COUNTED, TUNED = 0, 1, 2


def _pack(x: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(b, max_output_size=0) if b else b"", np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def part_of(doc_id) -> int:
    """TEST, COUNTED or TUNED, by the checksum of the id as text; a null id counts as empty text."""
    x = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    return TEST if x % FOLDS == TEST_FOLD else TUNED if x // FOLDS % TUNING == 0 else COUNTED


_CHUNK = ("chunk long, tuned boolean, n_tokens long, n_words long, n_pairs long, doc_ids array<long>, "
          "parts binary, lengths binary, vocabulary binary, codes binary")


def _chunks(batches):
    task, made = TaskContext.get().partitionId(), 0
    waiting = {True: [], False: []}

    def emit(tuned: bool):
        nonlocal made
        rows, waiting[tuned] = waiting[tuned], []
        if not rows:
            return
        ids, parts, hashes = zip(*rows)
        lengths = np.array([len(h) for h in hashes], np.uint32)
        words, codes = np.unique(np.concatenate(hashes), return_inverse=True)
        made += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([task << 32 | made], pa.int64()), pa.array([tuned]), pa.array([len(codes)], pa.int64()),
             pa.array([len(words)], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
             pa.array([ids], pa.list_(pa.int64())), pa.array([np.array(parts, np.uint8).tobytes()], pa.binary()),
             pa.array([_pack(lengths)], pa.binary()), pa.array([_pack(np.diff(words, prepend=np.uint64(0)))], pa.binary()),
             pa.array([_pack(codes.astype(np.uint32))], pa.binary())],
            ["chunk", "tuned", "n_tokens", "n_words", "n_pairs", "doc_ids", "parts", "lengths", "vocabulary", "codes"])

    sizes = {True: 0, False: 0}
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for a, b, data, bounds in blocks(batch.column(1)):
            w = Words(data, bounds, NOT_SPACE)
            for d in range(b - a):
                part = part_of(ids[a + d])
                hashes = np.append(w.hash[w.first[d]:w.first[d + 1]], _END)
                waiting[part == TUNED].append((ids[a + d], part, hashes))
                sizes[part == TUNED] += len(hashes)
                if sizes[part == TUNED] >= CHUNK_TOKENS:
                    yield from emit(part == TUNED)
                    sizes[part == TUNED] = 0
    for tuned in (True, False):
        yield from emit(tuned)


class _Chunk:
    """The arrays of a chunk: a code and a pair for each token, words and pairs sorted by hash."""

    def __init__(self, row: dict):
        self.ids = row["doc_ids"]
        self.words = np.cumsum(_unpack(row["vocabulary"], np.uint64), dtype=np.uint64)
        self.codes = _unpack(row["codes"], np.uint32).astype(np.int64)
        self.lengths = _unpack(row["lengths"], np.uint32).astype(np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.parts = np.frombuffer(row["parts"], np.uint8)
        self.part = np.repeat(self.parts, self.lengths)
        before = np.empty(len(self.codes), np.uint64)
        before[1:] = self.words[self.codes[:-1]]
        before[self.first] = _START
        self.pairs, self.pair = np.unique(mix(before * _PAIR + self.words[self.codes]), return_inverse=True)


def _ask(groups: dict[int, int]):
    """Questions of a chunk at both levels (1 words, 2 pairs), a row for each range of hashes."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = _Chunk(row)
                out = [[] for _ in range(6)]
                for level, kinds, of in ((1, c.words, c.codes), (2, c.pairs, c.pair)):
                    counted = np.bincount(of[c.part == COUNTED], minlength=len(kinds)).astype(np.uint32)
                    tuned = np.bincount(of[c.part == TUNED], minlength=len(kinds)).astype(np.uint32)
                    group = _group(kinds, groups[level])
                    cuts = np.searchsorted(group, np.arange(groups[level] + 1))
                    for g in range(groups[level]):
                        a, b = cuts[g], cuts[g + 1]
                        if a < b:
                            x = (level, g, row["chunk"], _pack(np.diff(kinds[a:b], prepend=np.uint64(0))),
                                 _pack(counted[a:b]), _pack(tuned[a:b]))
                            for column, y in zip(out, x):
                                column.append(y)
                types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)],
                                                 ["level", "part", "chunk", "hashes", "counted", "tuned"])
    return run


def _group(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


_ANSWER = "level int, part int, chunk long, counted binary, tuned binary, kinds long, all_kinds long, tokens long, all_tokens long"


def _answer(table: pa.Table) -> pa.Table:
    """Totals for each question of a group, and as chunk -1 the group's number of kinds and tokens."""
    hashes = [np.cumsum(_unpack(x, np.uint64), dtype=np.uint64) for x in table.column("hashes").to_pylist()]
    kinds, of = np.unique(np.concatenate(hashes), return_inverse=True)
    total = {}
    for name in ("counted", "tuned"):
        own = np.concatenate([_unpack(x, np.uint32) for x in table.column(name).to_pylist()])
        total[name] = np.bincount(of, weights=own, minlength=len(kinds)).astype(np.uint64)
    cuts = np.cumsum([0] + [len(h) for h in hashes])
    n = len(hashes)
    answers = {name: [_pack(total[name][of[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])] + [None] for name in total}
    both = total["counted"] + total["tuned"]
    numbers = [(total["counted"] > 0).sum(), (both > 0).sum(), total["counted"].sum(), both.sum()]
    first = [[x] * (n + 1) for x in (table.column("level")[0].as_py(), table.column("part")[0].as_py())]
    names = ["level", "part", "chunk", "counted", "tuned", "kinds", "all_kinds", "tokens", "all_tokens"]
    return pa.Table.from_arrays(
        [pa.array(first[0], pa.int32()), pa.array(first[1], pa.int32()),
         pa.array(table.column("chunk").to_pylist() + [-1], pa.int64()),
         pa.array(answers["counted"], pa.binary()), pa.array(answers["tuned"], pa.binary()),
         *[pa.array([None] * n + [int(x)], pa.int64()) for x in numbers]], names=names)


def _told(chunk: pa.Table, answers: pa.Table) -> tuple[_Chunk, dict, dict]:
    """A chunk with the totals of its words and pairs, by name."""
    c = _Chunk(chunk.to_pylist()[0])
    rows = sorted(answers.to_pylist(), key=lambda r: (r["level"], r["part"]))
    found = [{name: np.concatenate([_unpack(r[name], np.uint64) for r in rows if r["level"] == level]).astype(np.int64)
              for name in ("counted", "tuned")} for level in (1, 2)]
    return c, *found


def _context(c: _Chunk, words: np.ndarray) -> np.ndarray:
    """Occurrences of the word before each token; a text's begin occurs as often as its end."""
    end = words[np.searchsorted(c.words, _END)]
    seen = np.empty(len(c.codes), np.int64)
    seen[1:] = words[c.codes[:-1]]
    seen[c.first] = end
    return seen


def _bucket(seen: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.frexp(seen.astype(float))[1])


def _cells(tokens: int):
    """Left-out tokens counted by bucket and by the two estimates, these to quarters of a power of two."""
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        kind = [("bucket", pa.int32()), ("x2", pa.int32()), ("x1", pa.int32()), ("n", pa.int64()),
                ("p2", pa.float64()), ("p1", pa.float64())]
        if not chunk.num_rows:
            return pa.schema(kind).empty_table()
        c, words, pairs = _told(chunk, answers)
        seen = _context(c, words["counted"])
        p2 = pairs["counted"][c.pair] / np.maximum(seen, 1)
        p1 = words["counted"][c.codes] / max(1, tokens)
        code = [np.where(p > 0, np.round(-4 * np.log2(np.maximum(p, 1e-30))) + 1, 0).astype(np.int64) for p in (p2, p1)]
        cell, of = np.unique((_bucket(seen) * 1024 + code[0]) * 1024 + code[1], return_inverse=True)
        return pa.Table.from_arrays(
            [pa.array((cell >> 20).astype(np.int32)), pa.array((cell >> 10 & 1023).astype(np.int32)),
             pa.array((cell & 1023).astype(np.int32)), pa.array(np.bincount(of).astype(np.int64)),
             pa.array(np.bincount(of, weights=p2)), pa.array(np.bincount(of, weights=p1))], schema=pa.schema(kind))
    return run


def mixture(cells, kinds: int, rounds: int = 200) -> np.ndarray:
    """Weights (l2, l1, l0) of each bucket by expectation-maximisation.

    cells are (bucket, n, mean p2, mean p1). A bucket without tokens keeps equal weights; the
    one of unseen contexts has l2 = 0. No l0 is below 1e-6, so no token is impossible.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    bucket = np.array([x[0] for x in cells], np.int64)
    n = np.array([x[1] for x in cells], float)
    p = np.array([[x[2], x[3], 1 / (kinds + 1)] for x in cells], float).reshape(-1, 3)
    for _ in range(rounds if len(n) else 0):
        share = weights[bucket] * p
        share *= (n / share.sum(axis=1))[:, None]
        mass = np.stack([np.bincount(bucket, weights=share[:, k], minlength=BUCKETS) for k in range(3)], axis=1)
        some = mass.sum(axis=1) > 0
        new = weights.copy()
        new[some] = mass[some] / mass[some].sum(axis=1, keepdims=True)
        new[:, 2] = np.maximum(new[:, 2], 1e-6)
        new /= new.sum(axis=1, keepdims=True)
        done = np.abs(new - weights).max() < 1e-9
        weights = new
        if done:
            break
    return weights


def _scores(weights: np.ndarray, tokens: int, kinds: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        if not chunk.num_rows:
            return schema.empty_table()
        c, words, pairs = _told(chunk, answers)
        word = words["counted"] + words["tuned"]
        seen = _context(c, word)
        own = word[c.codes]
        mixed = weights[_bucket(seen)]
        p = (mixed[:, 0] * ((pairs["counted"] + pairs["tuned"])[c.pair] / np.maximum(seen, 1))
             + mixed[:, 1] * (own / max(1, tokens)) + mixed[:, 2] / (kinds + 1))
        base = np.log10((own + 1) / (tokens + kinds + 1))
        return pa.Table.from_arrays(
            [pa.array(c.ids, pa.int64()), pa.array(c.parts == TEST), pa.array(c.lengths),
             pa.array(np.add.reduceat((own > 0).astype(np.int64), c.first)), pa.array(np.full(len(c.lengths), tokens)),
             pa.array(np.add.reduceat(base, c.first)), pa.array(np.add.reduceat(np.log10(p), c.first))], schema=schema)
    return run


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs.

    Tokens are runs without white space, A-Z in lower case, then one end; null counts as an empty
    text. Rows whose crc32 of the id as text leaves 2 divided by 7 are held out; the model learns from
    all others. base_score is the add-one unigram log10 probability, score that of the mixture.
    Repeated rows count and are scored each. A very long text is never cut: its chunk grows by it. Without training rows every token has the uniform
    probability. Other columns are not read; an empty table gives no rows.
    """
    chunks = keep(docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_chunks, _CHUNK), "chunks")
    size = chunks.agg(F.sum("n_words"), F.sum("n_pairs")).first()
    groups = {level: max(least, -(-(size[level - 1] or 0) // GROUP_ENTRIES)) for level, least in LEAST_GROUPS.items()}
    asked = chunks.mapInArrow(_ask(groups), "level int, part int, chunk long, hashes binary, counted binary, tuned binary")
    answers = keep(asked.groupBy("level", "part").applyInArrow(_answer, _ANSWER), "answers")
    sums = answers.where("chunk = -1 and level = 1").agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("kinds", "all_kinds", "tokens", "all_tokens")]).first()
    replies = answers.where("chunk >= 0").select("level", "part", "chunk", "counted", "tuned")
    tuned = chunks.where("tuned")
    replies_tuned = replies.join(tuned.select("chunk"), "chunk", "left_semi")
    cells = (tuned.groupBy("chunk").cogroup(replies_tuned.groupBy("chunk"))
             .applyInArrow(_cells(sums[2]), "bucket int, x2 int, x1 int, n long, p2 double, p1 double")
             .groupBy("bucket", "x2", "x1").agg(F.sum("n").alias("n"), F.sum("p2").alias("p2"), F.sum("p1").alias("p1")))
    # The grid has a fixed number of cells, however many tokens fall into them.
    grid = [(r.bucket, r.n, r.p2 / r.n, r.p1 / r.n) for r in cells.collect()]
    weights = mixture(sorted(grid), sums[0])
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        _scores(weights, sums[3], sums[1]),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
