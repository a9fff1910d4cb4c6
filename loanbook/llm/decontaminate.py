"""Benchmark decontamination by a prefix-filtered set join.

A window is 13 consecutive words of a benchmark item, or all words of a shorter item. It is a
set of shingles (up to three words each) that a document must contain whole, so one shingle of
each window, its rarest in the corpus, is a sufficient prefix:

1. count how often each shingle of the windows occurs in all documents,
2. order the shingles of every window by rarity and keep the first, with its place in the window,
3. join document shingles with these prefix tokens; the place must leave room for the words
   before it and after it (positional and length bound),
4. compare word by word, first by hash, then by bytes.

The windows are the query side. They are dealt into blocks of bounded size; the documents pass
by one block after another, and nothing of the documents leaves the executors but counts.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanbook.llm.shared import keep
from loanbook.llm.words import ALNUM, Words, blocks, windows

SHINGLE = 3
#: (window, item) rows of a block; about 25 MB of index.
BLOCK_WINDOWS = 100_000
#: Candidate places compared at once.
CHUNK = 100_000


def _item_windows(size: int):
    def run(batches):
        for batch in batches:
            names, found = [], []
            for a, b, data, bounds in blocks(batch.column(1)):
                w = Words(data, bounds, ALNUM)
                for d in range(b - a):
                    lo, hi = w.first[d], w.first[d + 1]
                    own = {w.text(i, min(i + size, hi)) for i in range(lo, max(lo + 1, hi - size + 1))} if hi > lo else ()
                    name = batch.column(0)[a + d].as_py()
                    names += [name] * len(own)
                    found += list(own)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.binary())], ["item", "window"])
    return run


def _shingles(hashes: np.ndarray, first: np.ndarray, sizes) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each size: hashes and places of the shingles within texts."""
    out = {}
    for k in sizes:
        s, begin = windows(hashes, first, k)
        counts, number = np.diff(first), np.diff(begin)
        place = np.arange(len(s)) + np.repeat(first[:-1] - begin[:-1], number)
        whole = np.repeat(counts >= k, number)
        out[k] = (s[whole], place[whole])
    return out


class Index:
    """The windows of a block: word hashes, bytes, items, and after rank() one prefix token each."""

    def __init__(self, rows: list[tuple[bytes, str]]):
        by_window: dict[bytes, list[str]] = {}
        for window, item in rows:
            by_window.setdefault(window, []).append(item)
        self.text = list(by_window)
        self.items = list(by_window.values())
        texts = pa.array(self.text, pa.large_binary())
        parts = [Words(data, bounds, ALNUM, lower=False) for _, _, data, bounds in blocks(texts, 1 << 62)]
        hashes = parts[0].hash if parts else np.zeros(0, np.uint64)
        first = parts[0].first if parts else np.zeros(1, np.int64)
        self.length = np.diff(first)
        self.words = np.zeros((len(self.text), max(self.length, default=0)), np.uint64)
        shingles, owner, place = [], [], []
        for i in range(len(self.text)):
            self.words[i, :self.length[i]] = hashes[first[i]:first[i + 1]]
        self.sizes = sorted({min(SHINGLE, int(n)) for n in self.length})
        for k in self.sizes:
            rows_k = np.flatnonzero(np.minimum(SHINGLE, self.length) == k)
            s, at = _shingles(hashes, first, [k])[k]
            of = np.searchsorted(first, at, "right") - 1
            own = np.isin(of, rows_k)
            shingles.append(s[own])
            owner.append(of[own])
            place.append(at[own] - first[of[own]])
        none = np.zeros(0, np.int64)
        self.shingle = np.concatenate([none.astype(np.uint64), *shingles])
        self.owner, self.place = np.concatenate([none, *owner]), np.concatenate([none, *place])
        self.tokens = np.unique(self.shingle)

    def rank(self, counts: dict[int, int]) -> "Index":
        """Choose the rarest shingle of every window as its token, by counts of the corpus."""
        seen = np.array([counts.get(int(t), 0) for t in self.tokens], np.int64)
        rarity = seen[np.searchsorted(self.tokens, self.shingle)]
        order = np.lexsort((self.place, self.shingle, rarity, self.owner))
        first = order[np.unique(self.owner[order], return_index=True)[1]]
        first = first[np.argsort(self.shingle[first], kind="stable")]
        self.tokens, self.begin = np.unique(self.shingle[first], return_index=True)
        self.begin = np.append(self.begin, len(first))
        self.owner, self.place = self.owner[first], self.place[first]
        self.shingle = None
        return self

    def find(self, w: Words):
        """(document, first word, window) of all occurrences of windows in a block of texts."""
        for s, at in _shingles(w.hash, w.first, self.sizes).values():
            slot = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
            hit = np.flatnonzero(self.tokens[slot] == s)
            number = np.diff(self.begin)[slot[hit]]
            ends = np.cumsum(number)
            hi = 0
            while hi < len(hit):
                # Pairs of a hit and an entry are what takes memory: about CHUNK of them at once.
                lo, hi = hi, max(hi + 1, int(np.searchsorted(ends, (ends[hi - 1] if hi else 0) + CHUNK, "right")))
                n = number[lo:hi]
                step = np.arange(n.sum()) - np.repeat(ends[lo:hi] - n - (ends[lo - 1] if lo else 0), n)
                entry = np.repeat(self.begin[:-1][slot[hit[lo:hi]]], n) + step
                doc = np.repeat(np.searchsorted(w.first, at[hit[lo:hi]], "right") - 1, n)
                window = self.owner[entry]
                start = np.repeat(at[hit[lo:hi]], n) - self.place[entry]
                room = (start >= w.first[doc]) & (start + self.length[window] <= w.first[doc + 1])
                doc, window, start = doc[room], window[room], start[room]
                same = np.ones(len(doc), bool)
                for j in range(self.words.shape[1]):
                    word = w.hash[np.minimum(start + j, len(w.hash) - 1)]
                    same &= (j >= self.length[window]) | (word == self.words[window, j])
                for d, i, x in zip(doc[same].tolist(), start[same].tolist(), window[same].tolist()):
                    if w.text(i, i + int(self.length[x])) == self.text[x]:
                        yield d, i, x


def _count(index):
    def run(batches):
        tokens, sizes = index.value.tokens, index.value.sizes
        total = np.zeros(len(tokens), np.int64)
        for batch in batches:
            for _, _, data, bounds in blocks(batch.column(0)):
                w = Words(data, bounds, ALNUM)
                for s, _ in _shingles(w.hash, w.first, sizes).values():
                    slot = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    total += np.bincount(slot[tokens[slot] == s], minlength=len(tokens))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens[some].view(np.int64)), pa.array(total[some])], ["token", "n"])
    return run


def _scan(index):
    """Add the hits of a block: mask holds a byte per word of the text, items the names found."""
    def run(batches):
        for batch in batches:
            texts, rows = batch.column(0), batch.column(1)
            for a, b, data, bounds in blocks(texts):
                w = Words(data, bounds, ALNUM)
                counts = w.counts()
                change = np.zeros(len(w.hash) + 1, np.int64)
                items: dict[int, set] = {}
                for d, i, x in index.value.find(w):
                    change[i] += 1
                    change[i + int(index.value.length[x])] -= 1
                    items.setdefault(d, set()).update(index.value.items[x])
                covered = np.cumsum(change)[:-1] > 0
                masks, names = [], []
                for d in range(b - a):
                    own = covered[w.first[d]:w.first[d + 1]] if d in items else None
                    old, named = batch.column(2)[a + d].as_py(), batch.column(3)[a + d].as_py() or []
                    if old is not None:
                        before = np.frombuffer(old, bool)
                        own = before if own is None else own | before
                    masks.append(None if own is None else own.tobytes())
                    names.append(sorted({*named, *items.get(d, ())}))
                yield pa.RecordBatch.from_arrays(
                    [texts.slice(a, b - a), rows.slice(a, b - a), pa.array(masks, pa.binary()),
                     pa.array(names, pa.list_(pa.string())), pa.array(counts, pa.int64())],
                    ["text", "row", "mask", "items", "n_words"])
    return run


def _finish(batches):
    for batch in batches:
        hit, digest, spans = [], [], []
        for mask, names in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = np.frombuffer(mask or b"", np.int8)
            hit.append(int(own.sum()))
            digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]]))).tolist()
            spans.append([{"begin": x, "end": y} for x, y in zip(edges[::2], edges[1::2])])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(3), pa.array(hit, pa.int64()), batch.column(2), pa.array(spans, kind),
             pa.array(digest, pa.string())], ["row", "n_words", "n_hit", "items", "spans", "items_sha256"])


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20,
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  carry: list[str] | None = None, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Every row of docs, as struct `row`, with n_words, n_hit, items, spans, items_sha256, contaminated.

    `row` holds the columns named in carry, all of docs if none are named.

    Words are runs of digits, letters (A-Z lowered) and non-ASCII characters. n_hit counts the
    words inside any occurrence of a window, spans are their runs as word numbers [begin, end),
    items the names of the items with a window in the text, sorted as strings. contaminated:
    n_hit > 0 and share * n_hit >= n_words. Null and empty texts have no words and no hits; items
    without words have no window, repeated items count once, an item with null id is named
    'null'. Repeated rows stay. Very long texts are passed whole, with memory in proportion to their words. An empty benchmark hits nothing. Columns of docs cannot clash, since they
    stay inside `row`.
    """
    spark = docs.sparkSession
    pairs = keep(benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")), F.col(item_text))
                 .mapInArrow(_item_windows(size), "item string, window binary").distinct(), "windows")
    number = -(-pairs.count() // block_windows)
    row = F.struct(*(carry or docs.columns)).alias("row")
    kind = docs.select(row).schema["row"].dataType.simpleString()
    state = docs.select(F.col(text_col).alias("text"), row,
                        F.lit(None).cast("binary").alias("mask"), F.lit(None).cast("array<string>").alias("items"))
    for k in range(max(1, number)):
        rows = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(max(1, number))) == k).collect()
        if rows:
            index = Index([(bytes(r.window), r.item) for r in rows])
            counts = (state.select("text").mapInArrow(_count(spark.sparkContext.broadcast(index)), "token long, n long")
                      .groupBy("token").agg(F.sum("n").alias("n")).collect())
            ranked = index.rank({r.token & 0xFFFFFFFFFFFFFFFF: r.n for r in counts})
        else:
            ranked = Index([])
        scanned = state.select("text", "row", "mask", "items").mapInArrow(
            _scan(spark.sparkContext.broadcast(ranked)),
            f"text string, row {kind}, mask binary, items array<string>, n_words long")
        # Beyond one block the hits so far are written, so that one index is in memory at a time.
        state = keep(scanned, "scanned") if number > 1 else scanned
    done = state.select("row", "mask", "items", "n_words").mapInArrow(
        _finish, f"row {kind}, n_words long, n_hit long, items array<string>, "
                 "spans array<struct<begin:long,end:long>>, items_sha256 string")
    return done.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
