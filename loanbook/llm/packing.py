"""Packing of token sequences by the configuration linear program over the length histogram.

1. Texts become ids and pieces of at most `capacity` ids in one Arrow pass; each task numbers
   its pieces of each length, so global numbers need one small sum over tasks.
2. The histogram has at most `capacity` rows, whatever the corpus, and goes to the driver.
3. The linear program chooses how often each configuration (multiset of lengths that fit into a
   sequence) is used. Multiplicative weights price the lengths: a knapsack dynamic program finds the
   configurations of best price that fill a sequence, each is used by a step, and the prices of the lengths it covers
   fall. As every configuration is full, the total length is a dual bound that the program meets exactly. Steps are whole
   numbers of sequences. A fair part of each length, more of the short ones, is held back from the program and
   placed best fit, longest first, with what no full configuration holds any more.
4. The plan is, for each length, ranges of numbers with sequence and offset. Each piece looks
   its number up.
"""

import array
import bisect
import json
import os
import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from loanbook.llm.shared import keep

CAPACITY = 2048
#: Part of the scarcest length of a configuration that one step of the program uses.
STEP = 0.5
#: Fall of a price, as a power of e, for covering all pieces of a length.
RATE = 8
#: Configurations taken from one knapsack table: those of the lengths that lag most.
COLUMNS = 16
#: Part of each length that is held back, that of lengths under capacity / SHORT, and the part of the rest that the program covers.
HELD, HELD_SHORT, SHORT, COVERED = 0.04, 0.4, 16, 0.95
#: Parts of the program that rounding tries.
SCALES = (1, 0.5, 0.25, 0)
#: Knapsack tables in a row that give no usable configuration before the program ends.
MISSES = 8
#: Pieces that best fit places one by one; larger histograms are packed by parts.
AT_ONCE = 200_000
#: A longer run of white space is left to the tokenizer itself, whose pattern does not go down a stack.
LONG_RUN = 1_000


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level files write for each byte: printable ones as they are, the others from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


class Encoder:
    """Ids of texts by a tokenizer file.

    A byte-level file whose merges are in the order of their ids gives the same ids as its
    tokens by rank, which is several times as fast. Texts with the string of an added token or a very long run of
    white space, and files of any other form, go to the tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.ranked, self.added = None, set()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, before = file["model"], file["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
                 and not any(file[k] for k in ("truncation", "padding", "normalizer", "post_processor"))
                 and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")))
        if plain:
            letters, added = _byte_letters(), {t["content"] for t in file["added_tokens"]}
            merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
            # By rank and by merge agree if the merges make the ids after the 256 bytes one after another.
            if all(model["vocab"].get(m.replace(" ", "")) == 256 + k for k, m in enumerate(merges)):
                import public_tokenizers
                import tiktoken
                ranks = {bytes(letters[c] for c in token): k for token, k in model["vocab"].items() if token not in added}
                self.ranked = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
                self.added = added

    def _odd(self, text: str) -> bool:
        # A long run covers some whole block of half its length.
        step = LONG_RUN // 2
        return any(x in text for x in self.added) or any(text[k:k + step].isspace() for k in range(0, len(text) - step + 1, step))

    def ids(self, text: str) -> list[int]:
        if self.ranked is None or self._odd(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)


_encoders: dict[str, Encoder] = {}


def _pieces(path: str, capacity: int, end: int, with_ids: bool):
    def run(batches):
        encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        task = TaskContext.get().partitionId()
        numbers = np.zeros(capacity + 1, np.int64)
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            out = [[] for _ in range(7)]
            for row, text in enumerate(batch.column(1)):
                ids = array.array("I", encoder.ids(text.as_py() or ""))
                if sys.byteorder == "big":
                    ids.byteswap()
                ids = ids.tobytes() + tail
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    length = (n - 1) % capacity + 1 if piece == 0 else capacity
                    own = ids[4 * at:4 * (at + length)]
                    for column, x in zip(out, (row, piece, at, length, zlib.crc32(own), numbers[length], own if with_ids else None)):
                        column.append(x)
                    numbers[length] += 1
                    at, piece = at + length, piece + 1
            rows = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), pa.array(out[1], pa.int32()), *[pa.array(x, pa.int64()) for x in out[2:6]],
                 pa.array([task] * len(rows), pa.int32()), pa.array(out[6], pa.binary())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "number", "task", "ids"])
    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = 0, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, number, task, ids) as a written table.

    Every text, null as the empty one, gives its ids and then `end`. Only longer ones are cut;
    all pieces but the first are full. number counts the pieces of that length in the task.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return keep(docs.select(id_col, text_col).mapInArrow(
        _pieces(tokenizer, capacity, end, with_ids),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, number long, task int, ids binary"), "pieces")


def best_configuration(price: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack: how often each length is in the multiset of highest price that fits; price[l] <= 0 is left out."""
    lengths = np.flatnonzero(price > 0)
    value = price[lengths]
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    usable = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        k = usable[c]
        best[c] = best[c - 1]
        if k:
            gain = best[c - lengths[:k]] + value[:k]
            j = int(gain.argmax())
            if gain[j] > best[c]:
                best[c], taken[c] = gain[j], lengths[j]
    used = np.zeros(len(price), np.int64)
    c = capacity
    while c > 0:
        if taken[c]:
            used[taken[c]] += 1
            c -= taken[c]
        else:
            c -= 1
    return used


def _full(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each total up to capacity the best price of a multiset of exactly that total, and a length in it."""
    lengths = np.flatnonzero(price > 0)
    value = price[lengths]
    best = np.full(capacity + 1, -np.inf)
    best[0] = 0
    taken = np.zeros(capacity + 1, np.int64)
    usable = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        k = usable[c]
        if k:
            gain = best[c - lengths[:k]] + value[:k]
            j = int(gain.argmax())
            best[c], taken[c] = gain[j], lengths[j]
    return best, taken


def fractional(counts: np.ndarray, capacity: int, step: float = STEP, rounds: int | None = None):
    """[(full configuration, times)] within the histogram, by multiplicative weights; times are whole."""
    lengths = np.arange(len(counts))
    share = np.where(lengths * SHORT < capacity, 1 - HELD_SHORT, 1 - HELD)
    target = np.floor(counts * share).astype(np.int64)
    left, penalty = target.copy(), np.ones(len(counts))
    enough, placed, misses, plan, tables = COVERED * (target * lengths).sum() / capacity, 0, 0, [], 0
    while placed < enough and misses < MISSES and (rounds is None or tables < rounds):
        tables += 1
        lag = np.divide(left, target, out=np.zeros(len(counts)), where=target > 0)
        price = np.where(left > 0, lengths / capacity * np.exp(RATE * (lag - lag.max())) * penalty, 0)
        best, taken = _full(price, capacity)
        first = np.flatnonzero(left > 0)
        first = first[np.isfinite(best[capacity - first])]
        if not len(first):
            break
        misses += 1
        for length in first[np.lexsort((-first, -lag[first]))][:COLUMNS]:
            used = np.zeros(len(counts), np.int64)
            used[length] = 1
            rest = capacity - length
            while rest:
                used[taken[rest]] += 1
                rest -= taken[rest]
            own = np.flatnonzero(used)
            most = int((left[own] // used[own]).min())
            if not most:  # more of a length than is left
                penalty[own[used[own] > left[own]]] *= 0.5
                continue
            times = max(1, int(most * step))
            left[own] -= times * used[own]
            placed, misses = placed + times, 0
            plan.append((used, times))
    return plan


def dual_bound(counts: np.ndarray, price: np.ndarray, capacity: int) -> float:
    """Sequences that any plan needs: prices, scaled so that no configuration is worth more than 1, times counts."""
    used = best_configuration(price, capacity)
    return float((counts * price).sum() / (used * price).sum())


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Best fit, longest first, on a histogram: [(lengths of a sequence, number of such sequences)].

    A large histogram is divided, the part is packed, its sequences are repeated, and the
    remainder follows, so the work does not grow with the counts.
    """
    out: dict[tuple, int] = {}
    left = left.astype(np.int64, copy=True)
    while left.any():
        repeat = max(1, -(-int(left.sum()) // AT_ONCE))
        part = left // repeat
        if not part.any():
            repeat, part = 1, left
        rooms, bins = [], []
        for length in np.flatnonzero(part)[::-1].tolist():
            for _ in range(int(part[length])):
                k = bisect.bisect_left(rooms, (length, -1))
                if k < len(rooms):
                    room, b = rooms.pop(k)
                else:
                    room, b = capacity, len(bins)
                    bins.append([])
                bins[b].append(length)
                if room > length:
                    bisect.insort(rooms, (room - length, b))
        # Waste would be repeated too: the fuller half stays, the pieces of the rest go back.
        bins.sort(key=sum, reverse=True)
        for b in bins[:len(bins) // 2 + 1] if repeat > 1 else bins:
            out[tuple(b)] = out.get(tuple(b), 0) + repeat
            np.subtract.at(left, b, repeat)
    return [(list(k), n) for k, n in out.items()]


def _rounded(counts: np.ndarray, plan, capacity: int, scale: float) -> list[tuple[list[int], int]]:
    left = counts.astype(np.int64).copy()
    merged: dict[bytes, list] = {}
    for used, times in plan:
        merged.setdefault(used.tobytes(), [used, 0])[1] += times
    out = []
    for used, times in merged.values():
        own = np.flatnonzero(used)
        n = min(int(times * scale), int((left[own] // used[own]).min()))
        if n:
            left[own] -= n * used[own]
            out.append((np.repeat(own[::-1], used[own[::-1]]).tolist(), n))
    return out + best_fit(left, capacity)


def rounded(counts: np.ndarray, plan, capacity: int) -> list[tuple[list[int], int]]:
    """[(lengths of a sequence, longest first, number of such sequences)] that hold every piece once.

    Equal configurations are merged; the pieces left are placed best fit. Where short pieces are scarce the
    total length is a weak bound, and a program that spends them on full sequences leaves best fit a poor
    mix: then a part of the program is used, the largest of SCALES that gives the fewest sequences.
    The list does not grow with the counts: the program has a few tables of COLUMNS each for every halving of what is left, and best
    fit places at most about AT_ONCE pieces one by one for each halving.
    """
    tries = [_rounded(counts, plan, capacity, scale) for scale in SCALES]
    return min(tries, key=lambda x: sum(n for _, n in x))


def ranges(sequences) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first numbers, first sequences and offsets of its ranges."""
    found: dict[int, list] = {}
    at: dict[int, int] = {}
    base = 0
    for lengths, n in sequences:
        offset = 0
        for length in lengths:
            begin = at.get(length, 0)
            found.setdefault(length, []).append((begin, base, offset))
            at[length] = begin + n
            offset += length
        base += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in found.items()}


def _place(table):
    def run(batches):
        lookup = table.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length).tolist():
                own = np.flatnonzero(length == x)
                begin, base, off = lookup[x]
                k = np.searchsorted(begin, number[own], "right") - 1
                sequence[own] = base[k] + number[own] - begin[k]
                offset[own] = off[k]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])
    return run


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = 0, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces with their sequence_id and offset: (doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset).

    Sequences hold at most `capacity` ids, without gaps from offset 0. Null and empty texts are
    one piece of length 1; repeated rows are packed each; an id may be null. An empty table
    gives no rows. Other columns of docs are not read.
    """
    spark = docs.sparkSession
    cut = pieces(docs, tokenizer, capacity, end, id_col, text_col, with_ids)
    per_task = keep(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "numbers")
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row.length] = row.n
    full, counts[capacity] = int(counts[capacity]), 0
    sequences = rounded(counts, fractional(counts.astype(float), capacity), capacity)
    table = ranges([*sequences, ([capacity], full)])
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keep(per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    ranked = cut.join(offsets, ["length", "task"]).select(*columns, (F.col("number") + F.col("base")).alias("rank"))
    kinds = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in columns)
    return ranked.mapInArrow(_place(spark.sparkContext.broadcast(table)), f"{kinds}, sequence_id long, offset long")
