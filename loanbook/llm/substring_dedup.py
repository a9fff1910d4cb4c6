"""Passages that occur again anywhere, found by content-defined chunking with a gear rolling hash.

A cut lies where the gear hash of the last 16 bytes is smallest among `RADIUS` places on either
side. Cuts depend on nearby bytes only, so the same passage is cut alike wherever it stands, and
an insertion moves no cut beyond its neighbourhood. Chunks are about 28 bytes. Two
consecutive chunks are one unit, named by a 128-bit digest; a unit with a digest that occurs again
is repeated, and overlapping repeated units of a text join to spans. Only spans in which at least
`LEAST_WORDS` words begin count: shorter ones are stock phrases and license lines.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from loanbook.llm.shared import keep
from loanbook.llm.words import NOT_SPACE, blocks

RADIUS, LONGEST = 14, 4096
#: A span loses a chunk or so at either end of its passage, so passages of over 50 words are found.
LEAST_WORDS = 22
_GEAR = np.random.RandomState(7).randint(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)
_NONE = np.uint32(0xFFFFFFFF)


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of h[i : i + n] for each i; what lies beyond the end counts as the largest number."""
    width, out = 1, h
    while 2 * width <= n:
        out = np.minimum(out, np.append(out[width:], np.full(min(width, len(out)), _NONE)))
        width *= 2
    rest = n - width
    return np.minimum(out, np.append(out[rest:], np.full(min(rest, len(out)), _NONE))) if rest else out


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text; none lies inside a UTF-8 character."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    h = _GEAR[data]
    for width in (1, 2, 4, 8):
        h[width:] = h[width:] + (h[:-width] << np.uint32(width)) if n > width else h[width:]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    h[:-1][(data[1:] & 0xC0) == 0x80] = _NONE
    after = np.append(_least(h, RADIUS)[1:], _NONE)
    before = np.full(n, _NONE)
    reverse = _least(h[::-1], RADIUS)[::-1]
    before[1:] = reverse[:-1]
    ends = np.append(np.flatnonzero((h < before) & (h <= after) & (h < _NONE)) + 1, n)
    ends = np.unique(ends)
    long = np.flatnonzero(np.diff(ends, prepend=0) > LONGEST)
    if len(long):
        begins = np.append(0, ends[:-1])
        more = np.concatenate([np.arange(begins[k] + LONGEST, ends[k], LONGEST) for k in long])
        for _ in range(3):  # back to the begin of a character
            inside = (data[more] & 0xC0) == 0x80
            more = np.where(inside, more - 1, more)
        ends = np.unique(np.concatenate([ends, more]))
    return ends


def word_begins(data: np.ndarray) -> np.ndarray:
    """For each byte, and the end, the number of words that begin before it; white space is ASCII."""
    inside = NOT_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    return np.append(0, np.cumsum(begins))


def _units(batches):
    """(hi, lo, doc_id, text_hash, place, words, again): place is begin * 2**14 + length, words the same for words, again a repeat inside the text."""
    none = np.zeros(0, np.int64)
    for batch in batches:
        ids, hashes = batch.column(0), batch.column(1)
        for a, b, data, bounds in blocks(batch.column(2)):
            raw = data.tobytes()
            hi, lo, place, words, again, doc = [], [], [], [], [], []
            for d in range(b - a):
                own = data[bounds[d]:bounds[d + 1]]
                ends = cuts(own)
                if not len(ends):
                    continue
                begins = np.append(0, ends[:-1])
                last = np.append(ends[1:], ends[-1:])[:max(1, len(ends) - 1)]
                begins = begins[:len(last)]
                base, seen = int(bounds[d]), set()
                for x, y in zip(begins.tolist(), last.tolist()):
                    h = xxhash.xxh3_128_intdigest(raw[base + x:base + y])
                    hi.append((h >> 64) - (1 << 63))
                    lo.append((h & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
                    again.append(h in seen)
                    seen.add(h)
                before = word_begins(own)
                place.append(begins * (1 << 14) + last - begins)
                words.append(before[begins] * (1 << 14) + before[last] - before[begins])
                doc.append(np.full(len(last), a + d))
            rows = pa.array(np.concatenate([none, *doc]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), ids.take(rows), hashes.take(rows),
                 pa.array(np.concatenate([none, *place])), pa.array(np.concatenate([none, *words])), pa.array(again, pa.bool_())],
                ["hi", "lo", "doc_id", "text_hash", "place", "words", "again"])


def _spans(docs: DataFrame, least_words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, start, length, n_words, removed)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    kind = "hi long, lo long, doc_id long, text_hash long, place long, words long, again boolean"
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    # Digests are counted without their places first: most occur once and go no further.
    again = keep(source.mapInArrow(_units, kind).groupBy("hi", "lo")
                 .agg(F.count("*").alias("n"), F.min(order).alias("first")).where("n > 1")
                 .select("hi", "lo", F.col("first.doc_id").alias("i"), F.col("first.text_hash").alias("t")), "repeated")
    own_first = F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("t"))
    units = source.mapInArrow(_units, kind).join(again, ["hi", "lo"]).select(
        "doc_id", "text_hash", F.expr("shiftright(place, 14)").alias("start"), F.expr("shiftright(place, 14) + (place & 16383)").alias("end"),
        F.expr("shiftright(words, 14)").alias("word"), F.expr("shiftright(words, 14) + (words & 16383)").alias("word_end"),
        (~own_first | F.col("again")).alias("removed"))
    # One document's repeated units, in order: a unit that begins behind all before it begins a span.
    key = ["doc_id", "text_hash", "removed"]
    own = Window.partitionBy(*key).orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    spans = units.withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int"))
    spans = spans.withColumn("span", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return (spans.groupBy(*key, "span").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max("word_end") - F.min("word")).alias("n_words"))
        .where(F.col("n_words") >= least_words)
        .select("doc_id", "text_hash", "start", (F.col("end") - F.col("start")).alias("length"), "n_words", "removed"))


def repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, n_words, removed): spans of UTF-8 bytes of a text that occur again in the corpus.

    removed is false for the first occurrence, in the document with the smallest (id, text hash), and true for
    all others; spans of either kind do not overlap others of the kind. Null and empty texts have
    none; very long ones are cut like others, in chunks of at most LONGEST bytes. Rows of one id and text are one
    document, and other texts of that id are documents of their own. Documents without repeated spans give no rows; a null
    id is never first unless all are null. Other columns are not read.
    """
    return _spans(docs, least_words, id_col, text_col).drop("text_hash")


def deduplicated(docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of docs; text_col without its removed spans (a null text stays null).

    Spans belong to an id and a text, so rows of one id with other texts keep theirs. Columns of docs may have any names.
    """
    spans = (_spans(docs, least_words, id_col, text_col).where("removed").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_spans")))
    whole = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("hash"), F.struct(*docs.columns).alias("row"))
    joined = whole.join(keep(spans, "spans"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left")
    old = F.col("row")[text_col]
    raw = old.cast("binary")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(b"").alias("left"))
    cut = F.aggregate("_spans", start, lambda acc, s: F.struct(
        (s.start + s["length"]).alias("at"),
        F.concat(acc.left, F.substring(raw, (acc["at"] + 1).cast("int"), (s.start - acc["at"]).cast("int"))).alias("left")))
    tail = F.substring(raw, (cut["at"] + 1).cast("int"), F.octet_length(raw))
    text = F.when(F.col("_spans").isNull(), old).otherwise(F.concat(cut.left, tail).cast("string"))
    return joined.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
