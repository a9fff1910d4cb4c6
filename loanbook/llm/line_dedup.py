"""Removal of multi-line chunks that occur again anywhere in the corpus.

All of it is DataFrame expressions. A rolling hash runs over the lines of a text, two neighbouring lines with words at a time,
and its values choose the boundaries of chunks: one lies between two lines whose hash occurs only once in the corpus, or, in
one case of `RARITY`, has a certain form; and where neighbouring hashes occur unequally often, with the line
they share going to the more frequent one. All of this follows from nearby lines, so a passage is cut alike wherever it
stands, a passage of two lines as well as a long one, and an inserted line moves no distant boundary. Chunks of
two lines or more are grouped by their bytes; the first occurrence stays.
"""

from pyspark.sql import Column, DataFrame, functions as F

from loanbook.llm.shared import keep

#: One pair of lines in so many is a boundary whatever surrounds it (a power of two up to 128), so long repeats meet in parts.
RARITY = 32
_SPACES = " \t\n\u000b\f\r"


def _windows() -> Column:
    """Struct (i, h) for each line i (from 1) that has words as the next one does and is not cut off from it: the hash of both."""
    def window(line: Column, k: Column) -> Column:
        after = F.get("lines", k + 1)
        cut = F.substring(F.md5(F.concat_ws("\n", line, after)), 1, 2) < f"{256 // RARITY:02x}"
        worded = F.get("worded", k) & F.coalesce(F.get("worded", k + 1), F.lit(False))
        return F.when(worded, F.when(~cut, F.struct((k + 1).alias("i"), F.xxhash64(line, after).alias("h"))))

    return F.filter(F.transform("lines", window), lambda x: x.isNotNull())


def _chunks() -> Column:
    """Struct (begin, end) of the chunks of two lines or more, from `seen`: (i, n) of repeated windows in order."""
    def beside(k: Column, step: int, x: Column) -> tuple[Column, Column, Column]:
        other = F.get("seen", k + step)
        touches = F.coalesce(other.i == x.i + step, F.lit(False))
        return touches, touches & (other.n == x.n), touches & (other.n > x.n)

    def begin(x: Column, k: Column) -> Column:
        _, same, more = beside(k, -1, x)
        return F.when(~same, F.when(more, x.i + 1).otherwise(x.i))

    def end(x: Column, k: Column) -> Column:
        _, same, more = beside(k, 1, x)
        return F.when(~same, F.when(more, x.i).otherwise(x.i + 1))

    begins, ends = (F.filter(F.transform("seen", f), lambda x: x.isNotNull()) for f in (begin, end))
    return F.filter(F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("begin"), e.alias("end"))), lambda c: c.end > c.begin)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs as struct `row`, with its text after removal, n_lines and n_removed (lines).

    Of chunks with equal bytes the one in the smallest (id, text hash, first line)
    stays. Repeated rows of one id and text are one document and lose the same chunks. A null
    text stays null and has no lines; an empty one has one empty line. Rows with null id come
    first in the order of ids. Very long texts are cut like others; a text is held whole by its task. Columns of docs stay
    inside `row` and cannot clash.
    """
    key = [F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash")]
    lines = docs.select(*key, F.split(text_col, "\n").alias("lines")).withColumn(
        "worded", F.transform("lines", lambda x: F.length(F.translate(x, _SPACES, "")) > 0))
    windows = keep(lines.select("doc_id", "text_hash", F.explode(_windows()).alias("w")).select("doc_id", "text_hash", "w.i", "w.h"), "windows")
    again = windows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    cut = (windows.join(again, "h").groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("i", "n"))).alias("seen"))
           .select(F.col("doc_id").alias("i"), F.col("text_hash").alias("t"), _chunks().alias("chunks")).where("size(chunks) > 0"))

    def same(i: str, t: str) -> Column:
        return F.col("doc_id").eqNullSafe(F.col(i)) & (F.col("text_hash") == F.col(t))

    # Texts pass this join once, inside their rows. The list of chunks grows with the corpus: a merge join at every
    # size, no broadcast.
    whole = keep(docs.select(*key, F.struct(*docs.columns).alias("row")).join(keep(cut, "cut").hint("merge"), same("i", "t"), "left")
                 .drop("i", "t"), "whole")
    some = whole.where("chunks is not null")
    parts = some.select("doc_id", "text_hash", F.split(F.col("row")[text_col], "\n").alias("lines"), F.explode("chunks").alias("c")).select(
        "doc_id", "text_hash", "c", F.concat_ws("\n", F.slice("lines", F.col("c.begin"), F.col("c.end") - F.col("c.begin") + 1)).alias("chunk"))
    # Grouping by the text itself compares bytes; the digest only names the group afterwards.
    place = F.struct("doc_id", "text_hash", F.col("c.begin").alias("begin"))
    repeated = keep(parts.groupBy("chunk").agg(F.count("*").alias("n"), F.min(place).alias("first"))
                    .where("n > 1").select(F.sha2("chunk", 256).alias("digest"), "first"), "repeated")
    later = parts.select("doc_id", "text_hash", "c", F.sha2("chunk", 256).alias("digest")).join(repeated, "digest").where(
        ~place.eqNullSafe(F.col("first")))
    removed = keep(later.groupBy(F.col("doc_id").alias("i"), F.col("text_hash").alias("t")).agg(
        F.sort_array(F.collect_set("c")).alias("gone")), "removed")
    # Only texts that hold a chunk are dealt out again.
    marked = some.join(removed.hint("merge"), same("i", "t"), "left").select("row", "gone").unionByName(
        whole.where("chunks is null").select("row", F.lit(None).cast(removed.schema["gone"].dataType).alias("gone")))
    text = F.col("row")[text_col]
    marked = marked.withColumn("lines", F.split(text, "\n"))

    def before(g: Column, k: Column) -> Column:
        last = F.coalesce(F.get("gone", k - 1).end, F.lit(0))
        return F.slice("lines", last + 1, g.begin - last - 1)

    last = F.element_at("gone", -1).end
    left = F.concat_ws("\n", F.concat(F.flatten(F.transform("gone", before)), F.slice("lines", last + 1, F.size("lines"))))
    lost = F.aggregate("gone", F.lit(0), lambda a, g: a + g.end - g.begin + 1)
    return marked.select(
        "row", F.when(F.col("gone").isNull(), text).otherwise(left).alias("text"),
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_removed"))
