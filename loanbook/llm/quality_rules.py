"""Quality rules with thresholds that adapt to each language and source.

All of it is DataFrame expressions. Each text gives integer measures. For each measure, (lang,
source) has a quantile sketch: counts of log-linear buckets (exact below 128, within 1/64
above). Sketches merge by adding their counts, so a hot source is summed on the map side like
any other, and a group with few documents uses the merged sketch of its language, or of
everything. The thresholds are fences drawn from the quantiles of the sketch.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanbook.llm.shared import keep

WINDOW = 8
#: A group with fewer documents takes the merged sketch of its language, then that of all.
LEAST = 200
#: The fence lies so many spreads (third minus first quartile) above the third quartile.
SPREADS = 6
#: A spread counts as at least this much, for measures that hardly vary. Units: 1/10,000 of the
#: characters, lines or words; for word_length 1/100 character.
MEASURES = {"symbols": 50, "dup_lines": 500, "repeats": 400, "word_length": 100}


def _repeat_words(words: str) -> list[tuple[str, Column]]:
    """Columns to add one after another; the last is the number of words in windows met twice or more."""
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    windows = F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get("_hash", i + j) for j in range(WINDOW)])))
    # Windows are sorted by hash only where some hash is repeated; equal ones are then neighbours.
    ordered = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(empty)

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a.h == b.h) & (F.slice(words, a.i + 1, WINDOW) == F.slice(words, b.i + 1, WINDOW)), F.lit(False))

    twice = F.filter("_order", lambda x, k: same(x, F.get("_order", k - 1)) | same(x, F.get("_order", k + 1)))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        F.array_sort(F.transform("_twice", lambda x: x.i)), start,
        lambda acc, i: F.struct((acc.n + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")))
    return [("_hash", hashed), ("_windows", windows), ("_order", ordered), ("_twice", twice),
            ("n_repeat_words", covered["n"].cast("long"))]


def measured(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Struct `row` (the columns of docs named in carry, or all), n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words. Words are runs without white space; null counts as an empty text."""
    spaces = " \t\n\u000b\f\r"
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.struct(*(carry or docs.columns)).alias("row"), text.alias("_text"))
    df = df.withColumn("_words", F.array_remove(F.split("_text", "[\\x20\\x09-\\x0D]+"), ""))
    for name, value in _repeat_words("_words"):
        df = df.withColumn(name, value)
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, spaces, "")) > 0)
    df = df.withColumn("_lines", lines)
    return df.select(
        "row", F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", spaces, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words")


def _measures() -> dict[str, Column]:
    def ratio(a: str, b: str, unit: int) -> Column:
        return F.when(F.col(b) > 0, F.expr(f"({unit} * {a}) div {b}")).otherwise(F.lit(0).cast("long"))

    return {"symbols": ratio("n_symbols", "word_chars", 10_000), "dup_lines": ratio("n_dup_lines", "n_lines", 10_000),
            "repeats": ratio("n_repeat_words", "n_words", 10_000), "word_length": ratio("word_chars", "n_words", 100)}


def _bucket(x: Column) -> Column:
    """Lower edge of the bucket: all but the seven leading bits are cleared."""
    drop = F.greatest(F.lit(0), F.length(F.bin(x)) - 7)
    return F.call_function("shiftleft", F.call_function("shiftright", x, drop), drop)


def sketches(measures: DataFrame) -> DataFrame:
    """(level, lang, source, measure, bucket, n): sketches of each source, each language and of everything.

    measures has lang, source (null is a group of its own) and one long column for each measure.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), _bucket(F.col(m)).alias("bucket")) for m in MEASURES]))
    fine = (measures.select("lang", "source", pairs.alias("x")).groupBy("lang", "source", "x.measure", "x.bucket")
            .agg(F.count("*").alias("n")))
    fine = keep(fine, "sketch")
    lang = fine.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("n"))
    whole = lang.groupBy("measure", "bucket").agg(F.sum("n").alias("n"))
    none = F.lit(None).cast("string")
    return (fine.select(F.lit(0).alias("level"), "lang", "source", "measure", "bucket", "n")
            .unionAll(lang.select(F.lit(1), "lang", none.alias("source"), "measure", "bucket", "n"))
            .unionAll(whole.select(F.lit(2), none.alias("lang"), none.alias("source"), "measure", "bucket", "n")))


def thresholds(measures: DataFrame) -> DataFrame:
    """(lang, source, high_<measure>...): the fences of every group that occurs."""
    # The window holds one sketch: a few hundred buckets, whatever the number of documents.
    one = Window.partitionBy("level", "lang", "source", "measure")
    ranked = sketches(measures).select(
        "*", F.sum("n").over(one.orderBy("bucket")).alias("upto"), F.sum("n").over(one).alias("total"))
    fences = ranked.groupBy("level", "lang", "source", "measure").agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"))
    least = F.create_map(*[F.lit(x) for pair in MEASURES.items() for x in pair])[F.col("measure")]
    high = F.col("q3") + SPREADS * F.greatest(F.col("q3") - F.col("q1"), least)
    wide = keep(fences.withColumn("high", high).groupBy("level", "lang", "source").agg(
        F.max("total").alias("total"),
        *[F.max(F.when(F.col("measure") == m, F.col("high"))).alias(f"high_{m}") for m in MEASURES]), "fences")
    own, lang, whole = (wide.where(F.col("level") == k).alias(f"l{k}") for k in range(3))
    joined = own.join(lang, F.col("l0.lang").eqNullSafe(F.col("l1.lang"))).join(
        whole, F.col("l0.level") + 2 == F.col("l2.level"))
    return keep(joined.select("l0.lang", "l0.source", *[
        F.when(F.col("l0.total") >= LEAST, F.col(f"l0.high_{m}"))
        .when(F.col("l1.total") >= LEAST, F.col(f"l1.high_{m}")).otherwise(F.col(f"l2.high_{m}")).alias(f"high_{m}")
        for m in MEASURES]), "thresholds")


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
           carry: list[str] | None = None) -> DataFrame:
    """Every row of docs (the columns named in carry) with its counts and verdict.

    Columns: row, text_hash, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    base_failed (n_words < 20 or 100 * n_repeat_words > 30 * n_words), rejected_by (measures above
    their fence) and kept. Null and empty texts have zeros and fail the base rule. Null languages
    and sources are groups like others. Very long texts are measured whole, windows included. Rows of equal text, language and source get equal
    verdicts. An empty table gives no rows. Columns of docs stay inside `row` and cannot clash.
    """
    named = {"_lang": lang_col, "_source": source_col}
    df = docs.select(F.struct(*(carry or [])).alias("row") if carry else F.struct(F.lit(True).alias("any")).alias("row"),
                     *[F.col(c).alias(k) for k, c in named.items()], F.col(text_col).alias("_text"),
                     F.xxhash64(text_col).alias("text_hash"))
    counts = measured(df, "_text", ["row", "_lang", "_source", "text_hash"])
    counts = counts.select("row.*", *counts.columns[1:]).withColumnsRenamed({"_lang": "lang", "_source": "source"})
    counts = keep(counts.withColumns(_measures()), "measures")
    fences = thresholds(counts).withColumnsRenamed({"lang": "lang_", "source": "source_"})
    joined = counts.join(fences, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    over = F.filter(F.array(*[F.when(F.col(m) > F.col(f"high_{m}"), F.lit(m)) for m in MEASURES]), lambda x: x.isNotNull())
    return (joined.withColumn("base_failed", failed).withColumn("rejected_by", over)
            .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
            .select("row", "lang", "source", "text_hash", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                    "n_repeat_words", "base_failed", "rejected_by", "kept"))


def passing(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
            id_col: str = "doc_id") -> DataFrame:
    """The rows of docs, all columns, that the rules keep."""
    good = (judged(docs, text_col, lang_col, source_col, [id_col]).where("kept")
            .select(F.col(f"row.{id_col}").alias("i"), F.col("lang").alias("l"), F.col("source").alias("s"),
                    F.col("text_hash").alias("t")).distinct())
    same = (docs[id_col].eqNullSafe(good["i"]) & (F.xxhash64(docs[text_col]) == good["t"])
            & docs[lang_col].eqNullSafe(good["l"]) & docs[source_col].eqNullSafe(good["s"]))
    return docs.join(good, same, "left_semi")
