"""Rows with every awkward case, and SQL on frames."""

import duckdb

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, kept string, items string, "
          "n_words string, text_hash string, score string, digest string, length string")


def awkward(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, clashing column names."""
    prose = " ".join(f"word{i % 97} and{i % 13} more{i}" for i in range(60))
    copied = "\n".join(f"line {i} of a passage that is copied" for i in range(12))
    rows = [
        (1, prose, "en", "a"), (1, prose, "en", "a"), (2, prose, "en", "b"), (3, None, "en", "a"), (4, "", None, "a"),
        (5, "  \n\t ", "en", None), (None, prose + " x", None, None), (None, None, None, None), (6, "one two", "de", "c"),
        (7, "ONE\ttwo", "de", "c"), (8, "one", "de", "c"), (9, copied, "en", "a"), (10, "before\n" + copied + "\nafter", "en", "a"),
        (11, "é中文 " * 40 + "\x00 nul", "fr", "d"), (12, "long" * 30_000, "en", "a"),
        (13, " ".join(f"w{i % 5000}" for i in range(60_000)), "en", "a"), (14, "a " * 3000, "en", "a"),
        (15, "dup\n" * 50 + prose, "en", "a"), (-16, prose.upper(), "en", "a"), (2**40, "#$% " * 40, "en", "a"),
    ]
    wide = [(i, t, lang, s, None if t is None else len(t), *["clash"] * 8) for i, t, lang, s in rows]
    return spark.createDataFrame(wide, SCHEMA)


def sql(query, **frames):
    """Rows of a DuckDB query over Spark frames, sorted as text, and its columns."""
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toArrow())
    found = con.execute(query)
    names = sorted(c[0] for c in found.description)
    at = [[c[0] for c in found.description].index(n) for n in names]
    return names, sorted(repr([r[k] for k in at]) for r in found.fetchall())


def rows(df):
    names = sorted(df.columns)
    return names, sorted(repr(list(r)) for r in df.select(*names).collect())


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")
