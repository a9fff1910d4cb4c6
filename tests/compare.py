"""Run registered queries against their SQL on DuckDB and report differences.

Usage: python tests/compare.py [sf_dir] [name-pattern ...]
"""

import os
import re
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(con, name, table):
    """Register a result with floats rounded and everything else as text."""
    con.register(f"{name}_raw", table)
    cols = []
    for f in sorted(table.schema, key=lambda f: f.name):
        c = f'"{f.name}"'
        if str(f.type) in ("double", "float"):
            cols.append(f"CASE WHEN isnan({c}) THEN NULL ELSE round({c}, 6) + 0.0 END::DOUBLE AS {c}")
        elif str(f.type).startswith("timestamp"):
            cols.append(f"CAST({c} AS TIMESTAMP)::VARCHAR AS {c}")
        else:
            cols.append(f"{c}::VARCHAR AS {c}")
    con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT {', '.join(cols)} FROM {name}_raw")


def compare(spark, con, sf_dir, fn, sql):
    """(message, ok) for one query: same columns and the same bag of rows."""
    df = fn(spark, sf_dir)
    got = df.toArrow()
    if sql is None:
        return f"rows-only {got.num_rows}", got.num_rows > 0
    want = con.execute(sql).to_arrow_table()
    a, b = sorted(got.column_names), sorted(want.column_names)
    if a != b:
        return f"columns differ: spark-only {set(a) - set(b)} sql-only {set(b) - set(a)}", False
    bad = [f"{f.name}:{f.type}" for t in (got, want) for f in t.schema
           if "decimal" in str(f.type)]
    if got.num_rows != want.num_rows:
        return f"rows differ: spark {got.num_rows} sql {want.num_rows}", False
    _plain(con, "got", got)
    _plain(con, "want", want)
    extra = con.execute("SELECT * FROM got EXCEPT ALL SELECT * FROM want").fetchall()
    if extra:
        missing = con.execute("SELECT * FROM want EXCEPT ALL SELECT * FROM got").fetchall()
        return (f"{len(extra)}/{got.num_rows} rows differ, cols {a} e.g. spark {sorted(map(str, extra))[0]}"
                f" sql {sorted(map(str, missing))[0]}"), False
    if bad:
        return f"types {bad}", False
    kinds = [f"{f.name} {f.type}/{want.schema.field(f.name).type}" for f in got.schema
             if str(f.type) != str(want.schema.field(f.name).type)
             and not {str(f.type), str(want.schema.field(f.name).type)} <= {"int32", "int64"}]
    return f"ok {got.num_rows}" + (" EMPTY" if not got.num_rows else "") + (f" kinds {kinds}" if kinds else ""), True


def main():
    import __spark_entry__ as entry
    from loanbook.session import session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = session("compare")
    con = connect(sf_dir)
    qs, sql = entry.queries(), entry.oracle_sql()
    failed = []
    for name, fn in qs.items():
        if args and not any(re.search(a, name) for a in args):
            continue
        t = time.time()
        try:
            msg, ok = compare(spark, con, sf_dir, fn, sql.get(name))
        except Exception as e:  # report and go on with the next query
            msg, ok = f"{type(e).__name__}: {str(e)[:700]}", False
        print(f"{'PASS' if ok else 'FAIL'} {name} {time.time() - t:.1f}s {msg}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed of {len(qs)}: {failed}")


if __name__ == "__main__":
    main()
