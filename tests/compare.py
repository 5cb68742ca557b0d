"""Run catalogue queries next to their SQL in DuckDB and compare every value.

    python tests/compare.py [sf_dir] [query ...]
"""

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (0, "") if math.isnan(value) else (1, repr(value + 0.0))
    return (1, str(value) if not isinstance(value, bool) else repr(value))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(frame, con, sql):
    """None when equal, else a short description."""
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want = _rows(want_names, result.fetchall())
    got = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    if sorted(frame.columns) != sorted(want_names):
        return f"columns {sorted(frame.columns)} != {sorted(want_names)}"
    if got == want:
        return None
    missing, extra = sorted(set(want) - set(got))[:3], sorted(set(got) - set(want))[:3]
    return f"rows {len(got)} != {len(want)}\n  only SQL: {missing}\n  only Spark: {extra}"


def main():
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from triagelake.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls, bad = entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if args and name not in args:
            continue
        started = time.time()
        try:
            frame = build(spark, sf_dir)
            if name in sqls:
                message = difference(frame, con, sqls[name])
            else:
                message = None if frame.count() else "no rows"
            rows = con.execute(f"SELECT count(*) FROM ({sqls[name]})").fetchone()[0] if name in sqls else -1
        except Exception:
            message, rows = traceback.format_exc()[-1500:], -1
        print(f"{'ok ' if message is None else 'BAD'} {name} rows={rows} {time.time() - started:.2f}s", flush=True)
        if message is not None:
            print("  ", message)
            bad.append(name)
    print(len(bad), "bad:", bad)


if __name__ == "__main__":
    main()
