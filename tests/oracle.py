"""Run registered queries beside their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain_value(v):
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((k, plain_value(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain_value(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v if v is None or isinstance(v, (bool, int, str)) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain_value(r[i]) for i in order)) for r in rows), sorted(columns)


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, name, fn, sql):
    """None when equal, else a description of the difference."""
    frame = fn(spark, folder)
    got, got_names = rows_of(frame.columns, frame.collect())
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want, want_names = rows_of(names, cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} against {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}; {[x for x in got if x not in set(want)][:2]} / {[x for x in want if x not in set(got)][:2]}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(want)} rows differ, first {wrong[0]}"
    return None if want else "no rows on either side"


def main() -> int:
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from peervane.session import build_session

    folder = sys.argv[1]
    chosen = sys.argv[2:]
    spark = build_session("oracle", "8", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if chosen and not any(c in name for c in chosen):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, fn, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.2f}s {'' if sqls.get(name) else '(rows only)'} {problem or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
