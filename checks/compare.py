"""Run registered queries on Spark and their SQL twins on DuckDB and compare the results.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

from ledgerlens.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(f"{value:.12g}") + 0.0)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return repr(float(value))
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return str([_plain(v) for v in value])
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def run_sql(folder: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def differences(spark, folder: str, build, sql: str) -> str | None:
    """None when both results hold the same columns and rows."""
    df = build(spark, folder)
    got = rows_of(df.columns, df.collect())
    names, rows = run_sql(folder, sql)
    want = rows_of(names, rows)
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        cols = sorted(names)
        first = [(c, a, b) for c, a, b in zip(cols, *bad[0]) if a != b][:4]
        return f"{len(bad)} of {len(want)} rows differ, e.g. {first}"
    return None if want else "both results are empty"


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from checks.catalog import QUERIES, SQL

    folder = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    wanted = [a for a in argv if not a.startswith("/")] or list(QUERIES)
    spark = build_session("checks", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            if name in SQL:
                problem = differences(spark, folder, QUERIES[name], SQL[name])
            else:
                n = len(QUERIES[name](spark, folder).collect())
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001 - a report of every query is wanted
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        failed += problem is not None
        kind = "sql " if name in SQL else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} passed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
