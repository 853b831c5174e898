"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return value.normalize() + 0
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda n: names[n])
    return collections.Counter(tuple(_plain(r[n]) for n in order) for r in rows)


def compare(df, con, sql) -> tuple[str, int]:
    """('ok' or what differs, row count)."""
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(rows)
    mine, theirs = _bag(df.columns, rows), _bag(names, expected)
    if mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        return (
            f"{len(rows)} rows against {len(expected)}; columns {sorted(names)}; only here "
            f"{list(extra)[:2]}; only in SQL {list(missing)[:2]}",
            len(rows),
        )
    return "ok", len(rows)


def main() -> int:
    import __spark_entry__ as entry

    from millrace.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.001"
    spark = local_session("oracle", os.environ.get("BENCH_CPUS", "8"))
    if os.environ.get("ORACLE_TIMEZONE"):  # results must not depend on it
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TIMEZONE"])
    queries, oracles, con = entry.queries(), entry.oracle_sql(), connect(sf_dir)
    failed = 0
    for name in args or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            verdict, count = compare(df, con, oracles[name]) if name in oracles else ("rows only", df.count())
        except Exception as error:  # report and go on with the next query
            verdict, count = f"ERROR {type(error).__name__}: {str(error)[:600]}", -1
        bad = verdict not in ("ok", "rows only")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name:24s} {count:8d} rows {time.time() - start:6.2f}s {verdict if verdict != 'ok' else ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
