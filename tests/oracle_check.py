"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, as sorted text; whole doubles and integers stay distinct."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, name: str) -> str | None:
    """None if a query's result and its SQL agree, else what differs."""
    got_rows = [tuple(row) for row in df.collect()]
    result = con.execute(oracle_sql()[name])
    want_columns = [d[0] for d in result.description]
    want_rows = result.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    got, want = canonical(df.columns, got_rows), canonical(want_columns, want_rows)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [pair for pair in zip(got, want, strict=True) if pair[0] != pair[1]]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from feedlake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        begun = time.time()
        try:
            verdict = differences(queries()[name](spark, sf_dir), con, name) or "ok"
        except Exception as exc:
            verdict = f"FAILED {type(exc).__name__}: {str(exc)[:600]}"
        print(f"{name:32s} {time.time() - begun:6.2f}s {verdict}", flush=True)
