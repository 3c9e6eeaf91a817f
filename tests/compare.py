"""Compare registered queries with their DuckDB counterparts."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from attestry.plans.registry import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if value != value else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else a short report."""
    columns = sorted(spark_df.columns)
    left = Counter(tuple(_plain(v) for v in row) for row in spark_df.select(*columns).collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != columns:
        return f"columns differ: {columns} / {sorted(names)}"
    order = [names.index(c) for c in columns]
    right = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    if left == right:
        return None
    return f"rows {sum(left.values())} / {sum(right.values())}; only here {list((left - right).items())[:2]}; only there {list((right - left).items())[:2]}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from attestry.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            sql = entry.oracle_sql().get(name)
            note = difference(df, con, sql) if sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            note = f"{type(error).__name__}: {str(error)[:600]}"
        bad = note is not None and not note.startswith("rows only")
        failed += bad
        print(f"{'BAD ' if bad else 'ok  '} {name} {time.time() - start:.1f}s {note or ''}", flush=True)
    print("failed", failed)
    spark.stop()
