"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tablewright.catalog.queries import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if columns, types (by family) and all values agree exactly."""
    got_cols = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in got_cols]).collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != got_cols:
        return f"columns {got_cols} != {sorted(names)}"
    at = [names.index(c) for c in got_cols]
    want = Counter(tuple(r[i] for i in at) for r in cur.fetchall())
    got = Counter(map(tuple, rows))
    if got != want:
        return (
            f"{sum(got.values())} rows, {sum(want.values())} wanted; "
            f"only here {list((got - want))[:2]}; only there {list((want - got))[:2]}"
        )
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tablewright.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}, master="local[8]"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name, run in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            sql = oracle_sql().get(name)
            verdict = difference(df, con, sql) if sql else f"no SQL: {df.collect()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(verdict and not verdict.startswith("no SQL"))
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict or 'equal'}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
