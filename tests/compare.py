"""Compare registered queries with their SQL on one of the given data sets.

    python -m tests.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(row, order) -> tuple:
    return tuple(None if row[i] is None else str(row[i]) for i in order)


def spark_rows(df):
    names = sorted(df.columns)
    order = [df.columns.index(n) for n in names]
    return names, sorted((normal(r, order) for r in df.collect()), key=str)


def oracle_rows(con, sql):
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, sorted((normal(r, order) for r in found.fetchall()), key=str)


def difference(got, want) -> str | None:
    """What differs, or None."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    wrong = [(g, w) for g, w in zip(got[1], want[1], strict=True) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    import __spark_entry__ as e
    from postura.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), e.oracle_sql(), 0
    for name, build in e.queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            got = spark_rows(build(spark, sf_dir))
            took = time.time() - start
            problem = difference(got, oracle_rows(con, sql[name])) if name in sql else None
        except Exception as x:  # noqa: BLE001 - reported per query
            took, problem, got = time.time() - start, f"{type(x).__name__}: {str(x)[:600]}", (0, [])
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:45s} {len(got[1]):7d} rows {took:6.2f}s {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
