"""Run registry queries and their SQL side by side: `python -m verification.compare SF_DIR [key ...]`"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification import oracle, registry


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(names: list[str], rows: list) -> tuple[list[str], list[str]]:
    """Sorted column names and sorted rows in that column order."""
    order = sorted(range(len(names)), key=names.__getitem__)
    # Compared as text, so that NULL sorts with everything else.
    return [names[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


def differences(con: duckdb.DuckDBPyConnection, df: DataFrame, sql: str) -> tuple[int, str]:
    """Row count, and the first difference or an empty text."""
    expected = con.execute(sql)
    want_names, want = _rows([d[0] for d in expected.description], expected.fetchall())
    got_names, got = _rows(df.columns, [tuple(row) for row in df.collect()])
    if got_names != want_names:
        return len(got), f"columns {got_names} instead of {want_names}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows instead of {len(want)}"
    for ours, theirs in zip(got, want):
        if ours != theirs:
            return len(got), f"{ours}\n   instead of {theirs}"
    return len(got), ""


def main(spark: SparkSession, sf_dir: str, keys: list[str]) -> int:
    con, sql, failed = connect(sf_dir), oracle.statements(), 0
    for key in keys or registry.QUERIES:
        start = time.time()
        try:
            count, problem = differences(con, registry.QUERIES[key](spark, sf_dir), sql[key])
        except Exception as error:  # noqa: BLE001 - report and go on with the other keys
            count, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':5}{key:28}{count:8} rows {time.time() - start:6.2f}s")
        if problem:
            print("  ", problem)
    return failed


if __name__ == "__main__":
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    sys.exit(main(session, sys.argv[1], sys.argv[2:]))
