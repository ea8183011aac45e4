"""Compare the registered queries with their SQL: ``python -m checks.compare FOLDER [NAME...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from rollbook.session import build_session


def duckdb_over(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both results have the same columns and the same rows, in any order."""
    cursor = connection.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(set(df.columns) ^ set(expected_columns))}"
    names = sorted(df.columns)
    order = [expected_columns.index(n) for n in names]
    expected = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    actual = Counter(tuple(row) for row in df.select(*names).collect())
    if actual == expected:
        return ""
    missing, extra = list((expected - actual).items())[:2], list((actual - expected).items())[:2]
    return f"{expected.total()} rows expected, {actual.total()} found; {missing} / {extra}"


def main(folder: str, *only: str) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES

    spark = build_session(
        "compare",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__sql__session__timeZone="UTC",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    connection = duckdb_over(folder)
    failed = 0
    for name, build in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        if name in ORACLE:
            problem = difference(build(spark, folder), connection, ORACLE[name])
        else:
            problem = f"rows only: {build(spark, folder).count()}"
        failed += bool(problem) and name in ORACLE
        print(f"{name:36} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
