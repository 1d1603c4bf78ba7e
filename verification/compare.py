"""Run registered queries next to their oracle SQL: ``python -m verification.compare [sf] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification.oracle import ORACLE_SQL
from verification.registry import QUERIES

TESTDATA = Path("/root/testdata")


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float) and not math.isnan(value) and value == int(value):
        return int(value)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What sets the result of a query apart from that of its SQL; empty when they agree."""
    relation = con.sql(sql)
    types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    expected = _rows(list(relation.columns), relation.fetchall())
    actual = _rows(df.columns, df.collect())
    found = []
    if sorted(df.columns) != sorted(types):
        found.append(f"columns {sorted(df.columns)} != {sorted(types)}")
    names = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}
    for column, dtype in df.dtypes:
        if names.get(dtype, dtype.upper()) != types.get(column):
            found.append(f"type of {column}: {dtype} != {types.get(column)}")
    if len(actual) != len(expected):
        found.append(f"row count {len(actual)} != {len(expected)}")
    if actual != expected:
        extra = [a for a in actual if a not in set(expected)][:3]
        missing = [e for e in expected if e not in set(actual)][:3]
        found.append(f"values: extra {extra}, missing {missing}")
    return found


def main() -> int:
    sf, *wanted = sys.argv[1:] or ["0.01"]
    sf_dir = str(TESTDATA / f"sf{sf}")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in wanted or QUERIES:
        started = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        found = differences(df, con, ORACLE_SQL[name])
        failed += bool(found)
        print(f"{name:32} {time.perf_counter() - started:6.2f}s  {'; '.join(found) or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
