"""Compare every query with its SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    return _bag(names, result.fetchall())


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    return _bag(df.columns, [tuple(row) for row in df.collect()])


def _bag(names: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL; None when nothing does."""
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    other_names, other_rows = oracle_rows(sf_dir, ORACLE[name])
    if names != other_names:
        return f"columns {names} against {other_names}"
    if rows != other_rows:
        extra, lacking = rows - other_rows, other_rows - rows
        return (
            f"{extra.total()} rows too many, e.g. {next(iter(extra), None)}; "
            f"{lacking.total()} missing, e.g. {next(iter(lacking), None)}"
        )
    return None


def main(sf_dir: str = "/root/testdata/sf0.001", *names: str) -> int:
    from bench import session

    spark = session()
    failed = 0
    for name in names or QUERIES:
        start = time.perf_counter()
        wrong = difference(spark, sf_dir, name)
        failed += wrong is not None
        print(f"{name:32} {time.perf_counter() - start:6.2f}s  {wrong or 'equal'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
