"""Run queries and their SQL side by side and compare all values.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def session(name: str = "checks", cores: str = "8", jvm_options: str = "") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.extraJavaOptions", jvm_options)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, Decimal):
        return format(value, "f")
    return value


def _bag(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(name: str, result: DataFrame, connection: duckdb.DuckDBPyConnection) -> str | None:
    """None if rows, column names and values agree, else what differs."""
    cursor = connection.execute(ORACLE[name])
    expected_columns = [d[0] for d in cursor.description]
    expected = _bag(expected_columns, cursor.fetchall())
    got = _bag(result.columns, result.collect())
    if sorted(expected_columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} instead of {sorted(expected_columns)}"
    if got == expected:
        return None
    extra, missing = got - expected, expected - got
    return (
        f"{sum(got.values())} rows instead of {sum(expected.values())}; "
        f"extra {list(extra.items())[:2]}, missing {list(missing.items())[:2]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark, connection = session(), tables(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            result = QUERIES[name](spark, sf_dir)
            wrong = differences(name, result, connection)
        except Exception as error:  # noqa: BLE001 - shown, and the rest goes on
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += wrong is not None
        print(f"{'FAIL' if wrong else 'ok':5}{name:32}{time.time() - start:7.2f} s  {wrong or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
