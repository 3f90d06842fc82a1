"""Inspection queries over the finished layers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.operators.scd import current_rows


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, one (table_name, row_count) row each."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def fact_distinct_attributed(fact: DataFrame) -> DataFrame:
    """Distinct fact rows that have an employee, without the employee's key."""
    return fact.filter(F.col("employee_sk").isNotNull()).drop("employee_sk").distinct()


def employee_coverage(sales: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Distinct employee ids of the sales beside the current dimension's id, NULL if it has none.

    Ids are made distinct before the join, so each crosses the network once per
    map task at most. Joining the other dimensions could not change the
    answer: left joins on their keys neither drop nor alter a pair.
    """
    sold = sales.select(F.col("employee_id").alias("sales_employee_id")).distinct()
    known = current_rows(dim_employee).select(F.col("employee_id").alias("dim_employee_id")).distinct()
    return sold.join(known, F.col("sales_employee_id") == F.col("dim_employee_id"), "left").select(
        "dim_employee_id", "sales_employee_id"
    )


def raw_file_distinct(
    spark: SparkSession, path: str, position: int, rows: int | None = None
) -> DataFrame:
    """Distinct values of one column of a headerless CSV read, highest first.

    The file is queried in place, so columns go by position and a header line
    counts as data. ``rows`` limits the report after the sort.
    """
    column = f"_c{position}"
    report = (
        spark.sql(f"SELECT DISTINCT {column} FROM csv.`{path}`").orderBy(F.desc_nulls_last(column))
    )
    return report if rows is None else report.limit(rows)
