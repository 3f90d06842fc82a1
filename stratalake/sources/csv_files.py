"""Batch CSV reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv_batch(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """CSV files with a header row, from any file system Spark can reach.

    Without a schema all columns are text: nothing is inferred, so no extra
    pass runs over the files. A cell that does not fit its type reads as NULL.
    """
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).csv(path)
