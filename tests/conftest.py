from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import session  # noqa: E402
from stratalake.schemas import struct  # noqa: E402
from stratalake.sources import Lakehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Many short jobs: compiling each method twice costs more than it saves.
    spark = session("tests", "4", "-XX:TieredStopAtLevel=1")
    # Nor does it pay to compile a plan for a few rows.
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """frame("id string, n int", (..), (..)) -> DataFrame"""

    def make(columns, *rows):
        return spark.createDataFrame(list(rows), struct(columns))

    return make


@pytest.fixture
def conf(spark):
    """Set Spark SQL options for one test."""
    before = {}

    def set_conf(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_conf
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path), prefix="t" + tmp_path.name.replace("-", "_"))


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df):
    """The physical plan chosen before execution."""
    return df._jdf.queryExecution().executedPlan().toString()
