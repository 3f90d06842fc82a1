"""Queries over the smallest given tables against their SQL."""

import os

import pytest

from checks.compare import differences, tables
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")

# One per kind of operator; `python -m checks.compare` runs them all.
CHECKED = (
    "text_functions",
    "sales_amount",
    "clean_employee_history",
    "dedupe_latest_sales",
    "silver_product",
    "merge_upsert_evolved",
    "sales_upsert",
    "history_apply",
    "surrogate_keys",
    "scd1_product",
    "scd2_customer",
    "scd2_employee",
    "dim_date",
    "fact_sales",
    "ingest_rerun",
    "stream_upsert_events",
    "layers_end_to_end",
    "layers_late_correction",
    "silver_evolved_customers",
    "sales_upsert_late",
    "merge_upsert_sorted",
    "table_upsert_sales",
    "kept_sales",
    "rejected_rows",
)


@pytest.fixture(scope="module")
def duck():
    return tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, duck, name):
    assert differences(name, QUERIES[name](spark, SF_DIR), duck) is None


def test_every_rule_rejects_rows(spark):
    counts = dict(QUERIES["rejected_rows"](spark, SF_DIR).collect())
    for rule in ("silver sales", "fact lines", "customer keys"):
        assert 0 < counts[f"{rule}, kept"] < counts[f"{rule}, delivered"]
