from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan, rows

from stratalake.operators import (
    dim_date,
    employee_coverage,
    fact_distinct_attributed,
    fact_sales,
    layer_counts,
)
from stratalake.schemas import GOLD, SILVER

TS = datetime(2024, 1, 5, 18)
LOAD = datetime(2024, 6, 1)


@pytest.fixture
def sales(spark):
    def line(sale_id, quantity=2, price=10.0, customer="c1", product="p1", ts=TS, employee="e1"):
        return (sale_id, ts, customer, product, "s1", employee, quantity, price, "x", 5.0, "online", "f", TS)

    return lambda *lines: spark.createDataFrame([line(**kw) for kw in lines], SILVER["sales_clean"])


@pytest.fixture
def dims(spark, frame):
    """Date, customer, employee, product and store dimension."""
    customer = frame("customer_sk bigint, customer_id string, is_current boolean", (1, "c1", False), (2, "c1", True), (3, "c9", None))
    employee = frame("employee_sk string, employee_id string, is_current boolean", ("k", "e1", True), ("o", "e2", False))
    product = frame("product_sk bigint, product_id string", (7, "p1"))
    store = frame("store_sk bigint, store_id string", (8, "s1"))
    return dim_date(spark, "2024-01-01", "2024-01-31"), customer, employee, product, store


def test_line_takes_current_versions(sales, dims):
    got = fact_sales(sales({"sale_id": "1"}), *dims, LOAD)
    assert [c for c, _ in got.dtypes] == [c.split()[0] for c in GOLD["fact_sales"].split(", ")]
    values = [str(v) for v in got.first()]
    assert values == [
        "1", "20240105", "2", "k", "7", "8", "2", "10.00", "1.00", "20.00", "19.00", str(LOAD),
    ]


def test_types_match_the_table(sales, dims):
    got = fact_sales(sales({"sale_id": "1"}), *dims, LOAD)
    assert ", ".join(f"{c} {t}" for c, t in got.dtypes) == GOLD["fact_sales"]


def test_unmatched_lines_stay_with_null_keys(sales, dims):
    lines = sales(
        {"sale_id": "1", "customer": "c9", "employee": "e2", "product": "p2", "ts": datetime(2030, 1, 1)},
        {"sale_id": "2", "customer": None, "employee": None, "product": None},
    )
    got = fact_sales(lines, *dims, LOAD)
    keys = ["date_sk", "customer_sk", "employee_sk", "product_sk", "store_sk"]
    assert rows(got, *keys) == [(20240105, None, None, None, 8), (None, None, None, None, 8)]


def test_fact_allows_zero_quantity_but_no_missing_or_negative_values(sales, dims):
    lines = sales(
        {"sale_id": "1", "quantity": 0},
        {"sale_id": None},
        {"sale_id": "2", "quantity": None},
        {"sale_id": "3", "price": None},
        {"sale_id": "4", "price": -1.0},
        {"sale_id": "5", "quantity": -1},
    )
    assert rows(fact_sales(lines, *dims, LOAD), "sale_id") == [("1",)]


def test_only_needed_columns_are_read_and_lines_are_filtered_in_the_scan(spark, sales, dims, tmp_path):
    path = str(tmp_path / "sales")
    sales({"sale_id": "1"}).write.parquet(path)
    wide = dims[3].withColumns({"product_name": F.lit("n"), "warranty": F.lit("w")})
    wide.write.parquet(str(tmp_path / "product"))
    product = spark.read.parquet(str(tmp_path / "product"))
    explained = plan(fact_sales(spark.read.parquet(path), *dims[:3], product, dims[4], LOAD))
    assert "ReadSchema: struct<product_sk:bigint,product_id:string>" in explained
    assert "coupon_code" not in explained
    assert "GreaterThanOrEqual(quantity,0)" in explained


def test_hot_customer_is_split(spark, dims, conf, tmp_path):
    """One customer owns a third of the lines and the dimension is too large to broadcast."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    lines = spark.range(60000).selectExpr(
        "string(id) AS sale_id", "timestamp'2024-01-05' AS sale_ts",
        "IF(id % 3 = 0, 'hot', string(id % 1000)) AS customer_id", "'p1' AS product_id", "'s1' AS store_id",
        "'e1' AS employee_id", "1 AS quantity", "1.0D AS unit_price", "0.0D AS discount_percent",
    )
    lines.repartition(8).write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))
    customer = spark.range(1000).selectExpr("id AS customer_sk", "string(id) AS customer_id", "true AS is_current").union(
        spark.createDataFrame([(5000, "hot", True)], "customer_sk long, customer_id string, is_current boolean")
    )
    from stratalake.operators.facts import with_key

    joined = with_key(lines, customer, "customer_id", "customer_id", "customer_sk")
    assert joined.filter("customer_sk IS NULL").count() == 0
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan(joined)
    assert joined.filter("customer_sk = 5000").count() == 20000


def test_attributed_rows_are_distinct_without_employee(frame):
    fact = frame("sale_id string, employee_sk string, net int", ("1", "k", 5), ("1", "j", 5), ("2", None, 5))
    assert rows(fact_distinct_attributed(fact)) == [("1", 5)]


def test_coverage_shows_employees_the_dimension_lacks(frame):
    sales = frame("employee_id string", ("1",), ("1",), ("2",), ("3",), (None,))
    dim = frame("employee_id string, is_current boolean", ("1", True), ("2", False), ("9", True))
    assert rows(employee_coverage(sales, dim)) == sorted(
        [("1", "1"), (None, "2"), (None, "3"), (None, None)], key=repr
    )


def test_layer_counts(frame):
    one = frame("a int", (1,))
    assert rows(layer_counts({"x": one, "y": one.limit(0)})) == [("x", 1), ("y", 0)]


def test_calendar_from_bounds(frame):
    from stratalake.operators import calendar_between

    bounds = frame("first_day date, last_day date", (date(2024, 12, 31), date(2025, 1, 1)))
    assert rows(calendar_between(bounds), "date_sk", "quarter") == [(20241231, 4), (20250101, 1)]
