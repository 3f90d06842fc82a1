import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan, rows

from stratalake.operators import (
    clean_customer,
    clean_employee_history,
    clean_product,
    clean_sales,
    clean_store,
    clean_supplier,
    dedupe_latest,
)
from stratalake.schemas import LANDING, bronze_schema

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_clean_customer(spark):
    raw = spark.createDataFrame(
        [(" C1 ", " anna LEE", " male ", 40, " A@B.C ", "+977-98 1", "old town ", "GOLD", "f", T1)],
        bronze_schema("customer"),
    )
    assert tuple(clean_customer(raw).first()) == (
        "C1", "Anna Lee", "MALE", 40, "a@b.c", "+977981", "Old Town", "Gold", "f", T1,
    )


def test_clean_small_entities(spark):
    product = spark.createDataFrame(
        [(" 1", "wide TV ", " 2 ", "big co", " 7 Days ", "1 YEAR ", "f", T1)], bronze_schema("product")
    )
    assert tuple(clean_product(product).first())[:6] == (
        "1", "Wide Tv", "2", "Big Co", "7 Days", "1 YEAR",
    )
    store = spark.createDataFrame([(" 1", "my MART", " a b", "f", T1)], bronze_schema("store"))
    assert tuple(clean_store(store).first())[:3] == ("1", "My Mart", "A B")
    supplier = spark.createDataFrame([("1 ", "x y", "f", T1)], bronze_schema("supplier"))
    assert tuple(clean_supplier(supplier).first())[:2] == ("1", "X Y")


def test_age_as_text_that_is_no_number_is_null(spark):
    columns = LANDING["customer"].replace("age int", "age string") + ", source_file string, imported_date timestamp"
    raw = spark.createDataFrame([("1", "a", "m", "forty", "e", "1", "c", "t", "f", T1)], columns)
    assert clean_customer(raw).first().age is None


def test_employee_fingerprint_covers_values_as_delivered(spark):
    raw = spark.createDataFrame(
        [
            (" 7 ", " E1", " 2", "old store", datetime(2024, 1, 5, 9), None, True, True, "f", T1),
            (None, "E2", "2", "x", T1, T2, False, None, "f", T1),
            ("8", None, "3", None, T1, T2, False, None, "f", T1),
        ],
        bronze_schema("employee"),
    )
    got = {r.employee_id: r for r in clean_employee_history(raw).collect()}
    assert set(got) == {"7", "8"}
    assert (got["7"].employee_code, got["7"].store_id, got["7"].store_name) == ("E1", "2", "Old Store")
    assert got["7"].change_hash == hashlib.sha256(b" E1| 2|old store|true").hexdigest()
    assert got["8"].change_hash == hashlib.sha256(b"|3||").hexdigest()
    assert got["7"].effective_from == date(2024, 1, 5)
    assert got["7"].effective_to == date(9999, 12, 31)
    assert got["8"].is_primary is False


def test_sales_without_id_quantity_or_price_are_left_out(spark):
    def sale(sale_id, quantity, price):
        return (sale_id, T1, "c", "p", "s", "e", quantity, price, " x ", 5.0, " ONLINE", "f", T1)

    columns = LANDING["sales_raw"] + ", source_file string, imported_date timestamp"
    raw = spark.createDataFrame(
        [
            sale("1", 1, 0.0),
            sale("", 1, 1.0),
            sale(None, 1, 1.0),
            sale("2", 0, 1.0),
            sale("3", None, 1.0),
            sale("4", 1, -0.01),
            sale("5", 1, None),
        ],
        columns,
    )
    got = clean_sales(raw)
    assert rows(got, "sale_id") == [("",), ("1",)]
    assert got.first()["mode"] == "online" and got.first()["coupon_code"] == "x"


COLUMNS = "id string, v int, source_file string, imported_date timestamp"


def test_newest_wins_then_file_then_remaining_columns(frame):
    df = frame(
        COLUMNS,
        ("a", 9, "f1", T1),
        ("a", 1, "f1", T2),
        ("b", 1, "f2", T1),
        ("b", 2, "f1", T1),
        ("c", 1, "f1", T1),
        ("c", 3, "f1", T1),
        ("c", None, "f1", T1),
        ("d", 5, "f1", None),
        ("d", 4, None, T1),
        ("", 1, "f1", T1),
        (None, 1, "f1", T1),
    )
    got = dedupe_latest(df, ["id"])
    assert got.columns == df.columns
    assert rows(got, "id", "v") == [("", 1), ("a", 1), ("b", 1), ("c", 3), ("d", 4)]


def test_null_keys_can_be_kept(frame):
    df = frame(COLUMNS, (None, 1, "f", T1), (None, 2, "f", T1), ("a", 1, "f", T1))
    got = dedupe_latest(df, ["id"], drop_null_keys=False)
    assert rows(got, "id", "v") == [("a", 1), (None, 2)]


@pytest.mark.parametrize("hot", ["id < 100", "id % 3 = 0"])
def test_hot_key_matches_a_window_and_shrinks_before_the_exchange(spark, hot):
    """Brute force on a fixture in which one key owns a third of the rows, or all of them."""
    df = spark.range(3000).selectExpr(
        f"CASE WHEN {hot} THEN 'hot' ELSE string(id % 50) END AS id",
        "int(hash(id) % 100) AS v",
        "string(id % 7) AS source_file",
        "timestamp_seconds(id % 11) AS imported_date",
    )
    df.createOrReplaceTempView("arrivals")
    expected = spark.sql(
        """SELECT id, v, source_file, imported_date FROM (
             SELECT *, row_number() OVER (PARTITION BY id
               ORDER BY imported_date DESC, source_file DESC, v DESC) AS rn FROM arrivals)
           WHERE rn = 1"""
    )
    got = dedupe_latest(df, ["id"])
    assert rows(got) == rows(expected)
    below_exchange = plan(got).split("Exchange")[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_order_of_input_does_not_matter(spark):
    df = spark.range(500).selectExpr(
        "string(id % 9) AS id", "int(id) AS v", "'f' AS source_file", "timestamp_seconds(0) AS imported_date"
    )
    shuffled = df.orderBy(F.xxhash64("v")).repartition(3)
    assert rows(dedupe_latest(df, ["id"])) == rows(dedupe_latest(shuffled, ["id"]))
