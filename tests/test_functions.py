import hashlib
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F
from tests.conftest import rows

from stratalake.functions import (
    hashdiff,
    norm_key,
    norm_lower,
    norm_phone,
    norm_title,
    norm_upper,
    parse_bool,
    sales_amounts,
)


def test_keys_lose_spaces_only(frame):
    df = frame("k string", (None,), ("",), (" 1 ",), ("\t1",))
    assert [r[0] for r in df.select(norm_key("k")).collect()] == [None, "", "1", "\t1"]


def test_title_splits_on_spaces_only(frame):
    df = frame("n string", (" o'neil mc-donald ",), ("ANNA  maria",), (None,))
    assert [r[0] for r in df.select(norm_title("n")).collect()] == [
        "O'neil Mc-donald",
        "Anna  Maria",
        None,
    ]


def test_case_and_phone(frame):
    df = frame("t string", (" Ab+977-98 (1) ",))
    got = df.select(norm_upper("t"), norm_lower("t"), norm_phone("t")).first()
    assert tuple(got) == ("AB+977-98 (1)", "ab+977-98 (1)", "+977981")


def test_only_yes_words_are_true(frame):
    words = ["1", "true", "T", "y", "YES", "no", "0", " yes", "", None]
    df = frame("w string", *((w,) for w in words))
    assert [r[0] for r in df.select(parse_bool("w")).collect()] == [True] * 5 + [False] * 5


def test_booleans_parse_too(frame):
    df = frame("b boolean", (True,), (False,), (None,))
    assert [r[0] for r in df.select(parse_bool("b")).collect()] == [True, False, False]


def test_hashdiff_keeps_places_and_reads_null_as_empty(frame):
    df = frame("a string, b int, c boolean", ("x", 1, True), (None, 1, True), ("", 1, True))
    got = [r[0] for r in df.select(hashdiff(["a", "b", "c"], "|")).collect()]
    assert got[0] == hashlib.sha256(b"x|1|true").hexdigest()
    assert got[1] == got[2] == hashlib.sha256(b"|1|true").hexdigest()


def test_amounts_round_half_a_cent_up_once(frame):
    df = frame(
        "quantity int, unit_price double, discount_percent double",
        (1, 1.05, 10.0),  # discount 0.105, net 0.945
        (3, 0.35, 50.0),  # discount 0.525, net 0.525
        (1, 1.005, None),  # price to cents first
        (0, 5.0, 50.0),
    )
    got = df.select(*(c.alias(n) for n, c in sales_amounts().items())).collect()
    as_text = [tuple(str(v) for v in r) for r in got]
    assert as_text == [
        ("1.05", "0.11", "1.05", "0.95"),
        ("0.35", "0.53", "1.05", "0.53"),
        ("1.01", "0.00", "1.01", "1.01"),
        ("5.00", "0.00", "0.00", "0.00"),
    ]


def test_amounts_are_exact_where_doubles_are_not(frame):
    df = frame("quantity int, unit_price double, discount_percent double", (3, 0.1, 0.0))
    assert df.select(sales_amounts()["gross_amt"]).first()[0] == Decimal("0.30")


def test_calendar(spark):
    from stratalake.operators import dim_date

    whole = dim_date(spark)
    assert whole.count() == 7670
    leap = dim_date(spark, "2024-02-28", date(2024, 3, 2)).orderBy("date_sk").collect()
    assert [r.date_sk for r in leap] == [20240228, 20240229, 20240301, 20240302]
    assert tuple(leap[-1])[2:] == (2, 3, 2024, 1, "Saturday", "March", True)
    assert whole.filter(F.col("date_sk") == 20150101).first().day_name == "Thursday"


def test_rows_helper_sorts(frame):
    assert rows(frame("a int", (2,), (1,))) == [(1,), (2,)]
