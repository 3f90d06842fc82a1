from datetime import datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from stratalake.operators import current_rows, scd1_apply, scd2_apply, scd2_changes
from stratalake.schemas import OPEN_CUSTOMER_TS
from stratalake.sources import stage

T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))
OPEN = datetime(9999, 12, 31, 23, 59, 59)
DIM = (
    "sk bigint, id string, code string, store string, effective_from timestamp, "
    "effective_to timestamp, is_current boolean"
)


def load(dim, snapshot, ts, **options):
    return scd2_apply(dim, snapshot, "id", "sk", ["code", "store"], ts, OPEN_CUSTOMER_TS, **options)


@pytest.fixture(scope="module")
def loaded(frame):
    """Three keys at T1; at T2 one is unchanged, one changed, one gone and one new."""
    before = frame("id string, code string, store string", ("a", "1", "x"), ("b", "1", "x"), ("c", "1", "x"))
    snapshot = frame("id string, code string, store string", ("a", "1", "x"), ("b", "2", "x"), ("d", "1", "x"))
    first = stage(load(frame(DIM), before, T1))
    return snapshot, stage(load(first, snapshot, T2))


def test_versions(loaded):
    _, dim = loaded
    assert rows(dim) == [
        (1, "a", "1", "x", T1, OPEN, True),
        (2, "b", "1", "x", T1, T2, False),  # ends where its successor begins
        (3, "c", "1", "x", T1, OPEN, True),  # vanished keys stay current
        (4, "b", "2", "x", T2, OPEN, True),
        (5, "d", "1", "x", T2, OPEN, True),
    ]


def test_loading_the_same_snapshot_again_changes_nothing(loaded):
    snapshot, dim = loaded
    assert rows(load(dim, snapshot, T3)) == rows(dim)
    assert load(dim, snapshot, T3, check=False) is dim


def test_closed_versions_are_left_alone_and_a_key_may_return(loaded, frame):
    _, dim = loaded
    back = load(dim, frame("id string, code string, store string", ("b", "1", "x")), T3)
    versions = rows(back.filter("id = 'b'"), "sk", "code", "effective_from", "effective_to", "is_current")
    assert versions == [(2, "1", T1, T2, False), (4, "2", T2, T3, False), (6, "1", T3, OPEN, True)]


def test_one_current_row_per_key_and_no_overlap(loaded, frame):
    dim = loaded[1]
    for step, ts in enumerate((T3, datetime(2024, 4, 1), datetime(2024, 5, 1))):
        snapshot = frame(
            "id string, code string, store string", *((k, str((step + i) % 2), "x") for i, k in enumerate("abcdef"))
        )
        dim = stage(load(dim, snapshot, ts))
    current = current_rows(dim).groupBy("id").count()
    assert current.filter("count <> 1").count() == 0
    later = dim.select(F.col("id").alias("i2"), F.col("sk").alias("s2"), F.col("effective_from").alias("f2"), F.col("effective_to").alias("t2"))
    overlap = dim.join(later, (F.col("id") == F.col("i2")) & (F.col("sk") < F.col("s2")) & (F.col("f2") < F.col("effective_to")) & (F.col("effective_from") < F.col("t2")))
    assert overlap.count() == 0
    assert dim.agg(F.max("sk"), F.countDistinct("sk"), F.count("*")).first()[0] == dim.count()


def test_change_from_or_to_null(frame):
    dim = frame(DIM, (1, "a", None, "x", T1, OPEN, True), (2, "b", "1", "x", T1, OPEN, True), (3, "c", None, None, T1, OPEN, True))
    snapshot = frame("id string, code string, store string", ("a", "1", "x"), ("b", None, "x"), ("c", None, None))
    assert rows(scd2_changes(dim, snapshot, "id", ["code", "store"])) == []
    assert rows(scd2_changes(dim, snapshot, "id", ["code", "store"], null_safe=True), "id") == [("a",), ("b",)]


def test_repeated_snapshot_key_raises(frame):
    snapshot = frame("id string, code string, store string", ("a", "1", "x"), ("a", "2", "x"))
    with pytest.raises(Exception, match="2 rows for key"):
        load(frame(DIM), snapshot, T1).collect()


def test_hash_keys_repeat_on_a_retry_and_differ_by_version(frame):
    dim = frame(DIM.replace("sk bigint", "sk string"))
    snapshot = frame("id string, code string, store string", ("a", "1", "x"))
    one, again = (load(dim, snapshot, T1, sk_mode="hash") for _ in range(2))
    other = load(dim, snapshot, T2, sk_mode="hash")
    assert rows(one) == rows(again) and rows(one, "sk") != rows(other, "sk")
    with pytest.raises(ValueError):
        load(dim, snapshot, T1, sk_mode="uuid")


def test_type_1_updates_every_match_and_numbers_new_keys_in_order(frame):
    dim = frame("sk bigint, id string, name string, updated_at timestamp", (4, "b", "old", T1), (9, "a", "same", T1), (2, "z", "gone", T1))
    source = frame("id string, name string, ignored int", ("a", "same", 1), ("b", "new", 1), ("d", "n", 1), ("c", "n", 1))
    got = scd1_apply(dim, source, "id", "sk", ["name"], T2)
    assert rows(got) == [
        (10, "c", "n", T2),
        (11, "d", "n", T2),
        (2, "z", "gone", T1),
        (4, "b", "new", T2),
        (9, "a", "same", T2),
    ]
