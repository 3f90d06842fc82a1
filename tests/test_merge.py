import pytest
from tests.conftest import plan, rows

from stratalake.operators import (
    append_rows,
    check_unique_source,
    insert_missing,
    merge_update,
    merge_upsert,
    new_keys,
)
from stratalake.sources import stage

NO_BROADCAST = ("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def target(frame):
    return frame("k string, v int, own string", ("a", 1, "x"), ("b", 2, "y"), (None, 3, "z"))


@pytest.fixture
def source(frame):
    return frame("k string, v int, extra int", ("b", 20, 7), ("c", 30, 8), (None, 40, 9))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_upsert(target, source, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    got = merge_upsert(target, source, ["k"])
    assert got.columns == ["k", "v", "own", "extra"]
    assert rows(got) == sorted(
        [
            ("a", 1, "x", None),  # only in the target: kept
            ("b", 20, "y", 7),  # matched: target-only column keeps its value
            ("c", 30, None, 8),  # added
            (None, 3, "z", None),  # NULL matches nothing
            (None, 40, None, 9),
        ],
        key=repr,
    )


def test_upsert_sets_null_from_the_source(frame):
    got = merge_upsert(frame("k int, v int", (1, 5)), frame("k int, v int", (1, None)), ["k"])
    assert rows(got) == [(1, None)]


def test_upsert_twice_is_upsert_once(target, source):
    source = source.filter("k IS NOT NULL")
    once = merge_upsert(target, source, ["k"])
    assert rows(merge_upsert(once, source, ["k"])) == rows(once)


def test_upsert_casts_to_the_targets_type(frame):
    got = merge_upsert(frame("k int, v decimal(5,2)", (1, None)), frame("k int, v int", (1, 5)), ["k"])
    assert dict(got.dtypes)["v"] == "decimal(5,2)"


@pytest.mark.parametrize("use", [lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("v").collect()])
def test_repeated_source_key_raises(frame, use):
    target = frame("k string, v int", ("a", 1))
    source = frame("k string, v int", ("a", 2), ("a", 3))
    with pytest.raises(Exception, match="2 rows for key .k. = .a."):
        use(merge_upsert(target, source, ["k"]))


def test_repeated_null_keys_do_not_raise(frame):
    source = frame("k string, v int", (None, 2), (None, 3), ("a", 1))
    assert check_unique_source(source, ["k"]).count() == 0


def test_composite_keys(frame):
    target = frame("a int, b int, v int", (1, 1, 0), (1, 2, 0))
    source = frame("a int, b int, v int", (1, 2, 9), (2, 2, 9))
    assert rows(merge_upsert(target, source, ["a", "b"])) == [(1, 1, 0), (1, 2, 9), (2, 2, 9)]


def test_update_touches_named_columns_only(frame):
    target = frame("k int, v int, w int", (1, 1, 1), (2, 2, 2))
    source = frame("k int, v int, w int", (2, 20, 20), (3, 30, 30))
    assert rows(merge_update(target, source, ["k"], ["v"])) == [(1, 1, 1), (2, 20, 2)]


def test_insert_missing_keeps_matched_rows(frame):
    target = frame("k int, v int", (1, 1))
    source = frame("k int, v int", (1, 10), (2, 20))
    assert rows(insert_missing(target, source, ["k"])) == [(1, 1), (2, 20)]


def test_append_goes_by_name(frame):
    got = append_rows(frame("a int, b int", (1, 2)), frame("b int, a int, c int", (4, 3, 5)))
    assert rows(got) == [(1, 2, None), (3, 4, 5)]


def test_small_source_moves_no_target_rows(spark, frame, tmp_path, conf):
    """A target above the broadcast threshold meets a source below it."""
    path = str(tmp_path / "target")
    spark.range(20000).selectExpr("id AS k", "id AS v", "sha2(string(id), 256) AS w").write.parquet(path)
    target = spark.read.parquet(path)
    conf("spark.sql.autoBroadcastJoinThreshold", "20KB")
    source = stage(spark.createDataFrame([(5, 50), (99999, 1)], "k long, v long"))
    updated = plan(merge_update(target, source, ["k"]))
    assert "BroadcastHashJoin" in updated and "hashpartitioning" not in updated
    added = new_keys(target, source, ["k"])
    picked = plan(added)
    assert "LeftSemi, BuildRight" in picked and "BroadcastHashJoin" in picked
    assert rows(added) == [(99999, 1)]


def test_large_source_is_one_anti_join(spark, conf):
    conf(*NO_BROADCAST)
    target = spark.range(100).selectExpr("id AS k")
    source = spark.range(50, 150).selectExpr("id AS k")
    added = new_keys(target, source, ["k"])
    assert "LeftSemi" not in plan(added)
    assert added.count() == 50
