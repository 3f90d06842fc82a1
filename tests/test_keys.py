import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from stratalake.operators import assign_surrogate_keys, max_surrogate_key


@pytest.fixture
def many_ranges(conf):
    """Keep the range exchange from shrinking to one partition on small data."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "7")


def test_same_numbers_as_a_global_window(spark, many_ranges):
    df = spark.range(5000).selectExpr("string(id * 7919 % 100003) AS k", "id AS v")
    got = assign_surrogate_keys(df, "sk", ["k"], 40)
    df.createOrReplaceTempView("unnumbered")
    expected = spark.sql("SELECT 40 + row_number() OVER (ORDER BY k) AS sk, k, v FROM unnumbered")
    assert got.columns == ["sk", "k", "v"]
    assert dict(got.dtypes)["sk"] == "bigint"
    assert rows(got) == rows(expected)


def test_repeated_order_value_is_spread_and_still_dense(spark, many_ranges):
    """One value owns a third of the rows; the other columns decide among them."""
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id) END AS k", "id AS v")
    got = assign_surrogate_keys(df, "sk", ["k"])
    assert [r[0] for r in got.select("sk").orderBy("sk").collect()] == list(range(1, 3001))
    df.createOrReplaceTempView("unnumbered")
    expected = spark.sql("SELECT row_number() OVER (ORDER BY k, v) AS sk, k, v FROM unnumbered")
    assert rows(got) == rows(expected)
    hot = df.filter("k = 'hot'").count()
    ranges = df.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id())
    assert ranges.filter("k = 'hot'").groupBy("part").count().agg(F.max("count")).first()[0] < hot


def test_base_from_the_dimension(frame):
    new = frame("k string", ("b",), ("a",))
    dim = frame("sk bigint, k string", (7, "z"))
    empty = dim.limit(0)
    assert rows(assign_surrogate_keys(new, "sk", ["k"], max_surrogate_key(dim, "sk"))) == [(8, "a"), (9, "b")]
    assert rows(assign_surrogate_keys(new, "sk", ["k"], max_surrogate_key(empty, "sk"))) == [(1, "a"), (2, "b")]


def test_nothing_to_number(frame):
    assert assign_surrogate_keys(frame("k string"), "sk", ["k"]).count() == 0
