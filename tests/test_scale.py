"""What merges and loads move, and that they do the same with less."""

import glob
import os
import time

from conftest import plan, rows
from pyspark.sql import functions as F

from checks import feeds
from checks.queries import _landed, land, spread
from stratalake.operators import dedupe_latest, fact_sales, merge_latest, merge_sorted, merge_upsert, upsert_table
from stratalake.operators.facts import source_hash
from stratalake.plans import sales_upsert_latest
from stratalake.schemas import GOLD, SILVER, struct
from stratalake.sources import exchanged, shuffles_dropped, stage, staged_for_load

COLUMNS = "k string, v int, imported_date int, source_file string"
ARRIVAL = ["imported_date", "source_file"]


def test_sorted_merge_moves_each_column_once(frame, conf):
    conf("spark.sql.adaptive.enabled", "false")
    target, source = (stage(frame(COLUMNS, ("a", n, n, "f"), (None, n, n, "f"))) for n in (1, 2))
    merged = merge_sorted(target, source, ["k"], newer_by=ARRIVAL)
    below = plan(merged).split("Exchange ", 1)[1]
    assert "struct(" not in below and "_w0" not in below
    assert rows(merged) == sorted([("a", 2, 2, "f"), (None, 1, 1, "f"), (None, 2, 2, "f")], key=repr)


def test_merge_of_latest_equals_dedupe_and_upsert(frame, conf):
    conf("spark.sql.adaptive.enabled", "false")
    target = stage(
        frame(COLUMNS, ("a", 1, 5, "f"), ("b", 2, 5, "f"), ("c", 3, None, None), (None, 4, 1, "f"), (None, 4, 1, "f"), ("t", 5, None, "f"))
    )
    source = stage(
        frame(
            COLUMNS,
            ("a", 10, 4, "z"), ("a", 11, 3, "z"), ("b", 20, 5, "f"), ("b", 21, 5, "f"), ("c", 30, None, None),
            ("d", 40, None, "f"), ("d", 41, None, "f"), ("d", None, 1, None), (None, 50, 9, "f"), ("t", None, None, "g"),
        )
    )
    merged = merge_latest(target, source, ["k"], ARRIVAL)
    assert rows(merged) == rows(merge_upsert(target, dedupe_latest(source, ["k"]), ["k"], newer_by=ARRIVAL))
    assert plan(merged).count("Exchange ") == 1 and "WindowGroupLimit" in plan(merged).split("Exchange ", 1)[1]


def test_sales_upsert_into_one_row_per_sale_is_one_exchange(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    target, sales = (stage(spark.createDataFrame([], struct(SILVER["sales_clean"]))) for _ in range(2))
    assert plan(sales_upsert_latest(target, sales, unique_target=True)).count("Exchange ") == 1
    wider = stage(sales.withColumn("till", F.lit("x")))
    assert sales_upsert_latest(target, wider, unique_target=True).columns == wider.columns


def test_large_upsert_gathers_buckets_in_the_exchange_that_merges(spark, lake, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    lake.ensure_table("silver", "t", struct("k string, v int, at int"), key="k")
    plans, replace = [], lake.replace_buckets

    def seen(layer, table, merged, buckets, gathered=False):
        plans.append((plan(merged), gathered))
        replace(layer, table, merged, buckets, gathered=gathered)

    monkeypatch.setattr(lake, "replace_buckets", seen)
    for start, at in ((0, 5), (100, 6), (150, 1)):
        batch = stage(spark.range(start, start + 200).selectExpr("id AS k", f"{at} AS v", f"{at} AS at"))
        upsert_table(lake, "silver", "t", batch, ["k"], ["at"])
    assert len(plans) == 2
    for text, gathered in plans:
        assert gathered and text.count("Exchange ") == 1 and "Join" not in text
    got = lake.read_layer("silver", "t")
    assert rows(got.groupBy("v").count()) == [(1, 50), (5, 100), (6, 200)]
    assert got.count() == got.select("k").distinct().count() == 350
    files = [f.rsplit("/", 2)[1] for f in got.inputFiles()]
    assert len(files) <= 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_loads_write_packed_files(spark, lake, tmp_path):
    lake.ensure_layers()
    lake.append_rows("silver", "store_clean", spark.createDataFrame([("1", "x", "y", "f", None)], struct(SILVER["store_clean"])))
    lake.overwrite_table("gold", "dim_date", spark.createDataFrame([], struct(GOLD["dim_date"])))
    names = [lake.read_layer(*t).inputFiles() for t in (("silver", "store_clean"), ("gold", "dim_date"))]
    assert all(f.endswith(".zstd.parquet") for files in names for f in files) and names[0]
    assert stage(spark.range(3), codec="zstd").inputFiles()[0].endswith(".zstd.parquet")


def test_landing_is_packed_and_dealt_without_a_sort(spark):
    lines = spark.range(1000).selectExpr("id", "string(id % 7) AS v")
    path = land(lines, "landing-test").removeprefix("file:")
    assert glob.glob(f"{path}/*.csv.gz") and not glob.glob(f"{path}/*.csv")
    assert rows(spark.read.option("header", True).csv(path)) == rows(lines.selectExpr("string(id)", "v"))


def test_fact_carries_short_hashes_and_decimals(spark, frame, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    sales = stage(spark.createDataFrame([("1", None, "c", "p", "s", "e", 3, 1.005, None, 12.5, "m", "f", None)], struct(SILVER["sales_clean"])))
    assert sales.select(F.length(source_hash())).first()[0] == 24
    dims = [stage(spark.createDataFrame([], struct(GOLD[f"dim_{d}"]))) for d in ("date", "customer", "employee", "product", "store")]
    made = fact_sales(sales, *dims, "2024-01-01 00:00:00")
    assert "unit_price#" not in plan(made).split("Exchange ", 1)[1].split("Project", 1)[0]
    row = made.first()
    assert [str(row[c]) for c in ("unit_price", "discount_amt", "gross_amt", "net_amt")] == ["1.01", "0.38", "3.03", "2.65"]


def test_feed_lines_are_dealt_before_they_widen(spark):
    sf_dir = "/root/testdata/sf0.001"
    for feed, late in ((feeds.sales_feed, "coupon_code"), (feeds.product_feed, "product_name")):
        rows_of = spread(feed, spark, sf_dir)
        explained = plan(rows_of)
        assert "REPARTITION_BY_COL" in explained and exchanged(rows_of)
        assert f"AS {late}#" not in explained.split("REPARTITION_BY_COL", 1)[1]
        assert rows(rows_of) == rows(feed(spark, sf_dir))


def test_amounts_are_reckoned_after_lines_are_gathered(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    sales = stage(spark.createDataFrame([("1", None, "c", "p", "s", "e", 3, 1.005, None, 12.5, "m", "f", None)], struct(SILVER["sales_clean"])))
    dims = [stage(spark.createDataFrame([], struct(GOLD[f"dim_{d}"]))) for d in ("date", "customer", "employee", "product", "store")]
    dealt = fact_sales(sales, *dims, "2024-01-01 00:00:00", gather=lambda keyed: keyed.withColumn("b", F.length("sale_id")).repartition("b"))
    assert "net_amt#" not in plan(dealt).split("Exchange hashpartitioning(b", 1)[1]
    plain = fact_sales(sales, *dims, "2024-01-01 00:00:00")
    assert dealt.columns == [*plain.columns, "b"] and rows(dealt.drop("b")) == rows(plain)


def test_shuffle_files_go_when_a_job_of_a_load_ends(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses

    def shuffled():
        before = kept().size()
        stage(spark.range(100).repartition(3, "id"))
        for _ in range(50):
            if kept().size() <= before:
                return False
            time.sleep(0.1)
        return True

    before = spark.conf.get(name, None)
    with staged_for_load(spark), staged_for_load(spark):
        assert not shuffled()
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before


def test_landing_goes_when_bronze_has_taken_it_in(spark):
    lake, landing = _landed(spark, "/root/testdata/sf0.001", feeds.sales_feed(spark, "/root/testdata/sf0.001"))
    assert not any(os.path.exists(folder.removeprefix("file:")) for folder in landing.values())
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert lake.read_layer("raw", "sales_raw").count() == lake.read_layer("raw", "product").count() == lines


def test_rows_staged_apart_are_read_by_value(spark):
    apart = stage(spark.range(40).selectExpr("id % 4 AS part", "id"), by="part")
    assert apart.columns == ["part", "id"] and rows(apart) == sorted(((n % 4, n) for n in range(40)), key=repr)
    assert {f.rsplit("/", 2)[1] for f in apart.filter("part = 3").inputFiles()} <= {f"part={n}" for n in range(4)}
    assert "PartitionFilters: [isnotnull(part" in plan(apart.filter("part = 3"))
