"""Incremental loads: what they take in, what they rewrite, and how they go on after a failure."""

import os
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan, rows
from tests.test_tables_and_streams import deliver, files

from stratalake.operators import merge_sorted, merge_upsert, upsert_table
from stratalake.operators.facts import source_hash
from stratalake.plans import gold as gold_plan
from stratalake.plans import silver as silver_plan
from stratalake.plans import run_bronze, run_gold, run_silver
from stratalake.schemas import SILVER, struct
from stratalake.sources import Lakehouse, scratch_root, stage
from stratalake.streaming import csv_stream, stream_upsert, with_audit

T1, T2, T3 = ("2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00")
DAYS = {"first_day": "2024-01-01", "last_day": "2024-12-31"}
HEADER = "sale_id,sale_ts,customer_id,product_id,store_id,employee_id,quantity,unit_price,coupon_code,discount_percent,mode"


def sale(number, customer="C1", product="1", store="1", day="01", quantity=2, price="10.50"):
    return f"S{number},2024-03-{day} 10:00:00,{customer},{product},{store},1,{quantity},{price},X,10,Online"


@pytest.fixture
def shop(spark, tmp_path):
    """Two customers, products and stores and forty sales, in bronze and silver."""
    lake = Lakehouse(spark, str(tmp_path / "lake"), prefix="s" + re.sub(r"\W", "_", tmp_path.name), buckets=8)
    landing = {
        "customer": deliver(
            tmp_path / "customer", "1.csv", "customer_id,customer_name,gender,age,email,phone_number,city,loyalty_tier",
            "C1,a,f,30,a@x,1,rome,gold", "C2,b,m,40,b@x,2,oslo,gold",
        ),
        "product": deliver(
            tmp_path / "product", "1.csv", "product_id,product_name,supplier_id,supplier_name,return_policy,warranty",
            "1,tv,1,acme,7,1", "2,pc,1,acme,7,1",
        ),
        "store": deliver(tmp_path / "store", "1.csv", "store_id,store_name,city", "1,mart,rome", "2,shop,oslo"),
        "sales_raw": deliver(tmp_path / "sales", "1.csv", HEADER, *(sale(n) for n in range(40))),
    }
    run_bronze(lake, landing, T1)
    run_silver(lake)

    def arrive(name, *lines, at=T2):
        deliver(tmp_path / "sales", name, HEADER, *lines)
        run_bronze(lake, {"sales_raw": landing["sales_raw"]}, at)

    lake.arrive, lake.landing = arrive, landing
    return lake


def fact(lake, *ids):
    found = lake.read_layer("gold", "fact_sales").filter(F.col("sale_id").isin(*ids))
    return rows(found, "sale_id", "date_sk", "customer_sk", "product_sk", "store_sk", "quantity")


def test_a_correction_that_arrived_before_the_fact_was_loaded_is_carried_over(shop):
    shop.arrive("2.csv", sale(1, customer="C2"), sale(2, product="2"), sale(3, store="2"), sale(4, day="09"), sale(5))
    run_gold(shop, T3, **DAYS)  # after the arrival, before silver has it
    assert fact(shop, "S1", "S4") == [("S1", 20240301, 1, 1, 1, 2), ("S4", 20240301, 1, 1, 1, 2)]
    run_silver(shop)
    run_gold(shop, "2024-03-02 00:00:00", **DAYS)
    assert fact(shop, "S1", "S2", "S3", "S4", "S5") == [
        ("S1", 20240301, 2, 1, 1, 2), ("S2", 20240301, 1, 2, 1, 2), ("S3", 20240301, 1, 1, 2, 2),
        ("S4", 20240309, 1, 1, 1, 2), ("S5", 20240301, 1, 1, 1, 2),
    ]
    loaded = shop.read_layer("gold", "fact_sales")
    assert loaded.count() == 40
    # A sale that arrived again as it was keeps its row.
    assert loaded.filter(F.col("load_ts") == "2024-03-02 00:00:00").count() == 4


def test_one_corrected_sale_rewrites_one_bucket_of_silver_and_of_the_fact(shop):
    run_gold(shop, T1, **DAYS)
    before = {t: files(shop, *t) for t in (("silver", "sales_clean"), ("gold", "fact_sales"))}
    shop.arrive("2.csv", sale(7, quantity=9))
    run_silver(shop)
    run_gold(shop, T2, **DAYS)
    for table, old in before.items():
        gone = {os.path.basename(os.path.dirname(f)) for f in old - files(shop, *table)}
        assert len(gone) == 1, table
    assert fact(shop, "S7") == [("S7", 20240301, 1, 1, 1, 9)]
    assert shop.read_layer("gold", "fact_sales").count() == 40


def test_new_sales_leave_all_files_in_place(shop):
    run_gold(shop, T1, **DAYS)
    before = {t: files(shop, *t) for t in (("silver", "sales_clean"), ("gold", "fact_sales"))}
    shop.arrive("2.csv", sale(100), sale(101))
    run_silver(shop)
    run_gold(shop, T2, **DAYS)
    assert all(old < files(shop, *table) for table, old in before.items())
    assert fact(shop, "S100", "S101") == [("S100", 20240301, 1, 1, 1, 2), ("S101", 20240301, 1, 1, 1, 2)]


def test_a_back_dated_arrival_is_not_missed(shop):
    shop.arrive("2.csv", sale(200), at="2020-01-01 00:00:00")
    run_silver(shop)
    assert shop.read_layer("silver", "sales_clean").count() == 41


def test_a_run_with_nothing_new_loads_nothing(shop):
    run_gold(shop, T1, **DAYS)
    known = {t: (files(shop, "silver", t), shop.properties("silver", t)) for t in SILVER}
    run_bronze(shop, shop.landing, T2)
    run_silver(shop)
    assert {t: (files(shop, "silver", t), shop.properties("silver", t)) for t in SILVER} == known
    fact_files = files(shop, "gold", "fact_sales")
    run_gold(shop, T2, **DAYS)
    assert files(shop, "gold", "fact_sales") == fact_files


def test_gold_catches_up_after_it_was_killed_between_two_silver_runs(shop, monkeypatch):
    run_gold(shop, T1, **DAYS)
    shop.arrive("2.csv", sale(1, quantity=5), sale(300))
    run_silver(shop)
    with monkeypatch.context() as broken:
        broken.setattr(gold_plan, "fact_sales", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            run_gold(shop, T2, **DAYS)
    shop.arrive("3.csv", sale(2, quantity=6), at=T3)
    run_silver(shop)
    run_gold(shop, T3, **DAYS)
    assert [r[-1] for r in fact(shop, "S1", "S2", "S300")] == [5, 6, 2]


def test_gold_killed_between_its_two_writes_finds_the_rest(shop, monkeypatch):
    run_gold(shop, T1, **DAYS)
    shop.arrive("2.csv", sale(1, quantity=5), *(sale(n) for n in range(400, 440)))
    run_silver(shop)
    with monkeypatch.context() as broken:
        broken.setattr(Lakehouse, "append_rows", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            gold_plan._load_fact(shop, T2, "new", None, False)
    assert fact(shop, "S1")[0][-1] == 5  # its bucket was rewritten
    run_gold(shop, T3, **DAYS)
    got = shop.read_layer("gold", "fact_sales")
    assert got.count() == got.select("sale_id").distinct().count() == 80


def test_silver_takes_rows_of_a_bronze_run_that_failed_before_it_ended(shop):
    finished = shop.finished_load("raw", "sales_raw")
    shop.arrive("2.csv", sale(1, quantity=5))
    shop.set_properties("raw", "sales_raw", finished=finished)  # as if the run had been lost after its batch
    run_silver(shop)
    assert rows(shop.read_layer("silver", "sales_clean").filter("sale_id = 'S1'"), "quantity") == [(2,)]
    run_bronze(shop, {"sales_raw": shop.landing["sales_raw"]}, T3)  # brings no file
    run_silver(shop)
    assert rows(shop.read_layer("silver", "sales_clean").filter("sale_id = 'S1'"), "quantity") == [(5,)]


def test_cleared_tables_are_loaded_again(shop):
    run_gold(shop, T1, **DAYS)
    assert set(shop.clear_tables().values()) == {None}
    assert shop.read_layer("silver", "sales_clean").count() == shop.read_layer("gold", "fact_sales").count() == 0
    run_silver(shop)
    run_gold(shop, T2, **DAYS)
    assert shop.read_layer("silver", "sales_clean").count() == shop.read_layer("gold", "fact_sales").count() == 40


def test_rows_written_by_hand_are_taken_too(shop):
    run_gold(shop, T1, **DAYS)
    extra = shop.read_layer("silver", "sales_clean").filter("sale_id = 'S1'").withColumn("sale_id", F.lit("hand"))
    shop.append_rows("silver", "sales_clean", stage(extra))
    run_gold(shop, T2, **DAYS)
    assert fact(shop, "hand") == [("hand", 20240301, 1, 1, 1, 2)]


def test_scratch_is_empty_after_loads_and_unused_folders_can_be_dropped(shop, spark):
    def staged():
        return {f for f in os.listdir(scratch_root(spark))} if os.path.isdir(scratch_root(spark)) else set()

    before = staged()
    run_gold(shop, T1, **DAYS)
    shop.arrive("2.csv", sale(7, quantity=9))
    run_silver(shop)
    run_gold(shop, T2, **DAYS)
    assert staged() == before
    tables = [("gold", "dim_product"), ("silver", "sales_clean")]
    content = [rows(shop.read_layer(*t)) for t in tables]
    assert shop.drop_unused(datetime.now() - timedelta(hours=1), tables) == []
    dropped = shop.drop_unused(datetime.now() + timedelta(minutes=1), tables)
    assert dropped and not any(os.path.exists(p) for p in dropped)
    assert [rows(shop.read_layer(*t)) for t in tables] == content


def test_a_failed_append_leaves_the_columns_as_they_were(lake, frame):
    lake.ensure_table("silver", "t", struct("a int"))
    failing = frame("a int, b int", (1, 2)).withColumn("b", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        lake.append_rows("silver", "t", failing)
    assert lake.read_layer("silver", "t").columns == ["a"]


# Columns that files gain


def test_gained_columns_reach_raw_and_silver_and_stay_known(spark, lake, tmp_path):
    columns = "store_id,store_name,city"
    folder = deliver(tmp_path / "in", "1.csv", columns, "1,mart,rome", "2,shop,oslo")
    run_bronze(lake, {"store": folder}, T1)
    run_silver(lake)
    deliver(folder, "2.csv", columns + ",manager", "2,shop,oslo,eve", "3,kiosk,bern,")
    run_bronze(lake, {"store": folder}, T2, new_columns={"store": "manager string"})
    deliver(folder, "3.csv", columns, "4,stall,linz")
    deliver(folder, "4.csv", columns + ",manager", "1,mart,rome,ann")
    run_bronze(lake, {"store": folder}, T3)
    raw = lake.read_layer("raw", "store")
    assert raw.columns == ["store_id", "store_name", "city", "source_file", "imported_date", "manager"]
    assert rows(raw, "store_id", "manager") == sorted(
        [("1", None), ("2", None), ("2", "eve"), ("3", None), ("4", None), ("1", "ann")], key=repr
    )
    run_silver(lake)
    assert rows(lake.read_layer("silver", "store_clean"), "store_id", "store_name", "manager") == [
        ("1", "Mart", "ann"), ("2", "Shop", "eve"), ("3", "Kiosk", None), ("4", "Stall", None),
    ]
    with pytest.raises(ValueError):
        run_bronze(lake, {"store": folder}, new_columns={"shops": "a int"})


# Merges


def test_sorted_merge_is_one_exchange_of_both_sides_with_the_check(frame, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    target = stage(frame("k string, v int, own string", ("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")))
    source = stage(frame("k string, v long, extra int", ("b", 20, 7), ("c", 30, 8), (None, 40, 9), (None, 41, 9)))
    merged = merge_upsert(target, source, ["k"], unique_target=True)
    assert plan(merged).count("Exchange ") == 1 and "Join" not in plan(merged)
    assert merged.columns == ["k", "v", "own", "extra"] and dict(merged.dtypes)["v"] == "int"
    assert rows(merged) == rows(merge_upsert(target, source, ["k"]))


def test_sorted_merge_keeps_newer_rows_and_raises_on_repeated_keys(frame):
    columns = "k int, v int, at int"
    target = frame(columns, (1, 1, 5), (2, 2, 5), (3, 3, None))
    source = frame(columns, (1, 10, 4), (2, 20, 5), (3, 30, 1), (4, 40, None))
    assert rows(merge_sorted(target, source, ["k"], newer_by=["at"])) == [(1, 1, 5), (2, 20, 5), (3, 30, 1), (4, 40, None)]
    for a, b in ((source.union(source.limit(1)), target), (source, target.union(target.limit(1)))):
        with pytest.raises(Exception, match="more than one row for key"):
            merge_sorted(b, a, ["k"]).collect()


def test_source_hash_tells_apart_what_looks_alike(frame):
    columns = "sale_ts string, customer_id string, product_id string, store_id string, employee_id string, quantity int, unit_price double, discount_percent double"
    alike = [("t", "a", None), ("t", None, "a"), ("t", "a|1:b", None), ("t", "a", "b"), ("t", "", "a"), (None, "a", None)]
    made = frame(columns, *((t, c, p, "s", "e", 1, 1.0, None) for t, c, p in alike)).select(source_hash())
    assert made.distinct().count() == len(alike)


def test_upsert_touches_only_buckets_of_the_batch(spark, tmp_path, frame):
    lake = Lakehouse(spark, str(tmp_path), prefix="b" + re.sub(r"\W", "_", tmp_path.name), buckets=16)
    lake.ensure_table("silver", "t", struct("k string, v int"), key="k")
    upsert_table(lake, "silver", "t", stage(spark.range(500).selectExpr("cast(id as string) k", "0 v")), ["k"])
    before = files(lake, "silver", "t")
    upsert_table(lake, "silver", "t", stage(frame("k string, v int, w int", ("3", 1, 2), ("new", 1, 2))), ["k"])
    after = files(lake, "silver", "t")
    assert len({os.path.basename(os.path.dirname(f)) for f in before - after}) == 1
    got = lake.read_layer("silver", "t")
    assert got.count() == 501 and rows(got.filter("v = 1")) == [("3", 1, 2), ("new", 1, 2)]
    upsert_table(lake, "silver", "t", stage(frame("k string, v int")), ["k"])
    assert files(lake, "silver", "t") == after


def test_stream_batches_of_new_keys_are_appended(spark, lake, tmp_path):
    schema = struct("id string, v int")
    lake.ensure_table("silver", "t", struct("id string, v int"), key="id")

    def run():
        arrivals = with_audit(csv_stream(spark, str(tmp_path / "in"), schema), T1)
        stream_upsert(lake, "t", arrivals, lambda batch: batch, ["id"], str(tmp_path / "checkpoint"))
        return files(lake, "silver", "t")

    deliver(tmp_path / "in", "1.csv", "id,v", "a,1", "b,1", "a,2")
    first = run()
    deliver(tmp_path / "in", "2.csv", "id,v", "c,1", "d,1")
    second = run()
    assert first < second
    for name in ("1", ".1.crc"):  # the record that the batch ended is lost: it is offered again
        os.remove(tmp_path / "checkpoint" / "commits" / name)
    lake.set_properties("silver", "t", **{k: 0 for k in lake.properties("silver", "t") if k.startswith("stream")})
    run()  # and so is the note in the table: it is merged again
    assert rows(lake.read_layer("silver", "t"), "id", "v") == [("a", 2), ("b", 1), ("c", 1), ("d", 1)]


@pytest.mark.parametrize("numbers", [range(40), range(0, 40, 3)])
def test_many_corrections_are_written_once(shop, conf, monkeypatch, numbers):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    run_gold(shop, T1, **DAYS)
    shop.arrive("2.csv", *(sale(n, quantity=9) for n in numbers), sale(50), sale(51, price="-1"))
    run_silver(shop)
    labels, stage_as = [], gold_plan.stage

    def staged(rows, label="staged", codec=None):
        labels.append(label)
        return stage_as(rows, label, codec)

    monkeypatch.setattr(gold_plan, "stage", staged)
    run_gold(shop, T2, **DAYS)
    assert [label for label in labels if label != "changed-sales"] in ([], ["fact-lines"])
    if len(numbers) == 40:  # each bucket with a sale has one to replace, so the lines go where they belong
        assert "new-sales" not in labels
    made = shop.read_layer("gold", "fact_sales")
    wanted = {f"S{n}": 9 if n in numbers else 2 for n in range(40)} | {"S50": 2}
    assert rows(made, "sale_id", "quantity") == sorted(wanted.items())
    changed = {f"S{n}" for n in numbers} | {"S50"}
    assert {r[0] for r in made.filter(F.col("load_ts") == T2).select("sale_id").collect()} == changed
    before = files(shop, "gold", "fact_sales")
    run_gold(shop, T3, full=True, **DAYS)  # nothing has changed since
    assert files(shop, "gold", "fact_sales") == before


def test_many_corrections_of_a_repeated_sale_replace_all_its_rows(shop, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    run_gold(shop, T1, **DAYS)
    shop.arrive("2.csv", sale(3, quantity=9), sale(4), sale(4))
    run_silver(shop, sales="append")
    run_gold(shop, T2, **DAYS)
    got = shop.read_layer("gold", "fact_sales").filter(F.col("sale_id").isin("S3", "S4", "S5"))
    assert rows(got, "sale_id", "quantity") == [("S3", 2), ("S3", 9), ("S4", 2), ("S5", 2)]


def test_a_first_load_is_not_staged(shop, monkeypatch):
    shop.clear_tables()
    labels = []
    monkeypatch.setattr(silver_plan, "stage", lambda rows, label="staged", codec=None: labels.append(label) or stage(rows, label, codec))
    run_silver(shop)
    assert labels == ["employee"] or labels == []
    assert shop.read_layer("silver", "sales_clean").count() == 40
    assert shop.read_layer("silver", "customer_clean").count() == 2


def test_corrected_sales_alone_make_the_new_lines(shop, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    run_gold(shop, T1, **DAYS)
    shop.arrive("2.csv", *(sale(n, quantity=9) for n in range(0, 40, 3)))
    run_silver(shop)
    seen, made = [], gold_plan.fact_sales
    monkeypatch.setattr(gold_plan, "fact_sales", lambda sales, *a, **k: seen.append(plan(sales)) or made(sales, *a, **k))
    run_gold(shop, T2, **DAYS)
    # Neither are sales picked by id from all of silver, nor those looked at that no load has written since.
    assert len(seen) == 1 and "LeftSemi" not in seen[0] and "_load" in seen[0]
    wanted = {f"S{n}": 9 if n % 3 == 0 else 2 for n in range(40)}
    assert rows(shop.read_layer("gold", "fact_sales"), "sale_id", "quantity") == sorted(wanted.items())


def test_loads_of_some_buckets_after_others_give_the_same(shop, conf, monkeypatch):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    shop.clear_tables()
    shop.at_once = 1  # bytes: each bucket by itself
    written = []
    for name in ("append_rows", "replace_buckets"):
        write = getattr(Lakehouse, name)
        monkeypatch.setattr(
            Lakehouse, name, lambda self, layer, table, *a, _w=write, **k: written.append((layer, table)) or _w(self, layer, table, *a, **k)
        )
    run_silver(shop)
    run_gold(shop, T1, **DAYS)
    assert written.count(("gold", "fact_sales")) == 8
    shop.arrive("2.csv", *(sale(n, quantity=9) for n in range(0, 40, 3)), sale(50), sale(51, price="-1"))
    written.clear()
    run_silver(shop)
    assert written.count(("silver", "sales_clean")) > 1
    run_gold(shop, T2, **DAYS)
    wanted = {f"S{n}": 9 if n % 3 == 0 else 2 for n in range(40)} | {"S50": 2}
    got = shop.read_layer("gold", "fact_sales")
    assert rows(got, "sale_id", "quantity") == sorted(wanted.items())
    assert got.filter(F.col("load_ts") == T2).count() == 15
    # Sales that no load has written since make lines of a changed sale too.
    shop.arrive("3.csv", sale(4, quantity=7), sale(5, quantity=8), at=T3)
    run_silver(shop, sales="append")
    run_gold(shop, T3, **DAYS)
    found = shop.read_layer("gold", "fact_sales").filter(F.col("sale_id").isin("S4", "S5", "S6"))
    assert rows(found, "sale_id", "quantity") == [("S4", 2), ("S4", 7), ("S5", 2), ("S5", 8), ("S6", 9)]


def test_a_sliced_first_load_that_fails_is_made_up_for(shop, monkeypatch):
    shop.at_once = 1
    append, calls = Lakehouse.append_rows, []

    def failing(self, layer, table, *a, **k):
        if table == "fact_sales":
            calls.append(table)
            if len(calls) == 3:
                raise RuntimeError("killed")
        append(self, layer, table, *a, **k)

    with monkeypatch.context() as broken:
        broken.setattr(Lakehouse, "append_rows", failing)
        with pytest.raises(RuntimeError, match="killed"):
            run_gold(shop, T1, **DAYS)
    run_gold(shop, T2, **DAYS)
    got = shop.read_layer("gold", "fact_sales")
    assert got.count() == got.select("sale_id").distinct().count() == 40


def test_buckets_that_moved_can_be_dropped(shop):
    run_gold(shop, T1, **DAYS)
    shop.arrive("2.csv", sale(7, quantity=9))
    run_silver(shop)
    run_gold(shop, T2, **DAYS)
    tables = [("silver", "sales_clean"), ("gold", "fact_sales")]
    content = [rows(shop.read_layer(*t)) for t in tables]
    dropped = shop.drop_unused(datetime.now() + timedelta(minutes=1), tables)
    assert len([p for p in dropped if "/initial/_bucket=" in p]) == 2  # the table's first folder is still in use
    assert not any(os.path.exists(p) for p in dropped)
    assert [rows(shop.read_layer(*t)) for t in tables] == content
    shop.arrive("3.csv", sale(7, quantity=5), sale(60), at=T3)
    run_silver(shop)
    run_gold(shop, T3, **DAYS)
    assert [r[-1] for r in fact(shop, "S60", "S7")] == [2, 5]
