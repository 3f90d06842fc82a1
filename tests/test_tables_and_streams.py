import os
import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from stratalake.operators import dim_date, raw_file_distinct
from stratalake.operators.merge import merge_upsert
from stratalake.plans import run_bronze, run_gold, run_silver
from stratalake.schemas import GOLD, SILVER, bronze_schema, landing_schema, struct
from stratalake.sources import read_csv_batch, scratch_root
from stratalake.streaming import csv_stream, ingest_stream, read_evolved, stream_upsert, with_audit

T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def deliver(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    return str(folder)


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    assert scratch_root(spark).startswith(shared.rstrip("/"))


def test_table_life(lake, frame):
    lake.ensure_table("silver", "t", struct("a int, b string"))
    lake.ensure_table("silver", "t", struct("a int, b string"))
    assert lake.read_layer("silver", "t").count() == 0
    lake.append_rows("silver", "t", frame("b string, a int", ("x", 1)))
    lake.append_rows("silver", "t", frame("a int, c int", (2, 9)))
    assert rows(lake.read_layer("silver", "t")) == [(1, "x", None), (2, None, 9)]
    before = lake.location("silver", "t")
    current = lake.read_layer("silver", "t")
    lake.overwrite_table("silver", "t", current.filter("a = 2").withColumn("d", F.lit(True)))
    assert rows(lake.read_layer("silver", "t")) == [(2, None, 9, True)]
    assert lake.location("silver", "t") != before


def test_failed_load_leaves_the_table_as_it_was(lake, frame):
    lake.ensure_table("silver", "t", struct("a int"))
    lake.append_rows("silver", "t", frame("a int", (1,)))
    failing = lake.read_layer("silver", "t").withColumn("a", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        lake.overwrite_table("silver", "t", failing.withColumn("b", F.lit(1)))
    assert lake.read_layer("silver", "t").columns == ["a"]
    assert rows(lake.read_layer("silver", "t")) == [(1,)]


def test_clear_goes_on_after_an_error(lake, frame):
    lake.ensure_table("silver", "t", struct("a int"))
    lake.append_rows("silver", "t", frame("a int", (1,)))
    outcome = lake.clear_tables([("silver", "missing"), ("silver", "t")])
    assert [error is None for error in outcome.values()] == [False, True]
    cleared = lake.read_layer("silver", "t")
    assert cleared.count() == 0 and cleared.columns == ["a"]


def test_nineteen_tables_are_there_and_clear_covers_silver_and_gold(lake, spark):
    lake.ensure_layers()
    made = [t.name for layer in ("raw", "silver", "gold") for t in spark.catalog.listTables(f"{lake.prefix}_{layer}") if not t.isTemporary]
    assert len(made) == 19 and lake.read_layer("raw", "sales_raw").count() == 0
    outcome = lake.clear_tables()
    assert len(outcome) == 13 and set(outcome.values()) == {None}


def test_calendar_overwrites(lake, spark):
    lake.ensure_table("gold", "dim_date", struct(GOLD["dim_date"]))
    for _ in range(2):
        lake.overwrite_table("gold", "dim_date", dim_date(spark, "2024-01-01", "2024-01-03"))
    assert lake.read_layer("gold", "dim_date").count() == 3


def test_csv_batch(spark, tmp_path):
    path = deliver(tmp_path / "in", "a.csv", "id,day", "1,2024-01-01", "x,never")
    assert read_csv_batch(spark, path).dtypes == [("id", "string"), ("day", "string")]
    typed = read_csv_batch(spark, path, struct("id int, day date"))
    assert rows(typed) == [(1, date(2024, 1, 1)), (None, None)]


def test_raw_file_counts_the_header_as_data(spark, tmp_path):
    path = deliver(tmp_path / "in", "a.csv", "id,shop", "1,b", "2,a", "3,b", "4,")
    got = raw_file_distinct(spark, path + "/a.csv", 1)
    assert [r[0] for r in got.collect()] == ["shop", "b", "a", None]
    assert [r[0] for r in raw_file_distinct(spark, path, 1, rows=2).collect()] == ["shop", "b"]


def store_run(spark, tmp_path, ts=T1):
    paths = [str(tmp_path / p) for p in ("in", "table", "checkpoint")]
    ingest_stream(spark, *paths, landing_schema("store"), bronze_schema("store"), ingest_ts=ts)
    return spark.read.parquet(paths[1])


def test_each_file_is_ingested_once_with_its_name(spark, tmp_path):
    deliver(tmp_path / "in", "one.csv", "store_id,store_name,city", "1,a,b")
    assert rows(store_run(spark, tmp_path)) == [("1", "a", "b", "one.csv", datetime(2024, 1, 1))]
    assert store_run(spark, tmp_path).count() == 1
    deliver(tmp_path / "in", "two.csv", "store_id,store_name,city", "2,a,b")
    got = store_run(spark, tmp_path, T2)
    assert rows(got, "store_id", "source_file", "imported_date") == [
        ("1", "one.csv", datetime(2024, 1, 1)),
        ("2", "two.csv", datetime(2024, 2, 1)),
    ]


def test_backlog_in_batches(lake, tmp_path):
    for n in range(3):
        folder = deliver(tmp_path / "in", f"{n}.csv", "store_id,store_name,city", f"{n},a,b")
    run_bronze(lake, {"store": folder}, max_files_per_batch=1)
    got = lake.read_layer("raw", "store")
    assert got.count() == 3 and got.select("imported_date").distinct().count() == 3


def test_bad_cells_read_as_null_and_stored_types_win(lake, tmp_path):
    header = "sale_id,sale_ts,customer_id,product_id,store_id,employee_id,quantity,unit_price,coupon_code,discount_percent,mode"
    folder = deliver(
        tmp_path / "in", "s.csv", header,
        "1,2024-01-01 10:00:00,c,p,s,e,two,10.005,x,5,Online",
        "2,not a time,c,p,s,e,2,9.99,x,,Online",
    )
    run_bronze(lake, {"sales_raw": folder}, T1)
    got = lake.read_layer("raw", "sales_raw")
    assert got.schema.simpleString() == bronze_schema("sales_raw").simpleString()
    picked = [tuple(map(str, r)) for r in got.orderBy("sale_id").select("quantity", "unit_price", "sale_ts").collect()]
    assert picked == [("None", "10.01", "2024-01-01 10:00:00"), ("2", "9.99", "None")]


def test_employee_days_are_stored_as_times_and_yes_words_do_not_parse(lake, tmp_path):
    header = "employee_id,employee_code,store_id,store_name,effective_from,effective_to,is_current,is_primary"
    folder = deliver(tmp_path / "in", "e.csv", header, "1,c,2,s,2024-01-01,,True,yes")
    run_bronze(lake, {"employee": folder}, T1)
    row = lake.read_layer("raw", "employee").first()
    assert (row.effective_from, row.effective_to) == (datetime(2024, 1, 1), None)
    assert (row.is_current, row.is_primary) == (True, None)


def test_new_columns_are_null_in_older_files(spark, tmp_path):
    folder, table, checkpoint = (str(tmp_path / p) for p in ("in", "table", "checkpoint"))
    deliver(folder, "one.csv", "id", "1")
    ingest_stream(spark, folder, table, checkpoint, struct("id int"), ingest_ts=T1)
    deliver(folder, "two.csv", "id,extra", "2,b")
    ingest_stream(spark, folder, table, checkpoint, struct("id int, extra string"), ingest_ts=T1)
    assert rows(read_evolved(spark, table), "id", "extra") == [(1, None), (2, "b")]
    wide = struct("id int, extra string, later date")
    assert rows(read_evolved(spark, table, wide)) == [(1, None, None), (2, "b", None)]


def test_stream_upsert_survives_a_repeated_batch(spark, lake, tmp_path):
    schema = struct("id string, v int")
    lake.ensure_table("silver", "t", struct("id string, v int, source_file string, imported_date timestamp"))

    def run(checkpoint):
        arrivals = with_audit(csv_stream(spark, str(tmp_path / "in"), schema), T1)
        stream_upsert(lake, "t", arrivals, lambda batch: batch, ["id"], str(tmp_path / checkpoint))
        return rows(lake.read_layer("silver", "t"), "id", "v")

    deliver(tmp_path / "in", "1.csv", "id,v", "a,1", "b,1", "a,2")
    assert run("one") == [("a", 2), ("b", 1)]
    # Lose the record that the batch ended: it is offered again, and is done already.
    merged = lake.location("silver", "t")
    for name in ("0", ".0.crc"):
        os.remove(tmp_path / "one" / "commits" / name)
    assert run("one") == [("a", 2), ("b", 1)]
    assert lake.location("silver", "t") == merged
    deliver(tmp_path / "in", "2.csv", "id,v", "b,7", "c,1")
    assert run("one") == [("a", 2), ("b", 7), ("c", 1)]


def test_first_batch_of_another_stream_is_not_taken_for_a_repeat(spark, lake, tmp_path):
    schema = struct("id string, v int")
    lake.ensure_table("silver", "t", struct("id string, v int, source_file string, imported_date timestamp"))
    for n, folder in enumerate(("first", "second")):
        deliver(tmp_path / folder, "1.csv", "id,v", f"{folder},{n}")
        arrivals = with_audit(csv_stream(spark, str(tmp_path / folder), schema), T1)
        stream_upsert(lake, "t", arrivals, lambda batch: batch, ["id"], str(tmp_path / f"checkpoint-{n}"))
    assert rows(lake.read_layer("silver", "t"), "id", "v") == [("first", 0), ("second", 1)]


@pytest.fixture
def landing(tmp_path):
    return {
        "customer": deliver(
            tmp_path / "customer", "c.csv", "customer_id,customer_name,gender,age,email,phone_number,city,loyalty_tier",
            "C1,anna lee,f,30,A@X.org,+1 (2),rome,gold", "C2,bo,m,40,b@x.org,3,oslo,silver",
        ),
        "employee": deliver(
            tmp_path / "employee", "e.csv",
            "employee_id,employee_code,store_id,store_name,effective_from,effective_to,is_current,is_primary",
            "1,E1,1,mart,2024-01-01,2024-01-31,False,False", "1,E1,2,shop,2024-02-01,,True,True",
        ),
        "product": deliver(
            tmp_path / "product", "p.csv", "product_id,product_name,supplier_id,supplier_name,return_policy,warranty",
            "1,tv,1,acme,7 Days,1 Year", "1,tv,2,bolt,7 Days,1 Year",
        ),
        "store": deliver(tmp_path / "store", "s.csv", "store_id,store_name,city", "1,mart,rome", "1,mart,oslo"),
        "supplier": deliver(tmp_path / "supplier", "u.csv", "supplier_id,supplier_name", "1,acme"),
        "sales_raw": deliver(
            tmp_path / "sales", "x.csv",
            "sale_id,sale_ts,customer_id,product_id,store_id,employee_id,quantity,unit_price,coupon_code,discount_percent,mode",
            "1,2024-03-01 10:00:00,C1,1,1,1,2,10.50,X,10,Online", "2,2024-03-02 10:00:00,C9,1,1,9,1,5.00,X,,In-Store",
            "3,2024-03-02 10:00:00,C1,1,1,1,0,5.00,X,0,In-Store",
        ),
    }


def files(lake, layer, table):
    return set(lake.read_layer(layer, table).inputFiles())


def layer_sizes(lake):
    tables = [("silver", t) for t in SILVER] + [("gold", t) for t in GOLD if t != "dim_date"]
    return {t: lake.read_layer(layer, t).count() for layer, t in tables}


def test_all_layers_twice(lake, landing):
    for ts in (T1, T2):
        run_bronze(lake, landing, T1)
        run_silver(lake)
        run_gold(lake, ts, first_day="2024-01-01", last_day="2024-12-31")
        assert layer_sizes(lake) == {
            "customer_clean": 2, "product_clean": 1, "store_clean": 1, "supplier_clean": 1,
            "employee_clean_history": 2, "sales_clean": 2, "dim_customer": 2, "dim_employee": 1,
            "dim_product": 1, "dim_store": 1, "dim_supplier": 1, "fact_sales": 2,
        }
    fact = lake.read_layer("gold", "fact_sales")
    assert [tuple(map(str, r)) for r in fact.orderBy("sale_id").drop("employee_sk", "load_ts").collect()] == [
        ("1", "20240301", "1", "1", "1", "2", "10.50", "2.10", "21.00", "18.90"),
        ("2", "20240302", "None", "1", "1", "1", "5.00", "0.00", "5.00", "5.00"),
    ]
    employee = lake.read_layer("gold", "dim_employee").first()
    assert (employee.store_id, employee.store_name) == ("2", "Shop")
    for layer, tables in (("silver", SILVER), ("gold", GOLD)):
        for table, columns in tables.items():
            assert lake.read_layer(layer, table).schema == struct(columns), table


def test_changed_customer_gets_a_version_and_append_mode_repeats(lake, landing, tmp_path):
    run_bronze(lake, landing, T1)
    run_silver(lake, sales="append")
    run_gold(lake, T1, fact="append", first_day="2024-01-01", last_day="2024-12-31")
    deliver(
        tmp_path / "customer", "c2.csv", "customer_id,customer_name,gender,age,email,phone_number,city,loyalty_tier",
        "C1,anna lee,f,31,A@X.org,+1 (2),rome,gold",
    )
    run_bronze(lake, landing, T2)
    run_silver(lake, sales="append", since=T1)
    run_gold(lake, T2, fact="append", first_day="2024-01-01", last_day="2024-12-31")
    versions = rows(lake.read_layer("gold", "dim_customer"), "customer_sk", "customer_id", "age", "is_current")
    assert versions == [(1, "C1", 30, False), (2, "C2", 40, True), (3, "C1", 31, True)]
    assert lake.read_layer("silver", "sales_clean").count() == 2
    assert lake.read_layer("gold", "fact_sales").count() == 4


def test_new_sales_are_appended_and_repeated_ones_replace(lake, landing, tmp_path):
    run_bronze(lake, landing, T1)
    run_silver(lake)
    run_gold(lake, T1, first_day="2024-01-01", last_day="2024-12-31")
    header = open(tmp_path / "sales" / "x.csv").readline().strip()
    before = files(lake, "silver", "sales_clean")
    for name, ts, sale, kept in (
        ("y.csv", T2, "4,2024-03-05 10:00:00,C2,1,1,1,1,7.00,X,0,Online", True),
        ("z.csv", "2024-03-01 00:00:00", "4,2024-03-05 10:00:00,C2,1,1,1,9,7.00,X,0,Online", False),
    ):
        deliver(tmp_path / "sales", name, header, sale)
        run_bronze(lake, landing, ts)
        since = T1 if kept else T2
        run_silver(lake, since=since)
        run_gold(lake, ts, first_day="2024-01-01", last_day="2024-12-31", since=since)
        assert (before <= files(lake, "silver", "sales_clean")) is kept
        before = files(lake, "silver", "sales_clean")
    assert rows(lake.read_layer("silver", "sales_clean"), "sale_id", "quantity") == [("1", 2), ("2", 1), ("4", 9)]
    places = {t: files(lake, "silver", t) for t in SILVER}
    run_silver(lake, since="2024-03-01 00:00:00")  # nothing arrived since
    assert {t: files(lake, "silver", t) for t in SILVER} == places
    fact = lake.read_layer("gold", "fact_sales")
    assert rows(fact, "sale_id", "quantity") == [("1", 2), ("2", 1), ("4", 9)]
    assert [str(r["gross_amt"]) for r in fact.filter("sale_id = '4'").collect()] == ["63.00"]


def test_an_older_arrival_does_not_replace_a_newer_one(frame):
    columns = "sale_id string, quantity int, imported_date timestamp, source_file string"
    target = frame(columns, ("1", 9, datetime(2024, 3, 1), "b"), ("2", 1, datetime(2024, 1, 1), "a"), ("3", 5, None, "a"))
    late = frame(columns, ("1", 2, datetime(2023, 3, 1), "c"), ("2", 7, datetime(2024, 1, 1), "b"), ("3", 6, datetime(2024, 1, 1), "a"))
    merged = merge_upsert(target, late, ["sale_id"], newer_by=("imported_date", "source_file"))
    assert rows(merged, "sale_id", "quantity") == [("1", 9), ("2", 7), ("3", 6)]


def test_options_are_checked(lake):
    with pytest.raises(ValueError):
        run_silver(lake, sales="replace")
    with pytest.raises(ValueError):
        run_gold(lake, T1, fact="replace")
