"""Queries over the given tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import feeds
from checks.feeds import (
    BALANCE_SPLIT,
    CUSTOMERS_SPLIT,
    EMPLOYEES_SPLIT,
    PRODUCTS_SPLIT,
    SALES_SPLIT,
)
from stratalake import operators as ops
from stratalake.operators.facts import valid_lines
from stratalake.functions import hashdiff, norm_key, norm_lower, norm_phone, norm_title, norm_upper
from stratalake.functions import parse_bool, sales_amounts
from stratalake.plans import (
    customer_snapshot,
    load_dim_customer,
    load_dim_employee,
    load_dim_type_1,
    load_silver_entity,
    run_bronze,
    run_gold,
    run_silver,
    sales_upsert_latest,
)
from stratalake.plans.together import run_together
from stratalake.schemas import CODEC, GOLD, LANDING, SILVER, struct
from stratalake.sources import Lakehouse, exchanged, read_csv_batch, scratch_path, shuffles_dropped, stage
from stratalake.sources.files import delete_folder
from stratalake.streaming import csv_stream, ingest_stream, read_evolved, stream_upsert, with_audit

FIRST_LOAD = "2024-03-01 00:00:00"
SECOND_LOAD = "2024-04-01 00:00:00"
INGEST_TIME = "2024-02-01 00:00:00"
CORRECTION_TIME = "2024-02-15 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def empty(spark: SparkSession, columns: str) -> DataFrame:
    return spark.createDataFrame([], struct(columns))


def as_text(rows: DataFrame, *columns: str) -> DataFrame:
    """Dates and times as text: the year 9999 does not fit every reader."""
    shown = {
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss" if dict(rows.dtypes)[c] == "timestamp" else "yyyy-MM-dd")
        for c in columns
    }
    return rows.withColumns(shown)


# --- inputs used by several queries -----------------------------------------


def customers(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    """Clean customers of the first or second delivery."""
    period = {"until": CUSTOMERS_SPLIT} if load == 1 else {"since": CUSTOMERS_SPLIT}
    return ops.clean_customer(feeds.customer_feed(spark, sf_dir, **period))


def employees(spark: SparkSession, sf_dir: str, load: int) -> DataFrame:
    period = {"until": EMPLOYEES_SPLIT} if load == 1 else {"since": EMPLOYEES_SPLIT}
    return ops.clean_employee_history(feeds.employee_feed(spark, sf_dir, **period))


def sales(spark: SparkSession, sf_dir: str, **period: str) -> DataFrame:
    return ops.clean_sales(feeds.sales_feed(spark, sf_dir, **period))


def history(spark: SparkSession, sf_dir: str, loads: int) -> DataFrame:
    rows = empty(spark, SILVER["employee_clean_history"])
    for load in range(1, loads + 1):
        rows = ops.history_apply(rows, stage(employees(spark, sf_dir, load)))
    return rows


def silver(spark: SparkSession, sf_dir: str, table: str, load: int = 2) -> DataFrame:
    """A silver dimension table after one or both deliveries."""
    deliveries = {
        "customer_clean": lambda n: feeds.customer_feed(
            spark, sf_dir, **({"until": CUSTOMERS_SPLIT} if n == 1 else {"since": CUSTOMERS_SPLIT})
        ),
        "product_clean": lambda n: feeds.product_feed(
            spark, sf_dir, **({"until": PRODUCTS_SPLIT} if n == 1 else {"since": PRODUCTS_SPLIT})
        ),
        "store_clean": lambda n: feeds.store_feed(spark, sf_dir, BALANCE_SPLIT if n == 1 else None),
        "supplier_clean": lambda n: feeds.supplier_feed(spark, sf_dir, BALANCE_SPLIT if n == 1 else None),
    }[table]
    rows = empty(spark, SILVER[table])
    for n in range(1, load + 1):
        rows = load_silver_entity(rows, deliveries(n), table)
    return rows


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = empty(spark, GOLD["dim_customer"])
    rows = stage(load_dim_customer(rows, customers(spark, sf_dir, 1), FIRST_LOAD))
    return load_dim_customer(rows, customers(spark, sf_dir, 2), SECOND_LOAD)


def dim_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = empty(spark, GOLD["dim_employee"])
    first = stage(history(spark, sf_dir, 1))
    rows = stage(load_dim_employee(rows, first, FIRST_LOAD))
    second = ops.history_apply(first, stage(employees(spark, sf_dir, 2)))
    return load_dim_employee(rows, second, SECOND_LOAD)


def dim_type_1(spark: SparkSession, sf_dir: str, table: str, source: str) -> DataFrame:
    """A type 1 dimension loaded after the first and after the second delivery."""
    first = stage(silver(spark, sf_dir, source, 1))
    rows = stage(load_dim_type_1(empty(spark, GOLD[table]), first, table, FIRST_LOAD))
    return load_dim_type_1(rows, silver(spark, sf_dir, source, 2), table, SECOND_LOAD)


def dim_whole_feed(spark: SparkSession, sf_dir: str, table: str, source: str) -> DataFrame:
    """A type 1 dimension loaded once, from the whole feed."""
    feed = {"product_clean": feeds.product_feed, "store_clean": feeds.store_feed}[source]
    clean = load_silver_entity(empty(spark, SILVER[source]), feed(spark, sf_dir), source)
    return load_dim_type_1(empty(spark, GOLD[table]), clean, table, SECOND_LOAD)


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    bounds = feeds.table(spark, sf_dir, "orders").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
    return ops.calendar_between(bounds)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, employee, product, store = run_together(
        spark,
        [
            lambda: dim_customer(spark, sf_dir),
            lambda: dim_employee(spark, sf_dir),
            lambda: dim_whole_feed(spark, sf_dir, "dim_product", "product_clean"),
            lambda: dim_whole_feed(spark, sf_dir, "dim_store", "store_clean"),
        ],
    )
    calendar = order_calendar(spark, sf_dir)
    return ops.fact_sales(
        sales(spark, sf_dir), calendar, customer, employee, product, store, SECOND_LOAD
    )


def spread(feed: Callable[..., DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed in many tasks: its lines are dealt while they are narrow, unless its joins deal them anyway."""
    rows = feed(spark, sf_dir)
    return rows if exchanged(rows) else feed(spark, sf_dir, dealt=True)


def land(rows: DataFrame, label: str) -> str:
    """Write rows as packed CSV files with a header, as many as their size asks for, and return the folder.

    The given tables are one file and one row group each, so rows that no
    exchange has dealt out would be one file however large. Dealing by all
    columns needs no sort, as dealing them in turn does.
    """
    path = scratch_path(rows.sparkSession, label)
    dealt = rows if exchanged(rows) else rows.repartition(*rows.columns)
    deliver(dealt, path)
    return path


def deliver(rows: DataFrame, folder: str) -> None:
    """Add rows to a folder as CSV files, packed quickly: they are read once."""
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    rows.write.mode("append").option("header", True).options(**packed).csv(folder)


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time as text, so that CSV keeps the microseconds."""
    return feeds.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))


EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


# --- text and money ---------------------------------------------------------


@query
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every normaliser over whole document texts."""
    text = F.col("text")
    return feeds.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.sha2(norm_key(text), 256).alias("trimmed"),
        F.sha2(norm_upper("lang"), 256).alias("upper_lang"),
        F.sha2(norm_lower("source"), 256).alias("lower_source"),
        F.sha2(norm_title("source"), 256).alias("title_source"),
        F.sha2(norm_upper(text), 256).alias("upper_text"),
        F.sha2(norm_lower(text), 256).alias("lower_text"),
        F.sha2(norm_title(text), 256).alias("title_text"),
        F.sha2(norm_phone(text), 256).alias("digits"),
        parse_bool(F.col("n_chars") > 500).alias("is_long"),
        parse_bool("lang").alias("is_yes_word"),
        # Letters, digits and signs; 1, t and y, in either case, are yes-words.
        parse_bool(F.substring(text, 1, 1)).alias("starts_with_yes_word"),
    )


@query
def sales_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.table(spark, sf_dir, "lineitem")
    amounts = sales_amounts("l_quantity", "l_extendedprice", F.col("l_discount") * 100)
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *(c.alias(n) for n, c in amounts.items())
    )


@query
def hashdiff_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = ops.clean_customer(feeds.customer_feed(spark, sf_dir))
    return customer_snapshot(whole).select("customer_id", "hashdiff")


# --- cleaning and dedupe ----------------------------------------------------


@query
def clean_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_customer(feeds.customer_feed(spark, sf_dir))


@query
def clean_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_product(feeds.product_feed(spark, sf_dir))


@query
def clean_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_store(feeds.store_feed(spark, sf_dir))


@query
def clean_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_supplier(feeds.supplier_feed(spark, sf_dir))


@query
def clean_employee_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(
        ops.clean_employee_history(feeds.employee_feed(spark, sf_dir)), "effective_from", "effective_to"
    )


@query
def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir)


@query
def dedupe_latest_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dedupe_latest(sales(spark, sf_dir), ["sale_id"])


@query
def silver_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir, "customer_clean")


@query
def silver_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir, "product_clean")


@query
def silver_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir, "store_clean")


@query
def silver_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir, "supplier_clean")


# --- merge ------------------------------------------------------------------


@query
def merge_upsert_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.merge_upsert(customers(spark, sf_dir, 1), customers(spark, sf_dir, 2), ["customer_id"])


@query
def merge_upsert_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target has a column of its own and the source brings a new one."""
    target = customers(spark, sf_dir, 1).withColumn("first_load", F.lit(FIRST_LOAD))
    source = customers(spark, sf_dir, 2).withColumn("district", F.concat("city", F.lit("/"), "gender"))
    return ops.merge_upsert(target, source, ["customer_id"])


@query
def merge_update_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.merge_update(
        customers(spark, sf_dir, 1), customers(spark, sf_dir, 2), ["customer_id"], ["loyalty_tier"]
    )


@query
def insert_missing_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.insert_missing(customers(spark, sf_dir, 1), customers(spark, sf_dir, 2), ["customer_id"])


@query
def new_keys_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.new_keys(customers(spark, sf_dir, 1), customers(spark, sf_dir, 2), ["customer_id"])


@query
def sales_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = sales_upsert_latest(
        empty(spark, SILVER["sales_clean"]), sales(spark, sf_dir, until=SALES_SPLIT), unique_target=True
    )
    return sales_upsert_latest(stage(first, codec=CODEC), sales(spark, sf_dir, since=SALES_SPLIT), unique_target=True)


@query
def sales_upsert_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older deliveries come second: the newest arrival stays though it was loaded first."""
    first = sales_upsert_latest(
        empty(spark, SILVER["sales_clean"]), sales(spark, sf_dir, since=SALES_SPLIT), unique_target=True
    )
    return sales_upsert_latest(stage(first, codec=CODEC), sales(spark, sf_dir, until=SALES_SPLIT), unique_target=True)


@query
def merge_upsert_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves merged as one sorted pass over target and source, whatever their size."""
    first = stage(ops.dedupe_latest(sales(spark, sf_dir, until=SALES_SPLIT), ["sale_id"]), codec=CODEC)
    second = stage(ops.dedupe_latest(sales(spark, sf_dir, since=SALES_SPLIT), ["sale_id"]), codec=CODEC)
    return ops.merge_sorted(first, second, ["sale_id"])


@query
def table_upsert_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves upserted into a table dealt by sale id: new keys appended, buckets with known ones rewritten."""
    root = scratch_path(spark, "table-upsert")
    lake = Lakehouse(spark, root, prefix="sales_" + root.rsplit("-", 1)[1], buckets=32)
    lake.ensure_table("silver", "sales_clean", struct(SILVER["sales_clean"]), key="sale_id")
    for period in ({"until": SALES_SPLIT}, {"since": SALES_SPLIT}):
        newest = stage(ops.dedupe_latest(sales(spark, sf_dir, **period), ["sale_id"]), codec=CODEC)
        ops.upsert_table(lake, "silver", "sales_clean", newest, ["sale_id"])
    return lake.read_layer("silver", "sales_clean")


@query
def kept_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned till lines: those without an id, a quantity above 0 or a price are left out."""
    return ops.clean_sales(feeds.returns_feed(spark, sf_dir))


@query
def kept_fact_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Till lines that the fact takes, which allows a quantity of 0."""
    return valid_lines(feeds.returns_feed(spark, sf_dir)).select("sale_id", "product_id", "quantity", "unit_price", "mode")


@query
def kept_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row per customer; rows without an id are left out."""
    return ops.dedupe_latest(ops.clean_customer(feeds.unnamed_customers(spark, sf_dir)), ["customer_id"])


@query
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows delivered and rejected by each rule."""
    till, unnamed = feeds.returns_feed(spark, sf_dir), feeds.unnamed_customers(spark, sf_dir)
    rules = {
        "silver sales": (till, ops.clean_sales),
        "fact lines": (till, valid_lines),
        "customer keys": (unnamed, lambda rows: ops.dedupe_latest(ops.clean_customer(rows), ["customer_id"])),
    }
    both = {f"{n}, delivered": rows for n, (rows, _) in rules.items()} | {
        f"{n}, kept": keep(rows) for n, (rows, keep) in rules.items()
    }
    return ops.layer_counts(both)


@query
def append_sales_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sales(spark, sf_dir)
    return ops.append_rows(lines, lines)


# --- history ----------------------------------------------------------------


@query
def history_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = ops.history_insert(
        empty(spark, SILVER["employee_clean_history"]), employees(spark, sf_dir, 1)
    )
    return as_text(
        ops.history_insert(first, employees(spark, sf_dir, 2)), "effective_from", "effective_to"
    )


@query
def history_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = stage(history(spark, sf_dir, 1))
    return as_text(
        ops.history_close(first, stage(employees(spark, sf_dir, 2))), "effective_from", "effective_to"
    )


@query
def history_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(history(spark, sf_dir, 2), "effective_from", "effective_to")


# --- keys and dimensions ----------------------------------------------------


@query
def max_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.max_surrogate_key(feeds.table(spark, sf_dir, "orders"), "o_orderkey")


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), "o_custkey"
    )
    base = ops.max_surrogate_key(feeds.table(spark, sf_dir, "customer"), "c_custkey")
    return ops.assign_surrogate_keys(orders, "order_sk", ["order_id"], base)


@query
def scd1_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_type_1(spark, sf_dir, "dim_product", "product_clean")


@query
def scd1_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_type_1(spark, sf_dir, "dim_store", "store_clean")


@query
def scd1_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_type_1(spark, sf_dir, "dim_supplier", "supplier_clean")


@query
def scd2_changes_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = load_dim_customer(empty(spark, GOLD["dim_customer"]), customers(spark, sf_dir, 1), FIRST_LOAD)
    return ops.scd2_changes(
        dim, customer_snapshot(customers(spark, sf_dir, 2)), "customer_id", ["hashdiff"]
    )


@query
def scd2_close_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = stage(
        load_dim_customer(empty(spark, GOLD["dim_customer"]), customers(spark, sf_dir, 1), FIRST_LOAD)
    )
    changed = ops.scd2_changes(
        dim, customer_snapshot(customers(spark, sf_dir, 2)), "customer_id", ["hashdiff"]
    )
    closed = ops.scd2_close(dim, changed, "customer_id", SECOND_LOAD)
    return as_text(closed, "effective_from", "effective_to")


@query
def scd2_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(dim_customer(spark, sf_dir), "effective_from", "effective_to")


@query
def scd2_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(dim_employee(spark, sf_dir), "effective_from", "effective_to")


@query
def current_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.current_rows(dim_customer(spark, sf_dir)).select("customer_sk", "customer_id")


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(order_calendar(spark, sf_dir), "full_date")


# --- fact and analysis ------------------------------------------------------


@query
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir)


@query
def fact_distinct_attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.fact_distinct_attributed(fact(spark, sf_dir))


@query
def employee_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.employee_coverage(sales(spark, sf_dir), dim_employee(spark, sf_dir))


@query
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all nineteen tables after a load of the whole feeds."""
    lake = lakehouse(spark, sf_dir)
    layers = (("raw", LANDING), ("silver", SILVER), ("gold", GOLD))
    return ops.layer_counts({f"{layer}.{t}": lake.read_layer(layer, t) for layer, tables in layers for t in tables})


# --- files, streams and tables ----------------------------------------------


@query
def raw_file_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The employee column of the sales files; each file's header line is data too."""
    path = land(spread(feeds.sales_feed, spark, sf_dir), "sales-files")
    return ops.raw_file_distinct(spark, path, 5).withColumnRenamed("_c5", "employee_id")


@query
def raw_file_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report, first 1000 values only."""
    path = land(spread(feeds.sales_feed, spark, sf_dir), "sales-files")
    return ops.raw_file_distinct(spark, path, 5, rows=1000).withColumnRenamed("_c5", "employee_id")


@query
def read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv_batch(spark, land(feeds.table(spark, sf_dir, "supplier"), "supplier-files"))


def _event_landing(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Folders for event files, their bronze table and its checkpoint."""
    return tuple(scratch_path(spark, f"events-{part}") for part in ("landing", "bronze", "checkpoint"))


def _show_audit(rows: DataFrame) -> DataFrame:
    """File names differ from run to run; show that they are base names of CSV files."""
    return rows.withColumn("from_csv_file", F.col("source_file").rlike(r"^part-[^/]*\.csv$")).drop("source_file")


def _add_files(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").option("header", True).csv(folder)


@query
def ingest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, bronze, checkpoint = _event_landing(spark, sf_dir)
    _add_files(event_files(spark, sf_dir), landing)
    ingest_stream(spark, landing, bronze, checkpoint, struct(EVENTS), ingest_ts=INGEST_TIME)
    return _show_audit(spark.read.parquet(bronze))


@query
def ingest_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, with new files before the first and the second only."""
    landing, bronze, checkpoint = _event_landing(spark, sf_dir)
    events = event_files(spark, sf_dir)
    early = F.col("ts") < EMPLOYEES_SPLIT
    for arrived in (events.filter(early), events.filter(~early), None):
        if arrived is not None:
            _add_files(arrived, landing)
        ingest_stream(spark, landing, bronze, checkpoint, struct(EVENTS), ingest_ts=INGEST_TIME)
    return _show_audit(spark.read.parquet(bronze))


@query
def read_evolved_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second generation of files has a column that the first lacks."""
    landing, bronze, checkpoint = _event_landing(spark, sf_dir)
    events = event_files(spark, sf_dir)
    early = F.col("ts") < EMPLOYEES_SPLIT
    _add_files(events.filter(early).drop("props"), landing)
    narrow = struct(EVENTS.replace(", props string", ""))
    ingest_stream(spark, landing, bronze, checkpoint, narrow, ingest_ts=INGEST_TIME)
    _add_files(events.filter(~early), landing)
    ingest_stream(spark, landing, bronze, checkpoint, struct(EVENTS), ingest_ts=INGEST_TIME)
    return _show_audit(read_evolved(spark, bronze))


@query
def stream_upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user, merged one micro-batch per delivery."""
    landing, root, checkpoint = _event_landing(spark, sf_dir)
    lake = Lakehouse(spark, root, prefix="upsert_" + root.rsplit("-", 1)[1])
    lake.ensure_table("silver", "last_event", struct(EVENTS + ", imported_date timestamp"))
    events = event_files(spark, sf_dir)
    early = F.col("ts") < EMPLOYEES_SPLIT
    for arrived in (events.filter(early), events.filter(~early)):
        _add_files(arrived, landing)
        stream_upsert(
            lake,
            "last_event",
            with_audit(csv_stream(spark, landing, struct(EVENTS))),
            lambda batch: batch.withColumns({"imported_date": F.col("ts"), "source_file": F.lit("events")}),
            ["user_id"],
            checkpoint,
        )
    return lake.read_layer("silver", "last_event").drop("source_file")


@query
def clear_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of a table before and after it is cleared."""
    root = scratch_path(spark, "clear")
    lake = Lakehouse(spark, root, prefix="clear_" + root.rsplit("-", 1)[1])
    lake.ensure_table("silver", "customer_clean", struct(SILVER["customer_clean"]))
    lake.append_rows("silver", "customer_clean", ops.clean_customer(feeds.customer_feed(spark, sf_dir)))
    before = ops.layer_counts({"before": stage(lake.read_layer("silver", "customer_clean"))})
    lake.clear_tables([("silver", "customer_clean")])
    after = lake.read_layer("silver", "customer_clean")
    return before.unionByName(ops.layer_counts({"after": after})).withColumn(
        "column_count", F.lit(len(after.columns))
    )


@query
def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by the calendar it is already holding plus nothing else."""
    root = scratch_path(spark, "overwrite")
    lake = Lakehouse(spark, root, prefix="overwrite_" + root.rsplit("-", 1)[1])
    lake.ensure_table("gold", "dim_date", struct(GOLD["dim_date"]))
    for _ in range(2):
        lake.overwrite_table("gold", "dim_date", order_calendar(spark, sf_dir))
    weekdays = lake.read_layer("gold", "dim_date").filter(~F.col("is_weekend"))
    lake.overwrite_table("gold", "dim_date", weekdays)
    return as_text(lake.read_layer("gold", "dim_date"), "full_date")


@query
def append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends by name; the second brings a column that the first lacks."""
    root = scratch_path(spark, "append")
    lake = Lakehouse(spark, root, prefix="append_" + root.rsplit("-", 1)[1])
    lake.ensure_table("silver", "customer_clean", struct(SILVER["customer_clean"]))
    lake.append_rows("silver", "customer_clean", customers(spark, sf_dir, 1))
    second = customers(spark, sf_dir, 2).withColumn("district", F.concat("city", F.lit("/"), "gender"))
    lake.append_rows("silver", "customer_clean", second.select(*reversed(second.columns)))
    return lake.read_layer("silver", "customer_clean")


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """All three layers loaded once from CSV files of the whole feeds."""
    lake, _ = _landed(spark, sf_dir, spread(feeds.sales_feed, spark, sf_dir))
    run_silver(lake, sales="append")
    run_gold(lake, FIRST_LOAD, first_day="1995-01-01", last_day="2001-12-31")
    return lake


def _landed(spark: SparkSession, sf_dir: str, sales: DataFrame) -> tuple[Lakehouse, dict[str, str]]:
    """The bronze layer of the whole feeds with these sales, and its landing folders."""
    root = scratch_path(spark, "lakehouse")
    lake = Lakehouse(spark, root, prefix="retail_" + root.rsplit("-", 1)[1])
    delivered = {
        "customer": feeds.customer_feed(spark, sf_dir),
        "employee": feeds.employee_feed(spark, sf_dir),
        "product": spread(feeds.product_feed, spark, sf_dir),
        "store": feeds.store_feed(spark, sf_dir),
        "supplier": feeds.supplier_feed(spark, sf_dir),
        "sales_raw": sales,
    }
    lands = [
        partial(land, rows.drop("source_file", "imported_date"), f"landing-{entity}")
        for entity, rows in delivered.items()
    ]
    with shuffles_dropped(spark):
        landing = dict(zip(delivered, run_together(spark, lands)))
    run_bronze(lake, landing, INGEST_TIME)
    _clear_landing(spark, landing)
    return lake, landing


def _clear_landing(spark: SparkSession, landing: dict[str, str]) -> None:
    """Delete the files that bronze has taken in."""
    for folder in landing.values():
        delete_folder(spark, folder)


def _take_in(lake: Lakehouse, landing: dict[str, str], at: str) -> None:
    """Take corrected sales into bronze."""
    sales = {"sales_raw": landing["sales_raw"]}
    run_bronze(lake, sales, at)
    _clear_landing(lake.spark, sales)


@query
def layers_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales delivered twice, loaded with default arguments: the fact has the corrected quantities."""
    sales = numbered_sales(spark, sf_dir)
    days = {"first_day": "1995-01-01", "last_day": "2001-12-31"}
    lake, landing = _landed(spark, sf_dir, spread(numbered_sales, spark, sf_dir))
    run_silver(lake)
    run_gold(lake, FIRST_LOAD, **days)
    corrected = sales.drop("source_file", "imported_date").withColumn("quantity", F.col("quantity") + 1)
    with shuffles_dropped(spark):
        deliver(corrected, landing["sales_raw"])
    _take_in(lake, landing, FIRST_LOAD)
    run_silver(lake)
    lake.drop_unused(datetime.now())  # nobody else reads these tables
    run_gold(lake, SECOND_LOAD, **days)
    lake.drop_unused(datetime.now())
    return lake.read_layer("gold", "fact_sales")


def numbered_sales(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """The sales feed with ids that no two lines share."""
    cents = (F.col("unit_price") * 100).cast("bigint").cast("string")
    return feeds.sales_feed(spark, sf_dir, dealt=dealt).withColumn(
        "sale_id", F.concat_ws("-", "sale_id", F.trim("product_id"), "store_id", cents)
    )


@query
def layers_late_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, product, store and time of returned sales corrected after silver and before gold ran.

    The first gold run is later than the corrections arrived, but has not seen them.
    """
    days = {"first_day": "1995-01-01", "last_day": "2001-12-31"}
    sales = numbered_sales(spark, sf_dir)
    lake, landing = _landed(spark, sf_dir, spread(numbered_sales, spark, sf_dir))
    returned = sales.drop("source_file", "imported_date").filter(F.trim("mode") == "R")
    corrected = returned.withColumns(
        {
            "customer_id": (F.col("store_id").cast("int") + 1).cast("string"),
            "product_id": (F.col("store_id").cast("int") + 2).cast("string"),
            "store_id": ((F.col("store_id").cast("int") + 1) % 25).cast("string"),
            "sale_ts": F.col("sale_ts") + F.expr("INTERVAL 1 DAY"),
        }
    )
    # Files may land while silver is loaded: it reads raw tables only.
    run_together(spark, [partial(run_silver, lake), partial(deliver, corrected, landing["sales_raw"])])
    _take_in(lake, landing, CORRECTION_TIME)
    run_gold(lake, FIRST_LOAD, **days)
    run_silver(lake)
    lake.drop_unused(datetime.now())  # nobody else reads these tables
    run_gold(lake, SECOND_LOAD, **days)
    lake.drop_unused(datetime.now())
    return lake.read_layer("gold", "fact_sales")


def evolved(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Two customer deliveries, the second with a column that the first lacks, each loaded into silver."""
    root = scratch_path(spark, "evolved")
    lake = Lakehouse(spark, root, prefix="evolved_" + root.rsplit("-", 1)[1])
    deliveries = (
        (feeds.customer_feed(spark, sf_dir, until=CUSTOMERS_SPLIT), INGEST_TIME, {}),
        (
            feeds.customer_feed(spark, sf_dir, since=CUSTOMERS_SPLIT),
            CORRECTION_TIME,
            {"customer": "district string"},
        ),
    )
    landing = scratch_path(spark, "evolved-landing")
    for rows, arrival, gained in deliveries:
        rows = rows.drop("source_file", "imported_date")
        if gained:
            rows = rows.withColumn("district", F.concat(F.trim("city"), F.lit("/"), F.trim("gender")))
        rows.write.mode("append").option("header", True).csv(landing)
        run_bronze(lake, {"customer": landing}, arrival, new_columns=gained)
        run_silver(lake)
    return lake


@query
def raw_evolved_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table has the gained column, NULL in rows of older files."""
    raw = evolved(spark, sf_dir).read_layer("raw", "customer").drop("source_file")
    return raw.withColumns({c: F.trim(c) for c, kind in raw.dtypes if kind == "string"})


@query
def silver_evolved_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gained column passes through cleaning and widens the silver table."""
    return evolved(spark, sf_dir).read_layer("silver", "customer_clean").drop("source_file")


@query
def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lakehouse(spark, sf_dir).read_layer("gold", "fact_sales")


@query
def layers_end_to_end_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = lakehouse(spark, sf_dir)
    return ops.layer_counts(
        {
            **{f"silver.{t}": lake.read_layer("silver", t) for t in SILVER},
            **{f"gold.{t}": lake.read_layer("gold", t) for t in GOLD},
        }
    )
