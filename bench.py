"""Timings over the given tables at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Layer runs are timed with their writes, as one load of whole feeds from CSV
files. Operator queries are timed from building the query to its last row
(a write to the ``noop`` sink), with the tables they load from staged before.
Session start and a warm-up read are left out.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import feeds, queries  # noqa: E402
from checks.compare import session  # noqa: E402
from stratalake import operators as ops  # noqa: E402
from stratalake.plans import (  # noqa: E402
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
from stratalake.schemas import GOLD, SILVER  # noqa: E402
from stratalake.sources import Lakehouse, scratch_path, stage  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = session("bench", CPUS)
    times: dict[str, float] = {}

    def timed(name: str, run: Callable[[], object]) -> None:
        start = time.perf_counter()
        result = run()
        if hasattr(result, "write"):
            result.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)

    feeds.table(spark, SF_DIR, "lineitem").count()
    root = scratch_path(spark, "bench")
    lake = Lakehouse(spark, root, prefix="bench")
    delivered = {
        "customer": feeds.customer_feed(spark, SF_DIR),
        "employee": feeds.employee_feed(spark, SF_DIR),
        "product": feeds.product_feed(spark, SF_DIR),
        "store": feeds.store_feed(spark, SF_DIR),
        "supplier": feeds.supplier_feed(spark, SF_DIR),
        "sales_raw": feeds.sales_feed(spark, SF_DIR),
    }
    landing = {
        entity: queries.land(rows.drop("source_file", "imported_date"), f"bench-{entity}")
        for entity, rows in delivered.items()
    }
    timed("layer_bronze", lambda: run_bronze(lake, landing, queries.INGEST_TIME))
    timed("layer_bronze_nothing_new", lambda: run_bronze(lake, landing, queries.INGEST_TIME))
    timed("layer_silver", lambda: run_silver(lake))
    timed("layer_gold", lambda: run_gold(lake, queries.FIRST_LOAD, "new", "1995-01-01", "2001-12-31"))
    timed("layer_silver_again", lambda: run_silver(lake))
    timed("layer_gold_again", lambda: run_gold(lake, queries.SECOND_LOAD, "new", "1995-01-01", "2001-12-31"))

    # One order in a hundred is corrected.
    few = feeds.sales_feed(spark, SF_DIR).filter(F.split("sale_id", "-")[0].cast("bigint") % 100 == 0)
    few = few.drop("source_file", "imported_date").withColumn("quantity", F.col("quantity") + 1)
    few.write.mode("append").option("header", True).csv(landing["sales_raw"])
    sales_landing = {"sales_raw": landing["sales_raw"]}
    timed("layer_bronze_1_percent", lambda: run_bronze(lake, sales_landing, queries.SECOND_LOAD))
    timed("layer_silver_1_percent", lambda: run_silver(lake))
    timed("layer_gold_1_percent", lambda: run_gold(lake, "2024-04-15 00:00:00", "new", "1995-01-01", "2001-12-31"))

    def bronze(entity: str):
        return lake.read_layer("raw", entity)

    def silver(table: str):
        return lake.read_layer("silver", table)

    def gold(table: str):
        return lake.read_layer("gold", table)

    later = "2024-05-01 00:00:00"
    timed("clean_sales", lambda: ops.clean_sales(bronze("sales_raw")))
    timed("dedupe_latest_sales", lambda: ops.dedupe_latest(ops.clean_sales(bronze("sales_raw")), ["sale_id"]))
    timed("dedupe_latest_product", lambda: ops.dedupe_latest(bronze("product"), ["product_id"]))
    for table, (entity, _, _) in {
        "customer_clean": ("customer", 0, 0),
        "product_clean": ("product", 0, 0),
        "store_clean": ("store", 0, 0),
        "supplier_clean": ("supplier", 0, 0),
    }.items():
        timed(
            f"silver_{entity}_merge",
            lambda t=table, e=entity: load_silver_entity(silver(t), bronze(e), t),
        )
    timed("silver_sales_upsert", lambda: sales_upsert_latest(silver("sales_clean"), ops.clean_sales(bronze("sales_raw"))))
    versions = stage(ops.clean_employee_history(bronze("employee")))
    timed("history_apply", lambda: ops.history_apply(silver("employee_clean_history"), versions))
    some = stage(silver("employee_clean_history").orderBy("employee_id", "effective_from", "change_hash").limit(160))
    timed("history_apply_160_rows", lambda: ops.history_apply(some, some))
    second = stage(queries.customers(spark, SF_DIR, 2))
    first = stage(queries.customers(spark, SF_DIR, 1))
    timed("merge_upsert_customer", lambda: ops.merge_upsert(first, second, ["customer_id"]))
    timed("hashdiff_customer", lambda: customer_snapshot(second))
    timed("scd2_customer", lambda: load_dim_customer(gold("dim_customer"), second, later))
    timed("scd2_employee", lambda: load_dim_employee(gold("dim_employee"), silver("employee_clean_history"), later))
    for table, source in (
        ("dim_product", "product_clean"),
        ("dim_store", "store_clean"),
        ("dim_supplier", "supplier_clean"),
    ):
        timed(f"scd1_{table}", lambda t=table, s=source: load_dim_type_1(gold(t), silver(s), t, later))
    timed("surrogate_keys", lambda: queries.QUERIES["surrogate_keys"](spark, SF_DIR))
    timed("dim_date", lambda: queries.order_calendar(spark, SF_DIR))
    timed(
        "fact_sales",
        lambda: ops.fact_sales(
            silver("sales_clean"),
            *(gold(t) for t in ("dim_date", "dim_customer", "dim_employee", "dim_product", "dim_store")),
            later,
        ),
    )
    timed("fact_distinct_attributed", lambda: ops.fact_distinct_attributed(gold("fact_sales")))
    timed("employee_coverage", lambda: ops.employee_coverage(silver("sales_clean"), gold("dim_employee")))
    timed(
        "layer_counts",
        lambda: ops.layer_counts({**{t: silver(t) for t in SILVER}, **{t: gold(t) for t in GOLD}}),
    )
    timed("raw_file_distinct", lambda: ops.raw_file_distinct(spark, landing["sales_raw"], 5))
    timed("stream_upsert", lambda: queries.QUERIES["stream_upsert_events"](spark, SF_DIR))
    timed("cleanup_13_tables", lambda: lake.clear_tables())

    print(
        json.dumps(
            {
                "metric": "sum of layer runs and operator queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
