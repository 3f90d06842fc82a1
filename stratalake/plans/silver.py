"""Silver run: clean bronze rows and merge them into the silver tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, functions as F

from stratalake.operators.clean import (
    clean_customer,
    clean_employee_history,
    clean_product,
    clean_sales,
    clean_store,
    clean_supplier,
)
from stratalake.operators.dedupe import dedupe_latest
from stratalake.operators.history import history_apply
from stratalake.operators.merge import merge_latest, merge_upsert
from stratalake.operators.table_merge import upsert_table
from stratalake.plans.together import run_together
from stratalake.schemas import BUCKET, CODEC, LOAD
from stratalake.sources.sizes import estimated_bytes
from stratalake.sources.staging import stage, staged_for_load
from stratalake.sources.tables import Lakehouse

# Silver table -> bronze table, cleaning, business key; in load order.
ENTITIES: dict[str, tuple[str, Callable[[DataFrame], DataFrame], str]] = {
    "customer_clean": ("customer", clean_customer, "customer_id"),
    "product_clean": ("product", clean_product, "product_id"),
    "store_clean": ("store", clean_store, "store_id"),
    "supplier_clean": ("supplier", clean_supplier, "supplier_id"),
}


# What decides which of two deliveries of a sale is the newer.
ARRIVAL = ("imported_date", "source_file")


def sales_upsert_latest(target: DataFrame, sales: DataFrame, unique_target: bool = False) -> DataFrame:
    """Cleaned sales merged on ``sale_id``: the newest arrival stays, whichever load it came with.

    Into a target with one row per sale (``unique_target``) of the same columns
    this is one exchange of both.
    """
    if unique_target and sorted(target.dtypes) == sorted(sales.dtypes):
        return merge_latest(target, sales, ["sale_id"], ARRIVAL)
    newest = stage(dedupe_latest(sales, ["sale_id"]), "sales", CODEC)
    return merge_upsert(target, newest, ["sale_id"], check=False, newer_by=ARRIVAL)


def load_silver_entity(target: DataFrame, bronze: DataFrame, table: str) -> DataFrame:
    """Clean, keep the newest row per key, upsert."""
    _, clean, key = ENTITIES[table]
    newest = stage(dedupe_latest(clean(bronze), [key]), table, CODEC)
    return merge_upsert(target, newest, [key], check=False)


def run_silver(
    lake: Lakehouse,
    sales: str = "upsert",
    since: datetime | str | None = None,
    derive_current: bool = False,
    full: bool = False,
) -> None:
    """Load all silver tables, side by side, from the bronze rows they have not taken in yet.

    What is new is known by the number of the bronze load that wrote a row, not
    by its time, so a late or back-dated arrival is not missed. A table whose
    source has nothing new is left alone, and a load that fails is made up for
    by the next run. ``full`` takes all bronze rows, ``since`` those imported
    after that time; neither changes what counts as taken in for a later run,
    except that a full run counts as one.

    ``sales`` is ``"upsert"`` (the newest arrival of a sale stays) or
    ``"append"`` (every arrival is added, as often as it is taken).
    """
    if sales not in ("upsert", "append"):
        raise ValueError(f"sales is 'upsert' or 'append', not {sales!r}")
    lake.ensure_layers()

    def load(table: str, entity: str, write: Callable[[DataFrame, int], None]) -> None:
        upto = lake.finished_load("raw", entity)
        rows = lake.read_layer("raw", entity, hidden=True)
        if since is not None:
            rows = rows.filter(F.col("imported_date") > F.lit(since).cast("timestamp"))
        elif not full:
            taken = lake.taken_load("silver", table)
            if upto <= taken:
                return
            rows = rows.filter(F.col(LOAD) > taken)
        number = lake.begin_load("silver", table)
        write(rows, number)
        lake.end_load("silver", table, number, upto if since is None else None)

    def many(rows: DataFrame) -> bool:
        """Each task has enough rows of every bucket for a file, so they need not be gathered."""
        return estimated_bytes(rows) > lake.at_once

    def upsert(table: str, clean: Callable[[DataFrame], DataFrame], key: str, newer_by: Sequence[str] = ()):
        def write(rows: DataFrame, number: int) -> None:
            newest = _numbered(dedupe_latest(clean(rows), [key]), number)
            if lake.read_layer("silver", table).isEmpty():
                lake.append_rows("silver", table, newest, gathered=many(rows))
            elif many(rows):
                apart = lake.in_buckets("silver", table, newest)
                newest = stage(apart, table, CODEC, by=BUCKET if BUCKET in apart.columns else None)
                upsert_table(lake, "silver", table, newest, [key], newer_by)
            else:
                upsert_table(lake, "silver", table, stage(newest, table, CODEC), [key], newer_by)

        return write

    def append_sales(rows: DataFrame, number: int) -> None:
        lake.append_rows("silver", "sales_clean", _numbered(clean_sales(rows), number), gathered=many(rows))

    def load_history(rows: DataFrame, _: int) -> None:
        versions = stage(clean_employee_history(rows), "employee")
        if not versions.isEmpty():
            history = lake.read_layer("silver", "employee_clean_history")
            loaded = history_apply(history, versions, derive_current)
            lake.overwrite_table("silver", "employee_clean_history", loaded)

    write_sales = append_sales if sales == "append" else upsert("sales_clean", clean_sales, "sale_id", ARRIVAL)
    loads = [partial(load, t, entity, upsert(t, clean, key)) for t, (entity, clean, key) in ENTITIES.items()]
    loads += [
        partial(load, "employee_clean_history", "employee", load_history),
        partial(load, "sales_clean", "sales_raw", write_sales),
    ]
    with staged_for_load(lake.spark):
        run_together(lake.spark, loads)


def _numbered(rows: DataFrame, number: int) -> DataFrame:
    return rows.withColumn(LOAD, F.lit(number).cast("bigint"))
