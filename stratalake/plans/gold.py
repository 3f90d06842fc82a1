"""Gold run: dimensions from silver, then the sales fact."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions import hashdiff, norm_key, norm_title
from stratalake.operators.calendar import dim_date
from stratalake.operators.clean import CUSTOMER_RULES
from stratalake.operators.dedupe import dedupe_latest
from stratalake.operators.facts import fact_sales, source_digest, valid_lines
from stratalake.operators.merge import append_rows
from stratalake.operators.scd import scd1_apply, scd2_apply
from stratalake.operators.table_merge import buckets_in
from stratalake.plans.together import run_together
from stratalake.schemas import (
    BUCKET,
    CALENDAR_FIRST_DAY,
    CALENDAR_LAST_DAY,
    CODEC,
    LOAD,
    OPEN_CUSTOMER_TS,
    OPEN_EMPLOYEE_TS,
    SOURCE_HASH,
)
from stratalake.sources.sizes import broadcast_limit, estimated_bytes, fits_broadcast
from stratalake.sources.staging import stage, staged_for_load
from stratalake.sources.tables import Lakehouse, in_slice

# What a staged row of sale id, quantity, price and hash takes, about.
_BYTES_A_SALE = 32
# Buckets that a task may write a file of each without making many small ones.
_FEW_BUCKETS = 4
_SOLD, _SALES, _ROWS = "__sold", "__sales", "__rows"

CUSTOMER_ATTRIBUTES = [c for c in CUSTOMER_RULES if c != "customer_id"]

# Dimension -> silver table, business key, surrogate key, attributes.
TYPE_1 = {
    "dim_product": (
        "product_clean",
        "product_id",
        "product_sk",
        ["product_name", "supplier_id", "supplier_name", "return_policy", "warranty"],
    ),
    "dim_store": ("store_clean", "store_id", "store_sk", ["store_name", "city"]),
    "dim_supplier": ("supplier_clean", "supplier_id", "supplier_sk", ["supplier_name"]),
}

_NORMALISED = {
    "product_id": norm_key,
    "product_name": norm_title,
    "supplier_id": norm_key,
    "supplier_name": norm_title,
    "store_id": norm_key,
    "store_name": norm_title,
    "city": norm_title,
}


def customer_snapshot(silver: DataFrame) -> DataFrame:
    """Silver customers with the fingerprint of their tracked attributes."""
    attributes = silver.select(
        "customer_id", *(CUSTOMER_RULES[c](c).alias(c) for c in CUSTOMER_ATTRIBUTES)
    )
    return attributes.withColumn("hashdiff", hashdiff(CUSTOMER_ATTRIBUTES))


def employee_snapshot(history: DataFrame) -> DataFrame:
    """The last imported version of each employee; among those the one that starts latest."""
    latest = dedupe_latest(
        history, ["employee_id"], ["imported_date", "effective_from"], drop_null_keys=False
    )
    return latest.select(
        norm_key("employee_id").alias("employee_id"),
        norm_key("employee_code").alias("employee_code"),
        norm_key("store_id").alias("store_id"),
        norm_title("store_name").alias("store_name"),
        F.lit(True).alias("is_primary"),
        "source_file",
        "imported_date",
    )


def load_dim_customer(
    dim: DataFrame, silver: DataFrame, batch_ts: datetime | str | Column, check: bool = True
) -> DataFrame:
    return scd2_apply(
        dim,
        customer_snapshot(silver),
        key="customer_id",
        sk="customer_sk",
        compare=["hashdiff"],
        batch_ts=batch_ts,
        open_until=OPEN_CUSTOMER_TS,
        check=check,
    )


def load_dim_employee(
    dim: DataFrame,
    history: DataFrame,
    batch_ts: datetime | str | Column,
    null_safe: bool = False,
) -> DataFrame:
    """Code and store are compared; the store's name alone does not make a version."""
    return scd2_apply(
        dim,
        employee_snapshot(history),
        key="employee_id",
        sk="employee_sk",
        compare=["employee_code", "store_id"],
        batch_ts=batch_ts,
        open_until=OPEN_EMPLOYEE_TS,
        sk_mode="hash",
        null_safe=null_safe,
        check=False,
    )


def load_dim_type_1(
    dim: DataFrame, silver: DataFrame, table: str, batch_ts: datetime | str | Column, check: bool = True
) -> DataFrame:
    _, key, sk, attributes = TYPE_1[table]
    source = silver.select(
        *(_NORMALISED[c](c).alias(c) if c in _NORMALISED else F.col(c) for c in [key, *attributes])
    )
    return scd1_apply(dim, source, key, sk, attributes, batch_ts, check)


def run_gold(
    lake: Lakehouse,
    batch_ts: datetime | str,
    fact: str = "new",
    first_day: str = CALENDAR_FIRST_DAY,
    last_day: str = CALENDAR_LAST_DAY,
    since: datetime | str | None = None,
    full: bool = False,
) -> None:
    """Load all gold tables as of ``batch_ts``: the dimensions side by side, then the fact.

    A type 2 dimension without changes is not rewritten.
    ``fact`` is ``"new"`` (sales the fact does not have, or not as they are now:
    a corrected sale replaces its fact row, whatever was corrected and whenever
    it arrived) or ``"append"`` (every run adds all silver sales). A new run
    looks at the silver sales that a load wrote since the fact was last loaded
    without a failure, with ``full`` at all of them, with ``since`` at those
    imported after that time.
    """
    if fact not in ("new", "append"):
        raise ValueError(f"fact is 'new' or 'append', not {fact!r}")
    lake.ensure_layers()

    def gold(table: str) -> DataFrame:
        return lake.read_layer("gold", table)

    def silver(table: str) -> DataFrame:
        return lake.read_layer("silver", table)

    def load_customer() -> None:
        dim = gold("dim_customer")
        loaded = load_dim_customer(dim, silver("customer_clean"), batch_ts, check=False)
        if loaded is not dim:
            lake.overwrite_table("gold", "dim_customer", loaded)

    def load_employee() -> None:
        dim = gold("dim_employee")
        loaded = load_dim_employee(dim, silver("employee_clean_history"), batch_ts)
        if loaded is not dim:
            lake.overwrite_table("gold", "dim_employee", loaded)

    def load_type_1(table: str, source: str) -> None:
        dim = load_dim_type_1(gold(table), silver(source), table, batch_ts, check=False)
        lake.overwrite_table("gold", table, dim)

    def load_date() -> None:
        lake.overwrite_table("gold", "dim_date", dim_date(lake.spark, first_day, last_day))

    type_1 = [partial(load_type_1, table, source) for table, (source, _, _, _) in TYPE_1.items()]
    with staged_for_load(lake.spark):
        # Silver tables hold one row per key, so the loads need not check it.
        run_together(lake.spark, [load_customer, load_employee, *type_1, load_date])
        _load_fact(lake, batch_ts, fact, since, full)


def _load_fact(lake: Lakehouse, batch_ts: datetime | str, fact: str, since: datetime | str | None, full: bool) -> None:
    upto = lake.finished_load("silver", "sales_clean")
    sales = lake.read_layer("silver", "sales_clean", hidden=True).withColumn(SOURCE_HASH, source_digest())
    due = F.lit(True)
    if since is not None:
        due = F.col("imported_date") > F.lit(since).cast("timestamp")
    elif fact == "new" and not full:
        taken = lake.taken_load("gold", "fact_sales")
        if upto <= taken:
            return
        due = F.col(LOAD) > taken
    looked_at = sales.filter(due)

    def gather(keyed: DataFrame) -> DataFrame:
        return lake.in_buckets("gold", "fact_sales", keyed).hint("rebalance", BUCKET)

    def lines(of: DataFrame, gathered: bool = False) -> DataFrame:
        dims = (lake.read_layer("gold", f"dim_{d}") for d in ("date", "customer", "employee", "product", "store"))
        # The hash moves as bytes, which are a third less than their text.
        made = fact_sales(of, *dims, batch_ts, carry=[SOURCE_HASH], gather=gather if gathered else None)
        return made.withColumn(SOURCE_HASH, F.base64(SOURCE_HASH))

    def in_slices() -> list[list[int] | None]:
        return lake.slices("gold", "fact_sales", estimated_bytes(looked_at))

    everything = since is None and lake.taken_load("gold", "fact_sales") == 0
    if fact == "append":
        lake.append_rows("gold", "fact_sales", lines(looked_at, gathered=True), gathered=True)
    elif everything and lake.read_layer("gold", "fact_sales").isEmpty():
        looked_at = _as_fact_buckets(lake, looked_at)
        for part in in_slices():
            made = lines(in_slice(looked_at, part).drop(BUCKET), gathered=_gathers(part))
            lake.append_rows("gold", "fact_sales", made, gathered=True)
    elif looked_at.count() * _BYTES_A_SALE <= broadcast_limit(looked_at):
        _replace_changed(lake, sales, looked_at, lines)
    else:
        for part in in_slices():
            _replace_many(lake, sales, due, lines, part)
    if since is None:
        lake.set_properties("gold", "fact_sales", source=upto)


def _replace_changed(
    lake: Lakehouse, sales: DataFrame, looked_at: DataFrame, lines: Callable[..., DataFrame]
) -> None:
    """Bring the fact up to the sales of ``looked_at`` that it does not have as they are.

    Silver sales and fact are dealt by sale id alike, so only the buckets with a
    changed sale are read, and only those with a row to replace are rewritten.
    Should the run fail between the two writes, the next one finds the rest.
    """
    fact = lake.read_layer("gold", "fact_sales", hidden=True)
    hashed = looked_at.withColumn(SOURCE_HASH, F.base64(SOURCE_HASH))
    looked_at = stage(hashed.select("sale_id", "quantity", "unit_price", SOURCE_HASH), "new-sales", CODEC)
    looked_at = lake.in_buckets("gold", "fact_sales", looked_at)
    near = fact.filter(F.col(BUCKET).isin(buckets_in(looked_at)))
    ids = stage(changed_sales(near, looked_at).select("sale_id", BUCKET).distinct(), "changed-sales", CODEC)
    touched = buckets_in(ids)
    if not touched:
        return
    ids = ids.select("sale_id")
    near = fact.filter(F.col(BUCKET).isin(touched))
    own = _as_fact_buckets(lake, sales).filter(F.col(BUCKET).isin(touched))
    made = stage(
        lake.in_buckets("gold", "fact_sales", lines(own.join(ids, "sale_id", "left_semi"))), "fact-lines", CODEC
    )
    replaced = buckets_in(near.join(ids, "sale_id", "left_semi"))
    there = F.col(BUCKET).isin(replaced)
    if replaced:
        kept = near.filter(there).join(ids, "sale_id", "left_anti")
        few = fits_broadcast(ids)
        lake.replace_buckets("gold", "fact_sales", append_rows(kept, made.filter(there)), replaced, gathered=few)
    if len(replaced) < len(touched):
        lake.append_rows("gold", "fact_sales", made.filter(~there))


def _as_fact_buckets(lake: Lakehouse, sales: DataFrame) -> DataFrame:
    """Silver sales with the bucket of their fact row: as far as both tables have the same number, a partition of the scan."""
    if lake.dealt_by("silver", "sales_clean") == lake.dealt_by("gold", "fact_sales"):
        return sales
    return lake.in_buckets("gold", "fact_sales", sales)


def _gathers(part: list[int] | None) -> bool:
    """Whether rows have to be gathered by bucket for a write: those of a few buckets make few files as they are."""
    return part is None or len(part) > _FEW_BUCKETS


def _replace_many(
    lake: Lakehouse,
    sales: DataFrame,
    due: Column,
    lines: Callable[..., DataFrame],
    part: list[int] | None = None,
) -> None:
    """``_replace_changed`` for more sales than can be broadcast, those of some buckets (``part``) or all.

    Ids and hashes of both tables are exchanged once, and tell which of the sales
    that are ``due`` have changed, how many rows of each the fact has and how many
    are due. If no other silver row has such an id, the due ones make its lines.
    Where changed sales are all of a bucket, they need not be picked by id, nor its
    fact rows kept apart from those that go. The lines are written as they are made.
    """
    fact = in_slice(lake.read_layer("gold", "fact_sales", hidden=True), part)
    own = in_slice(_as_fact_buckets(lake, sales), part)
    due = F.coalesce(due, F.lit(False))
    gathers = _gathers(part)

    def hashes(rows: DataFrame, value: Column, sold: bool) -> DataFrame:
        return rows.select("sale_id", BUCKET, value.alias(SOURCE_HASH), F.lit(sold).alias(_SOLD))

    looked_at = hashes(valid_lines(own.filter(due)), F.col(SOURCE_HASH), True)
    both = looked_at.unionByName(hashes(fact, F.try_to_binary(SOURCE_HASH, F.lit("base64")), False))
    by_hash = (
        both.repartition("sale_id")
        .groupBy("sale_id", BUCKET, SOURCE_HASH)
        .agg(F.count_if(_SOLD).alias(_SALES), F.count_if(~F.col(_SOLD)).alias(_ROWS))
    )
    lacking = F.bool_or((F.col(_SALES) > 0) & (F.col(_ROWS) == 0))
    ids = by_hash.groupBy("sale_id", BUCKET).agg(
        lacking.alias("__lacking"), F.sum(_SALES).alias(_SALES), F.sum(_ROWS).alias(_ROWS)
    )
    ids = stage(ids.filter("__lacking").drop("__lacking"), "changed-sales", CODEC)
    counted = ids.groupBy(BUCKET).agg(F.sum(_SALES).alias(_SALES), F.sum(_ROWS).alias(_ROWS)).collect()
    if not counted:
        return
    touched = sorted(r[BUCKET] for r in counted)
    replaced = sorted(r[BUCKET] for r in counted if r[_ROWS])
    of_bucket = {(r[BUCKET], name): r[name] for r in counted for name in (_SALES, _ROWS)}

    def partly(rows: DataFrame, name: str) -> list[int]:
        """Buckets of ``rows`` that have others than those of the changed ids."""
        there = rows.filter(F.col(BUCKET).isin(touched)).groupBy(BUCKET).count().collect()
        return sorted(r[BUCKET] for r in there if r["count"] != of_bucket[r[BUCKET], name])

    others = valid_lines(own.filter(~due)).select("sale_id")
    if others.isEmpty() or others.join(ids.select("sale_id"), "sale_id", "left_semi").limit(1).count() == 0:
        own = own.filter(due)
    picked = partly(valid_lines(own), _SALES)
    there = F.col(BUCKET).isin(picked)
    wanted = own.filter(F.col(BUCKET).isin(touched) & ~there)
    if picked:
        wanted = wanted.unionByName(own.filter(there).join(ids.filter(there).select("sale_id"), "sale_id", "left_semi"))
    both_ways = 0 < len(replaced) < len(touched)
    made = lines(wanted, gathered=gathers)
    if BUCKET not in made.columns:
        made = lake.in_buckets("gold", "fact_sales", made)
    if both_ways:
        made = stage(made, "fact-lines", CODEC)
    again = F.col(BUCKET).isin(replaced)
    if replaced:
        there = F.col(BUCKET).isin(partly(fact.filter(again), _ROWS))
        kept = fact.filter(there).join(ids.filter(there).select("sale_id"), "sale_id", "left_anti")
        merged = append_rows(kept.hint("rebalance", BUCKET) if gathers else kept, made.filter(again) if both_ways else made)
        lake.replace_buckets("gold", "fact_sales", merged, replaced, gathered=True)
    if both_ways or not replaced:
        lake.append_rows("gold", "fact_sales", made.filter(~again), gathered=not both_ways)


def changed_sales(fact: DataFrame, sales: DataFrame) -> DataFrame:
    """Valid sales without a fact row that was made from their present values.

    Both sides have the hash of these values; the keys a fact row was loaded
    with are not compared, as it keeps the versions it has until the sale itself
    changes. A few sales first pick their own rows out of the fact.
    """
    known = fact.select("sale_id", SOURCE_HASH)
    if fits_broadcast(sales) and not fits_broadcast(known):
        known = known.join(sales.select("sale_id"), "sale_id", "left_semi")
    return valid_lines(sales).join(known, ["sale_id", SOURCE_HASH], "left_anti")
