"""Slowly changing dimensions, type 1 and type 2.

Every step takes the old dimension and one source snapshot and returns rows;
the set of changes is worked out once, from the old dimension, and both the
closed and the new versions follow from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.operators.keys import (
    assign_surrogate_keys,
    hash_surrogate_key,
    max_surrogate_key,
)
from stratalake.operators.merge import append_rows, check_unique_source, merge_update, new_keys
from stratalake.sources.staging import stage

_WAS = "__was_"


def as_timestamp(value: datetime | str | Column) -> Column:
    """A load time: one fixed value for all rows of a load."""
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def scd1_update(
    dim: DataFrame,
    source: DataFrame,
    key: str,
    attributes: Sequence[str],
    batch_ts: datetime | str | Column,
) -> DataFrame:
    """Overwrite the attributes of every matched row, changed or not, and stamp it."""
    stamped = source.withColumn("updated_at", as_timestamp(batch_ts))
    return merge_update(dim, stamped, [key], [*attributes, "updated_at"])


def scd1_apply(
    dim: DataFrame,
    source: DataFrame,
    key: str,
    sk: str,
    attributes: Sequence[str],
    batch_ts: datetime | str | Column,
    check: bool = True,
) -> DataFrame:
    """Type 1 load: update known keys, number and add new ones.

    New keys are written out first, so they are looked up once, and a load
    without any goes no further than the update.
    """
    source = source.select(key, *attributes)
    loaded = scd1_update(dim, source, key, attributes, batch_ts)
    fresh = stage(new_keys(dim, source, [key]), "scd1")
    if not fresh.isEmpty():
        stamped = fresh.withColumn("updated_at", as_timestamp(batch_ts))
        numbered = assign_surrogate_keys(stamped, sk, [key], max_surrogate_key(dim, sk))
        loaded = append_rows(loaded, numbered)
    return append_rows(loaded, _guard(loaded, source, key)) if check else loaded


def scd2_changes(
    dim: DataFrame,
    snapshot: DataFrame,
    key: str,
    compare: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Snapshot rows whose key has no current version or whose ``compare`` columns differ.

    As with SQL's ``<>``, a change from or to NULL does not count unless
    ``null_safe`` is set.
    """
    current = current_rows(dim).select(*(F.col(c).alias(_WAS + c) for c in [key, *compare]))

    def differs(column: str) -> Column:
        was, now = F.col(_WAS + column), F.col(column)
        return ~now.eqNullSafe(was) if null_safe else now != was

    changed = reduce(lambda a, b: a | b, [differs(c) for c in compare])
    return (
        snapshot.join(current, F.col(key) == F.col(_WAS + key), "left")
        .filter(F.col(_WAS + key).isNull() | changed)
        .select(*snapshot.columns)
    )


def scd2_close(
    dim: DataFrame,
    changed: DataFrame,
    key: str,
    batch_ts: datetime | str | Column,
) -> DataFrame:
    """End the current version of every key in ``changed`` (unique on ``key``).

    Versions closed earlier take no part in the join. They and the current
    ones leave as separate files, whose row-group statistics keep a later
    read of current rows off the closed ones.
    """
    past = dim.filter(~F.col("is_current") | F.col("is_current").isNull())
    ended = changed.select(key).withColumns(
        {"is_current": F.lit(False), "effective_to": as_timestamp(batch_ts)}
    )
    return past.unionByName(merge_update(current_rows(dim), ended, [key]))


def scd2_apply(
    dim: DataFrame,
    snapshot: DataFrame,
    key: str,
    sk: str,
    compare: Sequence[str],
    batch_ts: datetime | str | Column,
    open_until: str,
    sk_mode: str = "sequence",
    null_safe: bool = False,
    check: bool = True,
) -> DataFrame:
    """Type 2 load: close changed versions at ``batch_ts`` and open new ones from it.

    Both ends use the same time, so versions are half-open intervals without a
    gap. The changes are written out before they are numbered, closed and added,
    so the snapshot is compared with the dimension once, and ``dim`` itself is
    the result if there are none. A key that vanishes from the snapshot stays
    current. ``sk_mode`` is ``"sequence"`` for dense numbers after the highest
    so far, or ``"hash"`` for a text key made of business key and start.
    """
    if sk_mode not in ("sequence", "hash"):
        raise ValueError(f"sk_mode is 'sequence' or 'hash', not {sk_mode!r}")
    load_time = as_timestamp(batch_ts)
    changes = stage(scd2_changes(dim, snapshot, key, compare, null_safe), "scd2")
    if changes.isEmpty():
        return append_rows(dim, _guard(dim, snapshot, key)) if check else dim
    fresh = changes.withColumns(
        {
            "effective_from": load_time,
            "effective_to": F.lit(open_until).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )
    if sk_mode == "sequence":
        keyed = assign_surrogate_keys(fresh, sk, [key], max_surrogate_key(dim, sk))
    else:
        start = F.unix_micros("effective_from").cast("string")
        keyed = fresh.withColumn(sk, hash_surrogate_key([F.col(key), start]))
    loaded = append_rows(scd2_close(dim, keyed, key, load_time), keyed.select(*dim.columns))
    return append_rows(loaded, _guard(loaded, snapshot, key)) if check else loaded


def _guard(loaded: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """No rows in the shape of ``loaded``; raises on a key that ``source`` repeats."""
    return check_unique_source(source, [key]).select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in loaded.schema)
    )
