"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.sources.staging import stage

_PLACE = "__place"
_PART = "__part"
_BEFORE = "__before"

# monotonically_increasing_id() holds the partition above 33 bits of row number.
_ROW_BITS = 33


def max_surrogate_key(dim: DataFrame, sk: str) -> DataFrame:
    """One row, the highest key so far; 0 for an empty dimension."""
    return dim.agg(F.coalesce(F.max(sk), F.lit(0).cast("bigint")).alias("base"))


def assign_surrogate_keys(
    rows: DataFrame,
    sk: str,
    order_by: Sequence[str],
    base: DataFrame | int = 0,
) -> DataFrame:
    """Number ``rows`` base+1, base+2, ... in ``order_by`` order, without gaps.

    Gives the numbers of a window over the whole frame, which would run in one
    task, from a range exchange instead: each range is sorted and written with
    its partition and row number, rows are counted per range, and the number is
    rows in earlier ranges + place in the range. Remaining columns break ties,
    both in the order and in the range bounds, so a repeated ``order_by`` value
    does not end up in a single range.

    ``base`` is a number or a one-row frame such as ``max_surrogate_key``.
    """
    names = rows.columns
    order = [F.asc(c) for c in [*order_by, *(c for c in names if c not in order_by)]]
    placed = stage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PLACE, F.monotonically_increasing_id()),
        "surrogate-keys",
    )
    part = F.shiftright(F.col(_PLACE), _ROW_BITS)
    row = F.col(_PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per range: no more than there are shuffle partitions.
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy(part.alias(_PART))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(_PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE))
    )
    start = F.lit(base).cast("bigint") if isinstance(base, int) else base.scalar()
    return placed.join(F.broadcast(before), part == F.col(_PART)).select(
        (start + F.col(_BEFORE) + row + 1).cast("bigint").alias(sk), *names
    )


def hash_surrogate_key(values: Sequence[Column | str]) -> Column:
    """A text key that depends only on the values, so that a repeated run gives it again."""
    return F.sha2(F.concat_ws("|", *values), 256)
