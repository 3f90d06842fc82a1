"""Numbers and running totals over a global order, without a window over everything.

Rows are range-exchanged, sorted and written with the range and their place in
it. Totals per range are few, so a window over them is cheap; each row then adds
what lies before its range. Nothing passes through one task or the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.sources import stage

# monotonically_increasing_id() holds the partition above 33 bits of row number.
_ROW_BITS = 33
# Rows of a range that one window task adds up.
_BLOCK_BITS = 18


def place_rows(rows: DataFrame, order: Sequence[Column | str], label: str) -> DataFrame:
    """``rows`` in global ``order`` as a written table, with ``range_no`` and ``row_no`` in the range."""
    placed = stage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        label,
    )
    return placed.withColumns(
        {
            "range_no": F.shiftright("place", _ROW_BITS),
            "row_no": F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("place")


def number_in_groups(placed: DataFrame, group: str, name: str) -> DataFrame:
    """Adds 0, 1, 2, ... per ``group``, which must lead the order of ``placed``."""
    # One row per range and group in it: ranges + groups at most, as groups lie in sequence.
    spans = placed.groupBy(group, "range_no").agg(
        F.count(F.lit(1)).alias("span_rows"), F.min("row_no").alias("span_first")
    )
    earlier = Window.partitionBy(group).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col(group).alias("span_group"),
        F.col("range_no").alias("span_range"),
        (F.coalesce(F.sum("span_rows").over(earlier), F.lit(0)) - F.col("span_first")).alias("span_shift"),
    )
    same = (F.col("range_no") == F.col("span_range")) & F.col(group).eqNullSafe(F.col("span_group"))
    return placed.join(F.broadcast(spans), same).select(
        *(c for c in placed.columns if c not in ("range_no", "row_no")),
        (F.col("row_no") + F.col("span_shift")).cast("bigint").alias(name),
    )


def add_running(placed: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Adds running totals, the row itself included, over the order of ``placed``."""
    block = F.shiftright("row_no", _BLOCK_BITS)
    rows = placed.withColumns({"block_no": block, **{f"own_{n}": v for n, v in totals.items()}})
    sums = rows.groupBy("range_no", "block_no").agg(*(F.sum(f"own_{n}").alias(f"sum_{n}") for n in totals))
    # A row per 2^18 rows and one per range.
    earlier = Window.orderBy("range_no", "block_no").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        F.col("range_no").alias("b_range"),
        F.col("block_no").alias("b_block"),
        *(F.coalesce(F.sum(f"sum_{n}").over(earlier), F.lit(0)).alias(f"before_{n}") for n in totals),
    )
    inside = Window.partitionBy("range_no", "block_no").orderBy("row_no")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumns({f"in_{n}": F.sum(f"own_{n}").over(inside) for n in totals})
    same = (F.col("range_no") == F.col("b_range")) & (F.col("block_no") == F.col("b_block"))
    return summed.join(before, same).select(
        *placed.columns, *((F.col(f"before_{n}") + F.col(f"in_{n}")).alias(n) for n in totals)
    )
