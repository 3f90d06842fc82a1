"""Keep the newest row of each business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

NEWEST_FIRST = ("imported_date", "source_file")
_PLACE = "__place"


def dedupe_latest(
    rows: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str] = NEWEST_FIRST,
    drop_null_keys: bool = True,
) -> DataFrame:
    """The row with the greatest ``newest_first`` values per key.

    Rows with a NULL key are left out, or with ``drop_null_keys=False`` grouped
    like any other value. An empty string is a key. Ties are broken by the
    remaining columns, so the result does not depend on file or task order.
    NULL sorts below every value.

    The filter stands directly on the window, which lets Spark keep only the
    first row per key in each map task, before the exchange: a key that owns a
    third of the input sends one row per map task over the network.
    """
    if drop_null_keys:
        rows = rows.dropna(subset=list(keys))
    rest = [c for c in rows.columns if c not in keys and c not in newest_first]
    newest = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in [*newest_first, *rest]))
    return rows.withColumn(_PLACE, F.row_number().over(newest)).filter(F.col(_PLACE) == 1).drop(_PLACE)
