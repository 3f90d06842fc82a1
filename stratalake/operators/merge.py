"""Row-level MERGE as pure functions: (target, source) in, new target out.

Stock Spark tables have no MERGE. An update is a left join of the target with
the source and an insert is an anti join of the source with the target, so the
target never needs a full outer join: when the source fits a broadcast the
target is not shuffled at all, and otherwise adaptive execution may split a
skewed target partition, which it cannot do below a full outer join. A target
known to have one row per key has no skew to split: with a large source both
are sorted once, together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.sources.sizes import fits_broadcast

_FROM_SOURCE = "__src_"
_MATCHED = "__matched"
_SIDE = "__side"
_ALONE = "__alone"


def _all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def check_unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` keys that occur twice, as a frame that raises when it meets one.

    The frame has no rows otherwise; union it into a result to run the check in
    the same job. Only key columns are read and counts are combined map-side.
    NULL keys match nothing and may repeat.
    """
    count = F.col("__n")
    usable = _all_of([F.col(k).isNotNull() for k in keys])
    text = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
    message = F.concat(
        F.lit("merge source has "), count.cast("string"),
        F.lit(f" rows for key ({', '.join(keys)}) = ("), text, F.lit(")"),
    )
    repeated = (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.when((count > 1) & usable, F.raise_error(message)).isNotNull())
    )
    return repeated.select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema)
    )


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    newer_by: Sequence[str] = (),
) -> DataFrame:
    """``target`` with ``columns`` replaced on every row whose key is in ``source``.

    Columns the target lacks are added, NULL on rows without a match. Values
    take the target's type. ``source`` must be unique on ``keys``. With
    ``newer_by`` a target row is left alone if it is the newer one by these
    columns of both, compared in turn; NULL is oldest.
    """
    if columns is None:
        columns = [c for c in source.columns if c not in keys]
    carried = [*keys, *columns, *(c for c in newer_by if c not in columns and c not in keys)]
    renamed = source.select(
        *(F.col(c).alias(_FROM_SOURCE + c) for c in carried),
        F.lit(True).alias(_MATCHED),
    )
    on = _all_of([target[k] == renamed[_FROM_SOURCE + k] for k in keys])
    matched = F.col(_MATCHED).isNotNull()
    if newer_by:
        arrived = F.struct(*(F.col(_FROM_SOURCE + c).cast(target.schema[c].dataType).alias(c) for c in newer_by))
        matched = matched & (arrived >= F.struct(*newer_by))
    out = []
    for field in target.schema:
        if field.name in columns:
            new = F.col(_FROM_SOURCE + field.name).cast(field.dataType)
            out.append(F.when(matched, new).otherwise(F.col(field.name)).alias(field.name))
        else:
            out.append(F.col(field.name))
    added = [c for c in columns if c not in target.columns]
    out += [F.when(matched, F.col(_FROM_SOURCE + c)).alias(c) for c in added]
    return target.join(renamed, on, "left").select(*out)


def new_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not have (NULL keys always count as new).

    If the optimizer would broadcast the source but not the target, the source
    first picks its own keys out of the target in a map-only pass, so that the
    anti join moves no more rows than the source has. Otherwise it is one anti
    join on the target's key columns.
    """
    known = target.select(*keys)
    if fits_broadcast(source) and not fits_broadcast(known):
        known = known.join(source.select(*keys), [*keys], "left_semi")
    return source.join(known, [*keys], "left_anti").select(*source.columns)


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """All rows of both, matched by name; a column missing on one side is NULL there."""
    return target.unionByName(rows, allowMissingColumns=True)


def _in_types_of(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``target`` has in its types."""
    types = {f.name: f.dataType for f in target.schema}
    casts = {
        f.name: F.col(f.name).cast(types[f.name])
        for f in rows.schema
        if f.name in types and f.dataType != types[f.name]
    }
    return rows.withColumns(casts) if casts else rows


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-only merge: the target plus source rows with a new key."""
    return append_rows(target, _in_types_of(target, new_keys(target, source, keys)))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    check: bool = True,
    newer_by: Sequence[str] = (),
    unique_target: bool = False,
) -> DataFrame:
    """Matched rows take every source column, unmatched source rows are added.

    With ``newer_by`` a matched row keeps its values if it is newer than the
    source row by these columns.

    Target rows without a match stay, target-only columns keep their value and
    source-only columns widen the result. A key that occurs twice in the source
    raises; pass ``check=False`` for a source that is unique by construction.
    The source is read for the update, the insert and the check: stage one that
    is expensive to compute.

    A target with one row per key (``unique_target``) and a source too large to
    broadcast are merged by one exchange of both, check included.
    """
    if unique_target and not fits_broadcast(source):
        return merge_sorted(target, source, keys, check, newer_by)
    added = _in_types_of(target, new_keys(target, source, keys))
    merged = append_rows(merge_update(target, source, keys, newer_by=newer_by), added)
    if not check:
        return merged
    return append_rows(merged, _in_types_of(target, check_unique_source(source, keys)))


def merge_sorted(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    check: bool = True,
    newer_by: Sequence[str] = (),
    dealt: Sequence[str] = (),
) -> DataFrame:
    """``merge_upsert`` into a target with one row per key as one pass over both sides together, sorted by key, the source row first.

    Each target row looks at the row before it and each source row at the one
    after, so a key needs no more than its own two rows; a second row of one
    side raises. A row with a NULL key is a group of its own. The columns are
    looked at one by one: as a struct they would cross the network twice.

    ``dealt`` names columns of both sides that follow from the key: the rows are
    exchanged by them, and come out sorted by them within each task.
    """
    usable = _all_of([F.col(k).isNotNull() for k in keys])
    row = F.monotonically_increasing_id() * 2  # the same numbers on both sides, hence odd and even
    sides = [
        rows.withColumns({_SIDE: F.lit(side), _ALONE: F.when(~usable, row + side)})
        for side, rows in enumerate((_in_types_of(target, source), target))
    ]
    both = sides[1].unionByName(sides[0], allowMissingColumns=True)
    if dealt:
        both = both.repartition(*dealt)
    of_key = Window.partitionBy(*dealt, *keys, _ALONE).orderBy(_SIDE)
    side, from_target = F.col(_SIDE), F.col(_SIDE) == 1
    fixed = {*keys, *dealt}
    looked_at = [_SIDE, *(c for c in source.columns if c not in fixed or c in newer_by)]
    seen = both.withColumns(
        {_FROM_SOURCE + c: F.lag(c).over(of_key) for c in looked_at} | {_MATCHED: F.lead(_SIDE).over(of_key)}
    )
    before = {c: F.col(_FROM_SOURCE + c) for c in looked_at}
    stays = from_target | F.col(_MATCHED).isNull()
    if check:
        text = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
        which = F.when(from_target, F.lit("target")).otherwise(F.lit("source"))
        message = F.concat(
            F.lit("merge "), which, F.lit(f" has more than one row for key ({', '.join(keys)}) = ("), text, F.lit(")")
        )
        stays = F.when(before[_SIDE] == side, F.raise_error(message).cast("boolean")).otherwise(stays)
    taken = from_target & (before[_SIDE] == 0)
    if newer_by:
        taken = taken & (F.struct(*(before[c].alias(c) for c in newer_by)) >= F.struct(*newer_by))
    columns = [*target.columns, *(c for c in source.columns if c not in target.columns)]
    return seen.filter(stays).select(
        *(
            F.when(taken, before[c]).otherwise(F.col(c)).alias(c) if c in source.columns and c not in fixed else F.col(c)
            for c in columns
        )
    )


def merge_latest(target: DataFrame, rows: DataFrame, keys: Sequence[str], newer_by: Sequence[str]) -> DataFrame:
    """``dedupe_latest`` of ``rows``, then ``merge_upsert`` of it with ``newer_by``, as one pass over both sides.

    For a target with one row per key and the same columns and types as
    ``rows``. The newest of all rows of a key stays; between equally new ones a
    source row goes before the target's, and the remaining columns decide among
    source rows, as in ``dedupe_latest``. Source rows with a NULL key are left
    out, target rows with one stay.
    """
    usable = _all_of([F.col(k).isNotNull() for k in keys])
    sides = (
        rows.filter(usable).withColumns({_SIDE: F.lit(0), _ALONE: F.lit(None).cast("bigint")}),
        target.withColumns({_SIDE: F.lit(1), _ALONE: F.when(~usable, F.monotonically_increasing_id())}),
    )
    rest = [c for c in rows.columns if c not in keys and c not in newer_by]
    newest = Window.partitionBy(*keys, _ALONE).orderBy(*(F.desc(c) for c in newer_by), F.asc(_SIDE), *(F.desc(c) for c in rest))
    both = sides[1].unionByName(sides[0])
    # The filter stands directly on the window, so that each map task sends one row per key.
    return both.withColumn(_FROM_SOURCE, F.row_number().over(newest)).filter(F.col(_FROM_SOURCE) == 1).select(*target.columns)
