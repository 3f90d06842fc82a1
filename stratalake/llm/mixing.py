"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.llm.ranges import add_running, place_rows
from stratalake.sources import stage

WORD = r"[^\x20\x09-\x0D]+"
_WHITE = "\t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    spaced = F.trim(F.translate(text, _WHITE, " " * len(_WHITE)))
    words = F.size(F.split(spaced, " +"))
    return F.when(F.coalesce(spaced, F.lit("")) == "", 0).otherwise(words).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """Per source its ``target``: shares by weight of all sizes, none above ``max_repeats`` times its own.

    ``sizes`` has source and source_size. Sources take ``weights`` in turn, by
    code point, null last. What sources cannot take is shared anew by weight: in
    order of size per weight, sources fill up as long as their share of what is
    left exceeds their limit; from the first that fits on, all get their share.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), F.col("turn") + 1)
    limits = sizes.withColumn("turn", (F.row_number().over(place) - 1) % len(weights)).select(
        "source",
        "source_size",
        (F.row_number().over(place) - 1).alias("source_no"),
        weight.cast("bigint").alias("weight"),
        (F.col("source_size") * max_repeats).alias("limit"),
    )
    # limit / weight without rounding: the product of the weights makes it whole.
    common = 1
    for w in set(weights):
        common *= int(w)
    filling = Window.orderBy((F.col("limit") * common / F.col("weight")).cast("bigint"), "source_no")
    so_far = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    shares = limits.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(so_far), F.lit(0))).alias("left"),
        F.sum("weight").over(rest).alias("left_weight"),
        F.row_number().over(filling).alias("step"),
    )
    fits = F.col("left") * F.col("weight") <= F.col("limit") * F.col("left_weight")
    first = F.min(F.when(fits, F.struct("step", "left", "left_weight"))).over(everything)
    settled = shares.withColumn("first", first)
    share = (F.col("weight") * F.col("first.left")).cast("double") / F.col("first.left_weight")
    return settled.select(
        "source",
        "source_no",
        "source_size",
        F.when(F.col("step") < F.col("first.step"), F.col("limit").cast("double"))
        .otherwise(share)
        .alias("target"),
    )


def mix_sources(
    documents: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3, key: Column | None = None
) -> DataFrame:
    """How many times a mix of all words takes each document, so that sources meet their targets.

    Size is a document's number of words (null text: 0). Each source's documents
    are shuffled by a hash of their id and queued up to ``max_repeats`` times over;
    the virtual finish time of a place in the queue is the words up to its end
    divided by the source's target. All places are sorted by finish time, and
    the mix ends where the running total reaches the sum of all sizes.

    Repeated rows are places of their own, in any order among themselves. A null
    source is a source. Documents without words are taken with what precedes
    them, for no words. An empty table gives no rows. Other columns are not
    looked at, so none can clash. ``key`` tells rows of one id apart and is
    returned as ``doc_key``.

    Columns: doc_id, source, size, source_size, target, repeats, taken.
    """
    own = [] if key is None else ["doc_key"]
    base = stage(
        documents.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("shuffle"),
            *([] if key is None else [key.alias("doc_key")]),
        ),
        "mix-sizes",
    )
    sizes = stage(base.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = stage(source_targets(sizes, weights, max_repeats), "mix-targets").select(
        F.col("source").alias("of_source"), "source_no", "source_size", "target"
    )
    queued = base.join(targets, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    order = ["source_no", "shuffle", "doc_id", "size", *own]
    queue = add_running(place_rows(queued, order, "mix-queue"), {"words": F.col("size")})
    # The queue runs through all sources in turn; what lies before a source is its sources' sizes.
    starts = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = targets.select(
        F.col("source_no").alias("of_no"),
        F.coalesce(F.sum("source_size").over(starts), F.lit(0)).alias("words_before"),
    )
    queue = stage(
        queue.join(offsets, F.col("source_no") == F.col("of_no")).select(
            "doc_id",
            "source",
            "size",
            "source_no",
            "source_size",
            "target",
            "shuffle",
            *own,
            (F.col("words") - F.col("words_before")).alias("words"),
        ),
        "mix-queued",
    )
    turn = F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))
    places = (
        queue.select("*", turn.alias("turn"))
        .filter((F.col("turn") == 0) | (F.col("turn") * F.col("source_size") < F.col("target")))
        .select("size", *_when(F.col("turn")))
    )
    finish = ["finish", "source_no", "turn", "shuffle", "doc_id"]
    total = sizes.agg(F.sum("source_size").alias("budget"))
    line = add_running(place_rows(places, finish, "mix-places"), {"taken_words": F.col("size")})
    budget = (total.first()["budget"]) or 0
    last = line.filter(F.col("taken_words") <= budget).agg(F.max(F.struct(*finish)).alias("last")).first()["last"]
    if last is None:
        return queue.select(
            "doc_id", "source", "size", "source_size", "target",
            F.lit(0).alias("repeats"), F.lit(0).cast("bigint").alias("taken"), *own,
        )
    end = F.struct(
        *(F.lit(last[c]).cast(t).alias(c) for c, t in dict(queue.dtypes, finish="double", turn="int").items() if c in finish)
    )
    end = F.struct(*(end.getField(c).alias(c) for c in finish))
    repeats = F.lit(0)
    for k in range(max_repeats):
        queued_so = (F.lit(k) == 0) | (F.lit(k) * F.col("source_size") < F.col("target"))
        place = F.struct(*_when(F.lit(k)))
        repeats = repeats + (queued_so & (place <= end)).cast("int")
    return queue.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        repeats.alias("repeats"),
        (F.col("size") * repeats).alias("taken"),
        *own,
    )


def _when(turn: Column) -> list[Column]:
    """The virtual finish time of a document in ``turn``, and what decides between equal ones."""
    words = turn * F.col("source_size") + F.col("words")
    finish = F.when(F.col("target") > 0, words.cast("double") / F.col("target")).otherwise(F.lit(0.0))
    return [
        finish.alias("finish"),
        F.col("source_no"),
        turn.cast("int").alias("turn"),
        F.col("shuffle"),
        F.col("doc_id"),
    ]
