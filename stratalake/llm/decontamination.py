"""Benchmark decontamination: a prefix-filtered join of item windows with whole documents.

A window is ten consecutive words of an item, or all of a shorter item; its
tokens are its five-word shingles (a window of fewer words is one shingle).
Documents are read once: only positions at which a shingle of some window
stands are kept. Shingles are ordered by how often the documents have them. As
a window occurs only where all its shingles do, its necessary prefix is the
rarest one; windows with a shingle that no document has are gone before the
join. A place found by its prefix must leave room for the whole window before
and behind it, and stays if the shingles that cover the window stand at their
offsets.

No text is compared with every window, no group is gathered in a task: joins go
by shingle or by document and position, and a window of very many documents
meets only its own occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.llm.terms import words_between
from stratalake.sources import stage

# Between words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of texts with A-Z lowered.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 10, 5


def _words(text: Column) -> Column:
    return words_between(text, _SEPARATORS)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: ``win`` (their number), ``words``, ``len``, ``item_ids``."""
    cut = items.select("item_id", _words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    cut = cut.withColumn("at", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))))
    cut = cut.select("item_id", F.slice("words", F.col("at") + 1, window).alias("words"))
    # An item has no more windows than words; a window that many items share keeps the set of their ids.
    same = cut.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("item_ids"))
    return same.select(F.monotonically_increasing_id().alias("win"), "words", F.size("words").alias("len"), "item_ids")


def _shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """Every shingle of every window with its offset; windows shorter than a shingle are one."""
    width = F.least(F.col("len"), F.lit(shingle))
    placed = windows.select(
        "win", "len", "words", width.alias("width"), F.explode(F.sequence(F.lit(0), F.col("len") - width)).alias("offset")
    )
    text = F.array_join(F.slice("words", F.col("offset") + 1, F.col("width")), " ")
    return placed.select("win", "len", "width", "offset", text.alias("shingle"))


def _occurrences(documents: DataFrame, known: DataFrame, widths: list[int]) -> DataFrame:
    """Each document's positions of known shingles, and one row at position -1 that stands for the document.

    The shingle of that row is empty, as no other is.
    """
    texts = documents.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", _words(F.col("text")).alias("words")
    )
    # explode_outer: explode would make Spark split every text once more, to see whether it has words.
    places = texts.select(
        "row",
        "doc_id",
        "words",
        F.size("words").alias("n_words"),
        F.explode_outer(F.sequence(F.lit(-1), F.size("words") - 1)).alias("pos"),
    )

    def shingle(width: int) -> Column:
        there = [F.get("words", F.col("pos") + i) for i in range(width)]
        inside = (F.col("pos") >= 0) & (F.col("pos") + width <= F.col("n_words"))
        return F.when(inside, F.concat_ws(" ", *there)).when(F.col("pos") < 0, F.lit(""))

    if len(widths) == 1:
        found = places.withColumn("shingle", shingle(widths[0]))
    else:
        found = places.withColumn("shingle", F.explode(F.array_distinct(F.array(*(shingle(w) for w in widths)))))
    return found.select("row", "doc_id", "n_words", "pos", "shingle").join(known, "shingle")


def find_windows(documents: DataFrame, windows: DataFrame, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Where ``windows`` occur: (``row``, ``doc_id``, ``n_words``) of all documents and (``row``, ``win``, ``start``, ``len``)."""
    spark = documents.sparkSession
    tokens = stage(_shingles(windows, shingle), "window-shingles")
    # At most five numbers.
    widths = sorted(r["width"] for r in tokens.select("width").distinct().collect()) or [shingle]
    empty = spark.range(1).select(F.lit("").alias("shingle"))
    known = stage(tokens.select("shingle").distinct().union(empty), "known-shingles")
    seen = stage(_occurrences(documents, known, widths), "shingle-places")
    rows = seen.filter("pos < 0").select("row", "doc_id", "n_words")
    places = seen.filter("pos >= 0")

    # The order by rarity: a window stays only if the documents have all its shingles.
    often = places.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    ranked = tokens.join(often, "shingle", "left")
    prefix = ranked.groupBy("win", "len", "width").agg(
        F.min(F.struct("often", "shingle", "offset")).alias("rarest"),
        F.bool_and(F.col("often").isNotNull()).alias("possible"),
    )
    prefix = stage(
        prefix.filter("possible").select(
            "win", "len", "width", F.col("rarest.shingle").alias("shingle"), F.col("rarest.offset").alias("offset")
        ),
        "window-prefixes",
    )
    room = (F.col("pos") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("len") <= F.col("n_words"))
    candidates = (
        places.join(prefix, "shingle")
        .filter(room)
        .select("row", "win", "len", (F.col("pos") - F.col("offset")).alias("start"), "width")
    )
    # Shingles at these offsets cover the window: each full width, and the last that fits.
    cover = F.array_distinct(
        F.concat(F.sequence(F.lit(0), F.col("len") - F.col("width"), F.col("width")), F.array(F.col("len") - F.col("width")))
    )
    needed = prefix.select("win", F.explode(cover).alias("offset"), F.size(cover).alias("parts")).join(
        tokens.select("win", "offset", "shingle"), ["win", "offset"]
    )
    asked = candidates.join(needed, "win").select(
        "row", "win", "start", "len", "parts", (F.col("start") + F.col("offset")).alias("pos"), "shingle"
    )
    verified = asked.join(places.select("row", "pos", "shingle"), ["row", "pos", "shingle"])
    whole = verified.groupBy("row", "win", "start", "len", "parts").agg(F.count(F.lit(1)).alias("found"))
    return rows, whole.filter("found = parts").select("row", "win", "start", "len")


def decontaminate(documents: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    A word is hit if it lies in an occurrence of a window. Null texts and those
    without words have no windows and no hits; an item without words has no
    window. Rows that repeat a document each get a row; rows that repeat an
    item_id are one item, whose windows are those of all its texts. A row
    without an item_id hits words but has no name to be counted or listed by.
    Without items nothing is hit; without documents there are no rows. Other
    columns of both tables are left out.
    """
    windows = stage(item_windows(items, window), "item-windows")
    rows, found = find_windows(documents, windows, shingle)
    found = stage(found, "window-places")

    # Words of overlapping occurrences count once: what lies behind all earlier ends.
    spans = found.groupBy("row", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new_from = F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    hits = (
        spans.withColumn("new_from", new_from)
        .groupBy("row")
        .agg(F.sum(F.greatest(F.col("end") - F.col("new_from"), F.lit(0))).cast("bigint").alias("n_hit"))
    )
    # Which items: a document's windows first lose their repeats, then its items do.
    named = (
        found.select("row", "win")
        .distinct()
        .join(windows.select("win", "item_ids"), "win")
        .select("row", F.explode("item_ids").alias("item"))
        .distinct()
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    judged = rows.join(hits, "row", "left").join(named, "row", "left")
    return judged.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
