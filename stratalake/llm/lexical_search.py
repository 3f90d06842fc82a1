"""Ranked lexical search by pipelined term partitioning.

The items' terms are dealt to a few owners: the rarest, which score highest, to
the first. Documents are dealt to buckets of bounded size. For each bucket and
item a bundle with the item's terms and a sparse accumulator of documents goes
from owner to owner; each stage is a cogroup of bundles and the owner's postings
of the bucket and adds integer contributions.

A stage drops accumulators that cannot reach the result any more: what an item's
terms of later owners can still add is bounded by their highest contributions,
and a bucket's own tenth score is a lower bound for the item's. Both are exact,
so no document of the result is lost, and ties stay. No stage holds more than
one bucket's accumulators of one group of items.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.llm.terms import words_between
from stratalake.sources import stage

# Between terms [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+.
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OWNERS, BUCKET_ROWS, GROUP_ITEMS = 4, 8192, 256
# Stands for a document of no id in an accumulator: such documents come last among equal scores.
_NO_ID = (1 << 63) - 1

_BUNDLE = (
    "bucket bigint, grp bigint, item bigint, terms array<bigint>, owners array<int>, most array<bigint>, "
    "rows array<bigint>, ids array<bigint>, scores array<bigint>"
)


def _terms(text: Column) -> Column:
    return words_between(text, _SEPARATORS)


def _postings(documents: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``n``, ``term``, ``tf`` for terms of the vocabulary; term -1 once for each document."""
    texts = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        _terms(F.col("text")).alias("words"),
    )
    # The empty word stands for the document itself. explode would split every text twice.
    placed = texts.select(
        "row",
        "doc_id",
        F.size("words").cast("bigint").alias("n"),
        F.explode_outer(F.concat(F.array(F.lit("")), "words")).alias("word"),
    )
    known = placed.join(vocabulary, "word")
    return known.groupBy("row", "doc_id", "n", "term").agg(F.count(F.lit(1)).alias("tf"))


def _listed(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A list column as its values and the offsets of each row."""
    column = table[name].combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), offsets


def _owner_stage(owner: int, last: bool, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The function of one owner: one bucket's bundles and the owner's postings in it."""

    kinds = {n: pa.int64() for n in ("bucket", "grp", "item")}
    kinds |= {n: pa.list_(pa.int32() if n == "owners" else pa.int64()) for n in ("terms", "owners", "most", "rows", "ids", "scores")}

    def advance(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        bundles = bundles.cast(pa.schema(kinds))
        if bundles.num_rows == 0:
            return bundles
        rows, offsets = _listed(bundles, "rows")
        ids, scores = _listed(bundles, "ids")[0], _listed(bundles, "scores")[0]
        term = postings["term"].to_numpy()
        order = np.argsort(term, kind="stable")
        term = term[order]
        added = postings["added"].to_numpy()[order]
        both = np.concatenate([postings["row"].to_numpy(), rows[offsets[0] : offsets[-1]]])
        both_ids = np.concatenate([postings["doc_id"].to_numpy(), ids[offsets[0] : offsets[-1]]])
        here, first, place = np.unique(both, return_index=True, return_inverse=True)
        here_ids = both_ids[first]
        at, held = place[: len(term)][order], place[len(term) :]
        names, starts = np.unique(term, return_index=True)
        ends = np.append(starts, len(term))[1:]
        lists = {int(t): (a, b) for t, a, b in zip(names, starts, ends, strict=True)}
        totals = np.zeros(len(here), np.int64)
        out = []
        item_terms, item_owners, item_most = (bundles[c].to_pylist() for c in ("terms", "owners", "most"))
        for i in range(bundles.num_rows):
            a, b = offsets[i] - offsets[0], offsets[i + 1] - offsets[0]
            totals[held[a:b]] = scores[offsets[i] : offsets[i + 1]]
            for name, by in zip(item_terms[i], item_owners[i], strict=True):
                if by == owner and name in lists:
                    x, y = lists[name]
                    totals[at[x:y]] += added[x:y]
            to_come = sum(m for m, by in zip(item_most[i], item_owners[i], strict=True) if by > owner)
            kept = np.flatnonzero(totals)
            sums = totals[kept]
            totals[kept] = 0
            if len(kept) > k:
                bound = np.partition(sums, len(sums) - k)[len(sums) - k]
                enough = sums + to_come >= bound
                kept, sums = kept[enough], sums[enough]
            if last and len(kept) > k:
                best = np.lexsort((here[kept], here_ids[kept], -sums))[:k]
                kept, sums = kept[best], sums[best]
            out.append((here[kept], here_ids[kept], sums))
        ends = pa.array(np.cumsum([0, *(len(s) for _, _, s in out)]), pa.int32())
        done = bundles
        for name, values in zip(("rows", "ids", "scores"), zip(*out, strict=True), strict=True):
            flat = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values), pa.int64()))
            done = done.set_column(done.column_names.index(name), name, flat)
        return done

    return advance


def rank_documents(
    documents: DataFrame,
    items: DataFrame,
    k: int = 10,
    owners: int = OWNERS,
    bucket_rows: int = BUCKET_ROWS,
    group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """Each item's ``k`` best documents: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Null and empty texts have no terms: they match nothing and are not counted
    in the number of documents. Documents of one doc_id are documents of their
    own; a null doc_id comes last among equal scores. Items that repeat both
    item_id and text are one; those that share only the id are ranked each for
    itself, and so are items without an id. Without items or documents there
    are no rows. Other columns of both tables are left out.
    """
    spark = documents.sparkSession
    asked = items.select("item_id", "text").distinct().select("item_id", F.array_distinct(_terms(F.col("text"))).alias("words"))
    asked = stage(asked.filter(F.size("words") > 0).withColumn("item", F.monotonically_increasing_id()), "search-items")
    groups = max(1, -(-asked.count() // group_items))
    asked_terms = asked.select(
        "item", F.pmod(F.xxhash64("item"), F.lit(groups)).alias("grp"), F.explode("words").alias("word")
    )
    words = asked_terms.select("word").distinct().withColumn("term", F.monotonically_increasing_id())
    empty = spark.range(1).select(F.lit("").alias("word"), F.lit(-1).cast("bigint").alias("term"))
    vocabulary = stage(words.union(empty), "search-terms")
    postings = stage(_postings(documents, vocabulary), "search-postings")

    whole = postings.filter("term < 0").agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")
    )
    total = whole.first()
    n_docs, n_terms, buckets = total["docs"], max(total["terms"], 1), max(1, -(-total["all"] // bucket_rows))

    length = F.lit(10) + F.expr(f"(90 * n * {n_docs}L) div {n_terms}L")
    share = F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)")
    found = postings.filter("term >= 0").withColumn("m", length).withColumn("share", share)
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weights = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("share").alias("most_share"))
    weights = weights.select("term", "df", weight.alias("w"), (weight * F.col("most_share")).alias("most"))
    weights = stage(weights, "search-weights")
    # Owners have about the same number of postings each: cuts through the weights, a few numbers.
    cuts = weights.agg(F.percentile("w", [1 - (i + 1) / owners for i in range(owners - 1)], F.col("df"))).first()[0] if owners > 1 else []
    owner = sum([(F.col("w") < cut).cast("int") for cut in cuts or []], F.lit(0))
    weights = weights.withColumn("owner", owner)

    by_word = asked_terms.join(vocabulary, "word").join(weights, "term")
    queries = by_word.groupBy("grp", "item").agg(F.sort_array(F.collect_list(F.struct("term", "owner", "most"))).alias("q"))
    nothing = F.array().cast("array<bigint>")
    bundles = queries.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))).alias("bucket"),
        "grp",
        "item",
        F.col("q.term").alias("terms"),
        F.col("q.owner").alias("owners"),
        F.col("q.most").alias("most"),
        nothing.alias("rows"),
        nothing.alias("ids"),
        nothing.alias("scores"),
    )
    # A posting goes to the groups of items that ask for its term.
    wanted = by_word.select("term", "grp", "w", "owner").distinct()
    scored = stage(
        found.join(wanted, "term")
        .select(
            F.pmod(F.xxhash64("row"), F.lit(buckets)).alias("bucket"),
            "grp",
            "owner",
            "term",
            "row",
            F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"),
            (F.col("w") * F.col("share")).alias("added"),
        )
        .filter("added > 0"),
        "search-scores",
    )
    # As many tasks as twice the buckets, however small their bytes: the work of a bucket is its items' times its rows'.
    tasks, key = 2 * buckets * groups, ["bucket", "grp"]
    for number in range(owners):
        owned = scored.filter(F.col("owner") == number).select("bucket", "grp", "term", "row", "doc_id", "added")
        step = _owner_stage(number, number == owners - 1, k)
        left, right = bundles.repartition(tasks, *key), owned.repartition(tasks, *key)
        bundles = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(step, _BUNDLE)

    best = bundles.select("item", F.explode(F.arrays_zip("rows", "ids", "scores")).alias("d")).select("item", "d.*")
    order = Window.partitionBy("item").orderBy(F.desc("scores"), F.asc("ids"), F.asc("rows"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select(
        "item_id", "rank", F.nullif("ids", F.lit(_NO_ID)).alias("doc_id"), F.col("scores").alias("score")
    )
