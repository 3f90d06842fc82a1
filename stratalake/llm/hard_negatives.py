"""Hard-negative mining by threshold joins over an inverted index with norm bounds.

Vectors become integers and are dealt to blocks. A block's index goes by
dimension, those of most energy first. With a threshold t on scores, a row is
left out of the lists of all dimensions behind which the norm of what remains of
it, times an anchor's norm, stays below t: that part alone cannot reach t.
Anchors walk the lists, add up partial scores and drop rows whose partial score
and remaining norms cannot reach t; the dimensions left out are added for the
rows that survive.

Windows (the first five rows of the same label; the first ten of other labels
between two scores) are asked for with thresholds that fall until they are full.
This happens on one block first. What fills a window there bounds it from below
everywhere, so the join with all blocks starts from these thresholds and returns
at most a window's size per block and anchor. Any rows fill a bound, so results
are exact. Anchors stream past a block, which is all that a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.sources import stage

BLOCK_ROWS, LEAST_BLOCK_ROWS = 1 << 16, 1 << 10
_STEP = 8  # dimensions between two looks at the bounds
_CELLS = 1 << 22  # partial scores held at a time
_HIGHEST = (1 << 62) - 1
# Shares of the way from a window's upper end down to its lower one.
_LADDER = (0.25, 0.5, 1.0)

_FOUND = "anchor bigint, w bigint, vec_id bigint, uid bigint, score bigint"
_ENCODED = "vec_id bigint, label bigint, vec binary, wide boolean"
_WINDOWS = "array<struct<w: bigint, lo: bigint, hi: bigint, floor: bigint>>"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part, with floor(256 x) of each component in two or eight bytes."""
    for batch in batches:
        vec_id, label, vectors = batch.columns
        vectors = vectors.cast(pa.large_list(pa.float64()))
        ends = vectors.offsets.to_numpy()
        with np.errstate(over="ignore", invalid="ignore"):
            parts = np.floor(256 * vectors.values.to_numpy(zero_copy_only=False))
        odd = np.concatenate([[0], np.cumsum(~np.isfinite(parts))])
        usable = (odd[ends[1:]] == odd[ends[:-1]]) & vectors.is_valid().to_numpy(False) & label.is_valid().to_numpy(False)
        take = np.flatnonzero(usable)
        vecs, wide = [], []
        for i in take:
            part = np.clip(parts[ends[i] : ends[i + 1]], -(2.0**62), 2.0**62)
            wide.append(bool(len(part)) and bool(np.abs(part).max() >= 1 << 15))
            vecs.append(part.astype("<i8" if wide[-1] else "<i2").tobytes())
        yield pa.RecordBatch.from_arrays(
            [vec_id.take(pa.array(take)), label.take(pa.array(take)), pa.array(vecs, pa.binary()), pa.array(wide, pa.bool_())],
            names=["vec_id", "label", "vec", "wide"],
        )


def _matrix(vecs: list[bytes], wide: list[bool], least: int = 0) -> np.ndarray:
    """Integer vectors as the rows of a matrix; shorter ones end in zeros."""
    size = [len(v) // (8 if w else 2) for v, w in zip(vecs, wide, strict=True)]
    out = np.zeros((len(vecs), max([least, *size])), np.int64)
    for i, (v, w) in enumerate(zip(vecs, wide, strict=True)):
        out[i, : size[i]] = np.frombuffer(v, "<i8" if w else "<i2")
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    """Norms of what remains of each row from each dimension on; a column more than ``x``."""
    tail = np.cumsum((x**2)[:, ::-1], 1)[:, ::-1]
    return np.sqrt(np.concatenate([tail, np.zeros((len(x), 1))], 1))


class _Block:
    """One block's rows, its dimensions in order of energy."""

    def __init__(self, rows: dict[str, list]) -> None:
        keep = list(dict(zip(rows["uid"], range(len(rows["uid"])), strict=True)).values())  # repeated rows count once
        own = {name: [values[i] for i in keep] for name, values in rows.items()}
        self.ints = _matrix(own["vec"], own["wide"])
        self.uid = np.array(own["uid"], np.int64)
        self.label = np.array(own["label"], np.int64)
        self.ids = own["vec_id"]
        self.id_order = np.array([_HIGHEST if i is None else i for i in self.ids], np.int64)
        x = self.ints.astype(np.float64)
        self.dims = np.argsort(-(x**2).sum(0), kind="stable")
        self.x = np.ascontiguousarray(x[:, self.dims])
        self.left = _norms(self.x)
        self.most = np.abs(x).max(initial=0)

    def pairs(self, asked: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all scores of ``asked`` (integer vectors) that reach ``least``."""
        n, d = len(self.x), self.x.shape[1]
        q = asked[:, :d].astype(np.float64)
        if q.shape[1] < d:
            q = np.pad(q, ((0, 0), (0, d - q.shape[1])))
        q = np.ascontiguousarray(q[:, self.dims])
        q_left = _norms(q)
        # Room for what adding and rooting numbers of this size may round off.
        slack = 1e-6 + 1e-9 * q_left[:, :1] * self.left[:, 0].max(initial=0)
        reach = least[:, None] - slack
        unit = np.min(np.maximum(reach[:, 0], 0) / np.maximum(q_left[:, 0], 1e-300), initial=np.inf)
        # The index: dimensions in which a row is listed, rounded up to whole steps; rows listed longest first.
        listed = -(-(self.left[:, :d] >= unit).sum(1) // _STEP) * _STEP if unit > 0 else np.full(n, d)
        listed = np.minimum(listed, d)
        order = np.argsort(-listed, kind="stable")
        listed, x, left = listed[order], self.x[order], self.left[order]
        sums, done = np.zeros((len(q), n)), 0
        alive = np.ones((len(q), n), bool)
        while True:
            remains = left[np.arange(n), np.minimum(listed, done)]
            alive = sums + q_left[:, np.minimum(listed, done)] * remains >= reach
            if done >= d or alive.mean() < 0.125:
                break
            until = min(done + _STEP, d)
            owners = int(np.searchsorted(-listed, -done, "left"))  # rows listed beyond ``done``
            sums[:, :owners] += q[:, done:until] @ x[:owners, done:until].T
            done = until
        a, r = np.nonzero(alive)
        score, since = sums[a, r], np.minimum(listed[r], done)
        # What is not in the lists, and what is left of them, for the rows that survive.
        for start in range(0, d, _STEP):
            until, due = min(start + _STEP, d), since <= start
            score[due] += np.einsum("ij,ij->i", q[a[due], start:until], x[r[due], start:until])
            keep = ~due | (score + q_left[a, until] * left[r, until] >= reach[a, 0])
            a, r, score, since = a[keep], r[keep], score[keep], since[keep]
        r = order[r]
        if np.abs(asked).max(initial=0) * self.most * max(d, 1) >= 2.0**53:
            width = min(d, asked.shape[1])
            exact = (asked[a, :width] * self.ints[r, :width]).sum(1)
        else:
            exact = np.rint(score).astype(np.int64)
        keep = exact >= least[a]
        return a[keep], r[keep], exact[keep]

    def search(self, anchors: dict[str, list], same: bool, k: int, ladder: tuple[float, ...]) -> Iterator[tuple]:
        """(anchor, window, row, score) of the first ``k`` rows of every window of every anchor."""
        asked = _matrix(anchors["vec"], anchors["wide"], self.x.shape[1])
        norms = np.sqrt((asked.astype(np.float64) ** 2).sum(1)) * self.left[:, 0].max(initial=0)
        windows = anchors["windows"]
        bottom = np.array([min(max(w["lo"], w["floor"]) for w in ws) for ws in windows], np.int64)
        top = np.array([max(w["hi"] for w in ws) for ws in windows], np.float64)
        top = np.maximum(np.minimum(top, norms), bottom)
        chunk = max(1, _CELLS // max(len(self.x), 1))
        for first in range(0, len(asked), chunk):
            open_ = np.arange(first, min(first + chunk, len(asked)))
            for part in ladder:
                least = np.floor(top[open_] - (top[open_] - bottom[open_]) * part).astype(np.int64)
                least = np.maximum(least, bottom[open_]) if part < 1 else bottom[open_]
                a, r, score = self.pairs(asked[open_], least)
                labels = np.array([anchors["label"][i] for i in open_], np.int64)
                uids = np.array([anchors["uid"][i] for i in open_], np.int64)
                fits = (self.label[r] == labels[a]) == same
                fits &= self.uid[r] != uids[a]
                a, r, score = a[fits], r[fits], score[fits]
                sort = np.lexsort((self.uid[r], self.id_order[r], -score, a))
                a, r, score = a[sort], r[sort], score[sort]
                bounds = np.searchsorted(a, np.arange(len(open_) + 1))
                still = []
                for at, i in enumerate(open_):
                    x, y = bounds[at], bounds[at + 1]
                    full, found = True, []
                    for w in windows[i]:
                        # Scores fall, so a window is a range of them.
                        from_ = x + int(np.searchsorted(-score[x:y], -w["hi"], "left"))
                        to = x + int(np.searchsorted(-score[x:y], -max(w["lo"], w["floor"]), "right"))
                        full &= to - from_ >= k or least[at] <= max(w["lo"], w["floor"])
                        found += [(i, w["w"], int(r[j]), int(score[j])) for j in range(from_, min(to, from_ + k))]
                    if full or part == ladder[-1]:
                        yield from found
                    else:
                        still.append(i)
                open_ = np.array(still, np.int64)
                if not len(open_):
                    break


def _searcher(same: bool, k: int, ladder: tuple[float, ...]):
    """Reads partitions sorted by block, rows before anchors."""
    names = ("vec_id", "label", "uid", "vec", "wide")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, block = None, {n: [] for n in names}, None
        for batch in batches:
            blocks, kinds = batch["block"].to_numpy(), batch["kind"].to_numpy()
            turns = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for first, last in zip([0, *turns], [*turns, len(blocks)], strict=True):
                if first == last:
                    continue
                part = batch.slice(first, last - first)
                if blocks[first] != at:
                    at, rows, block = blocks[first], {n: [] for n in names}, None
                if kinds[first] == 0:
                    for n in names:
                        rows[n] += part[n].to_pylist()
                    continue
                if block is None:
                    block = _Block(rows)
                anchors = {n: part[n].to_pylist() for n in (*names, "windows")}
                found = list(block.search(anchors, same, k, ladder))
                anchor, w, row, score = zip(*found, strict=True) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([anchors["uid"][i] for i in anchor], pa.int64()),
                        pa.array(w, pa.int64()),
                        pa.array([block.ids[j] for j in row], pa.int64()),
                        pa.array([int(block.uid[j]) for j in row], pa.int64()),
                        pa.array(score, pa.int64()),
                    ],
                    names=["anchor", "w", "vec_id", "uid", "score"],
                )

    return search


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("uid"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _threshold_join(
    rows: DataFrame, anchors: DataFrame, windows: DataFrame, blocks: int, same: bool, k: int
) -> DataFrame:
    """The first ``k`` rows of every window (``anchor``, ``w``, ``lo``, ``hi``) over all rows, with ``rank``."""

    def over(part: DataFrame, asked: DataFrame, first: int, last: int, ladder: tuple[float, ...]) -> DataFrame:
        sets = asked.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("w", "lo", "hi", "floor"))).alias("windows"))
        questions = anchors.join(sets, anchors["uid"] == sets["anchor"]).drop("anchor")
        questions = questions.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(last))))
        both = part.select("*", F.lit(0).alias("kind"), F.lit(None).cast(_WINDOWS).alias("windows")).unionByName(
            questions.withColumn("kind", F.lit(1))
        )
        dealt = both.repartitionById(last + 1 - first, F.col("block") - first).sortWithinPartitions("block", "kind")
        return dealt.mapInArrow(_searcher(same, k, ladder), _FOUND)

    unknown = windows.withColumn("floor", F.col("lo"))
    sample = _first(over(rows.filter("block = 0"), unknown, 0, 0, _LADDER), k)
    full = sample.groupBy("anchor", "w").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k)
    known = windows.join(full, ["anchor", "w"], "left").select(*windows.columns, F.coalesce("least", "lo").alias("floor"))
    return _first(over(rows, stage(known, "window-floors"), 0, blocks - 1, (1.0,)), k)


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a
    condition on ``vec_id``. Scores are inner products of floor(256 x). A
    negative's score lies between ``low`` and ``high`` hundredths of the
    positive's, so positives below 0 have none.

    Rows without a label or a vector, or with a component that is null or not
    finite, take no part. Rows that repeat id, label and vector count once; rows
    that share only the id are rows of their own, and anchors of their own. A
    row without an id is no anchor and comes last among equal scores. Of vectors
    of different lengths the shorter counts as ended by zeros; components are
    cut at 2^62 and scores are kept in 64 bits. Other columns are left out, and
    an empty table gives no rows.
    """
    encoded = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding"
    ).mapInArrow(_encode, _ENCODED)
    encoded = stage(encoded.withColumn("uid", F.xxhash64("vec_id", "label", "vec")), "vectors")
    spark = vectors.sparkSession
    total = encoded.count()
    # Blocks for all cores as long as they are not tiny, never more rows than a task holds at ease.
    share = -(-total // (3 * spark.sparkContext.defaultParallelism))
    blocks = max(1, -(-total // min(block_rows, max(share, LEAST_BLOCK_ROWS))))
    rows = encoded.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int"))
    anchors = stage(encoded.filter(is_anchor).dropDuplicates(["uid"]), "anchors")

    first = anchors.select(F.col("uid").alias("anchor"), F.lit(0).cast("bigint").alias("w"))
    first = first.withColumns({"lo": F.lit(0).cast("bigint"), "hi": F.lit(_HIGHEST)})
    near = _threshold_join(rows, anchors, first, blocks, True, positives)
    near = stage(near.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("w")), "positives")
    bounds = near.select("anchor", "w").distinct()
    bounds = bounds.withColumns({"lo": F.expr(f"({low} * w + 99) div 100"), "hi": F.expr(f"({high} * w) div 100")})
    bounds = stage(bounds.filter("lo <= hi"), "negative-windows")
    far = _threshold_join(rows, anchors, bounds, blocks, False, negatives)
    named = anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    mined = near.join(far, ["anchor", "w"]).join(named, "anchor")
    return mined.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("w").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
