"""Line dedup: documents that share runs of lines are aligned, and the later one loses all common blocks."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratalake.llm.names import free_name
from stratalake.llm.words import U64, line_table, mix
from stratalake.llm.worker import slices, utf8
from stratalake.sources import stage

MIN_WORDS = 50
_BASE = U64(0x9E3779B97F4A7C15)
LINES = "doc_id long, doc_key long, lines array<long>, words array<int>"


def doc_key(doc_id: Column, text: Column) -> Column:
    """Tells rows of the same id but other text apart."""
    return F.xxhash64(doc_id, text)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes and word counts of each text's lines."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for a, b in slices(offsets):
            hashes, words, bounds = line_table(data[offsets[a] : offsets[b]], offsets[a : b + 1])
            ends = pa.array(bounds, pa.int32())
            yield pa.record_batch(
                [
                    batch.column("doc_id").slice(a, b - a),
                    batch.column("doc_key").slice(a, b - a),
                    pa.ListArray.from_arrays(ends, pa.array(hashes.view(np.int64))),
                    pa.ListArray.from_arrays(ends, pa.array(words.astype(np.int32))),
                ],
                ["doc_id", "doc_key", "lines", "words"],
            )


def run_hashes(lines: np.ndarray, words: np.ndarray, bounds: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the hash of the shortest run of lines from it on with ``min_words`` words.

    ``bounds`` are the offsets of each text's lines. Returns the hashes and the
    lines that begin one: those from which the text goes on for long enough.
    """
    n = len(lines)
    up_to = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    stop = np.searchsorted(up_to, up_to[:-1] + min_words)  # the end of the run
    text_end = np.repeat(bounds[1:], np.diff(bounds))
    begins = np.flatnonzero((stop <= text_end) & (words > 0))
    power = np.ones(n + 1, U64)
    power[1:] = np.cumprod(np.full(n, _BASE, U64), dtype=U64)
    inverse = np.ones(n + 1, U64)
    inverse[1:] = np.cumprod(np.full(n, U64(pow(int(_BASE), -1, 1 << 64)), U64), dtype=U64)
    sums = np.zeros(n + 1, U64)
    np.cumsum(mix(lines.astype(np.int64).view(U64)) * power[:n], out=sums[1:], dtype=U64)
    found = (sums[stop[begins]] - sums[begins]) * inverse[begins]
    return mix(found + (stop[begins] - begins).astype(U64)).view(np.int64), begins


def _seeds(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lines, words = batch.column("lines"), batch.column("words")
            sizes = np.array([len(x) for x in lines], np.int64)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            flat = lines.flatten().to_numpy(zero_copy_only=False)
            hashes, begins = run_hashes(flat, words.flatten().to_numpy(zero_copy_only=False), bounds, min_words)
            owner = pa.array(np.searchsorted(bounds, begins, "right") - 1)
            yield pa.record_batch(
                [pa.array(hashes), batch.column("doc_id").take(owner), batch.column("doc_key").take(owner)],
                ["run", "doc_id", "doc_key"],
            )

    return run


def _rising(places: list[int]) -> list[int]:
    """Indexes of a longest rising subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(places)
    for i, p in enumerate(places):
        k = bisect_left(tails, p)
        if k:
            before[i] = ends[k - 1]
        if k == len(tails):
            tails.append(p)
            ends.append(i)
        else:
            tails[k], ends[k] = p, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience_matches(a: list[int], b: list[int], anchors: Sequence[tuple[int, int]] = ()) -> list[tuple[int, int]]:
    """Places (in a, in b) of lines aligned by patience diff, rising in both.

    ``anchors`` are places that begin a stretch each, rising in both. Common lines at both ends are aligned; between them, lines that are unique in
    both texts and in the same order are anchors, and what lies between anchors
    is treated alike. Where no line is unique, each line is aligned with the next
    equal one, as far as lines go on to be equal.
    """
    out: list[tuple[int, int]] = []
    bounds = [(0, 0), *anchors, (len(a), len(b))]
    todo = [(i, next_i, j, next_j) for (i, j), (next_i, next_j) in pairwise(bounds)]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: i for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and in_b.get(x) == 1}
        common = [(place[x], j) for j, x in enumerate(b[b0:b1], b0) if x in place]
        if common:
            a_from, b_from = a0, b0
            for k in _rising([i for i, _ in common]):
                i, j = common[k]
                out.append((i, j))
                todo.append((a_from, i, b_from, j))
                a_from, b_from = i + 1, j + 1
            todo.append((a_from, a1, b_from, b1))
        else:
            spots: dict[int, list[int]] = {}
            for i in range(a0, a1):
                spots.setdefault(a[i], []).append(i)
            i = a0
            for j in range(b0, b1):
                if i < a1 and a[i] == b[j]:
                    out.append((i, j))
                    i += 1
                    continue
                there = spots.get(b[j], [])
                k = bisect_left(there, i)
                # A jump ahead is worth it only if the next line agrees as well.
                if k < len(there) and (j + 1 == b1 or there[k] + 1 < a1 and a[there[k] + 1] == b[j + 1]):
                    out.append((there[k], j))
                    i = there[k] + 1
    return sorted(out)


def _may_go_on(a: list[int], b: list[int], words: list[int], cut: list[bool], min_words: int) -> bool:
    """Whether lines that stay lie in a stretch of ``min_words`` words all of whose lines are in ``a``."""
    known = set(a)
    n, stays = 0, False
    for x, w, gone in zip(b, words, cut, strict=True):
        if x not in known:
            n, stays = 0, False
            continue
        n, stays = n + w, stays or (w > 0 and not gone)
        if stays and n >= min_words:
            return True
    return False


class Block(NamedTuple):
    """``size`` lines that stand together from ``i`` on in one text and from ``j`` on in the other."""

    i: int
    j: int
    size: int


def seeded_blocks(a: list[int], b: list[int], words: list[int], min_words: int) -> list[Block]:
    """All blocks that go on to where the texts differ, from the first line of a common run of ``min_words`` words.

    A run whose lines before it agree as well, back to one with words, belongs to
    a block that began earlier.
    """
    size = dict(zip(b, words, strict=True))
    # A line that b lacks is in no common run; as it ends every run, what it counts does not matter.
    sides = (a, [size.get(x, min_words) for x in a]), (b, words)
    runs = []
    for lines, counts in sides:
        array, many = np.array(lines, np.int64), np.array(counts, np.int64)
        hashes, begins = run_hashes(array, many, np.array([0, len(lines)]), min_words)
        worded = np.maximum.accumulate(np.where(many > 0, np.arange(len(lines)), -1))
        before = [worded[i - 1] if i else -1 for i in begins.tolist()]
        led = [tuple(lines[p:i]) if p >= 0 else None for p, i in zip(before, begins.tolist(), strict=True)]
        runs.append(list(zip(hashes.tolist(), begins.tolist(), led, strict=True)))
    places: dict[int, dict[tuple | None, list[int]]] = {}
    for run, i, led in runs[0]:
        places.setdefault(run, {}).setdefault(led, []).append(i)
    one, two = np.array(a, np.int64), np.array(b, np.int64)
    blocks = []
    for run, j, led in runs[1]:
        for other, there in places.get(run, {}).items():
            if led is None or other != led:
                for i in there:
                    longest = min(len(a) - i, len(b) - j)
                    differ = np.flatnonzero(one[i : i + longest] != two[j : j + longest])
                    blocks.append(Block(i, j, int(differ[0]) if len(differ) else longest))
    return blocks


def heaviest_chain(blocks: list[Block], weights: list[int]) -> list[Block]:
    """Blocks that rise in both texts without overlap and weigh most together."""
    ends = sorted({x.i + x.size for x in blocks})
    best: list[tuple[int, int]] = [(0, -1)] * (len(ends) + 1)  # a tree of the heaviest chain that ends up to a place
    total, before = [0] * len(blocks), [-1] * len(blocks)
    waiting = sorted(range(len(blocks)), key=lambda k: blocks[k].j + blocks[k].size)
    done = 0
    for k in sorted(range(len(blocks)), key=lambda k: blocks[k].j):
        while done < len(waiting) and blocks[waiting[done]].j + blocks[waiting[done]].size <= blocks[k].j:
            ended = waiting[done]
            at = bisect_left(ends, blocks[ended].i + blocks[ended].size) + 1
            while at < len(best):
                best[at] = max(best[at], (total[ended], ended))
                at += at & -at
            done += 1
        at = bisect_right(ends, blocks[k].i)
        found = (0, -1)
        while at:
            found = max(found, best[at])
            at -= at & -at
        total[k], before[k] = weights[k] + found[0], found[1]
    chain, k = [], max(range(len(blocks)), key=total.__getitem__, default=-1)
    while k >= 0:
        chain.append(blocks[k])
        k = before[k]
    return chain[::-1]


def _spans(matches: list[tuple[int, int]], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """Stretches of aligned lines that stand together in both texts, of at least ``min_words`` words."""
    spans: list[tuple[int, int]] = []
    start = last = None
    for pair in [*matches, None]:
        if last is not None and (pair is None or pair[0] != last[0] + 1 or pair[1] != last[1] + 1):
            if sum(words[start[1] : last[1] + 1]) >= min_words:
                spans.append((start[1], last[1] + 1))
            start = None
        start, last = (start or pair), pair
    return spans


def common_blocks(a: list[int], b: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """Spans of lines of ``b`` that stand together in ``a`` as well, of at least ``min_words`` words (those of ``b``).

    Patience diff, again and again: an alignment takes each line once and in order,
    so passages that are repeated, swapped or outnumbered by short lines need one
    of their own. While a seeded run has a line that stays, the texts are aligned
    anew from the blocks that weigh most, by the words that stay, and rise in both;
    a place of ``a`` may serve several of ``b``. So no line with words stays that
    is in a common run of ``min_words`` words.
    """
    spans = set(_spans(patience_matches(a, b), words, min_words))
    cut = [False] * len(b)
    for x, y in spans:
        cut[x:y] = [True] * (y - x)
    if not _may_go_on(a, b, words, cut, min_words):
        return sorted(spans)
    blocks = seeded_blocks(a, b, words, min_words)
    while True:
        staying = np.concatenate([[0], np.cumsum([0 if gone else w for gone, w in zip(cut, words, strict=True)])])
        weights = [int(staying[x.j + x.size] - staying[x.j]) for x in blocks]
        blocks = [x for x, w in zip(blocks, weights, strict=True) if w]
        chain = heaviest_chain(blocks, [w for w in weights if w])
        found = set(_spans(patience_matches(a, b, [(x.i, x.j) for x in chain]), words, min_words)) - spans
        if not found:
            return sorted(spans)
        spans |= found
        for x, y in found:
            cut[x:y] = [True] * (y - x)


SPANS = "doc_id long, doc_key long, spans array<struct<first int, after int>>, earlier long"


def _aligned(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("first", pa.int32()), ("after", pa.int32())])
        for batch in batches:
            rows = [batch.column(c).to_pylist() for c in ("earlier_lines", "lines", "words")]
            found = [
                [{"first": x, "after": y} for x, y in common_blocks(a, b, w, min_words)]
                for a, b, w in zip(*rows, strict=True)
            ]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("doc_key"), pa.array(found, pa.list_(span)), batch.column("earlier")],
                ["doc_id", "doc_key", "spans", "earlier"],
            )

    return run


def overlapping(lines: DataFrame, min_words: int) -> DataFrame:
    """Pairs of a document and the earliest one that has a run of its lines.

    A run is the shortest with ``min_words`` words from its first line on. Two
    documents have a block of that many words in common just when they have a
    run in common, so nothing else needs to be compared. A run in many documents
    ties each to the earliest only: there are never more pairs than lines.
    """
    seeds = stage(lines.mapInArrow(_seeds(min_words), "run long, doc_id long, doc_key long"), "line-runs")
    doc = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key")
    shared = (
        seeds.groupBy("run")
        .agg(F.min(doc).alias("first"), F.max(doc).alias("final"))
        .filter("first <> final")
        .select("run", F.col("first.doc_id").alias("earlier"), F.col("first.doc_key").alias("earlier_key"))
    )
    return (
        seeds.join(shared, "run")
        .filter(~(F.col("doc_id").eqNullSafe(F.col("earlier")) & (F.col("doc_key") == F.col("earlier_key"))))
        .select("doc_id", "doc_key", "earlier", "earlier_key")
        .distinct()
    )


def repeated_spans(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """For each document with repeated blocks the spans of its lines to delete, and the documents that have them."""
    texts = documents.select(
        "doc_id", doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"), F.coalesce("text", F.lit("")).alias("text")
    )
    lines = stage(texts.mapInArrow(_lines, LINES), "line-hashes")
    pairs = stage(overlapping(lines, min_words), "line-pairs")
    # Repeated rows have one key; one of them stands for all.
    unique = lines.groupBy("doc_key").agg(F.first("lines").alias("lines"), F.first("words").alias("words"))
    unique = stage(unique, "unique-lines") if _repeats(lines) else lines.select("doc_key", "lines", "words")
    earlier = unique.select(F.col("doc_key").alias("earlier_key"), F.col("lines").alias("earlier_lines"))
    both = pairs.join(earlier, "earlier_key").join(unique, "doc_key")
    spans = both.select("doc_id", "doc_key", "earlier", "earlier_lines", "lines", "words")
    aligned = spans.mapInArrow(_aligned(min_words), SPANS).filter(F.size("spans") > 0)
    return aligned.groupBy("doc_id", "doc_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_sort(F.collect_set("earlier")).alias("earlier"),
    )


def _repeats(lines: DataFrame) -> bool:
    return not lines.groupBy("doc_key").count().filter("count > 1").isEmpty()


ADDED = ("removed_lines", "removed_spans", "earlier_docs")


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every document with the blocks deleted that an earlier document has.

    A block is a run of whole lines that stands in both documents, with at least
    ``min_words`` words; where it is repeated or moved, every place of it goes.
    Earlier is the smaller doc_id (null is last; equal ids by the hash of the text). Rows that repeat both id and text are one document
    and are cut alike. The earliest document keeps its lines, so every deleted
    line is still in another document. Shorter repeats, as a licence line or a
    heading, stay. Null texts stay null, and an empty table gives no rows. Other
    columns are kept as they are.

    Returns ``documents``, the texts shortened, with ``removed_lines``,
    ``removed_spans`` (first line and the one after the last) and ``earlier_docs``,
    empty where nothing was deleted. Columns of these names are replaced.
    """
    cut = free_name(documents.columns, "cut")
    found = stage(repeated_spans(documents, min_words), "line-spans")
    found = found.select(F.struct("doc_id", "doc_key", "spans", "earlier").alias(cut))
    key = doc_key(F.col("doc_id"), F.col("text"))
    same = F.col("doc_id").eqNullSafe(F.col(f"{cut}.doc_id")) & (key == F.col(f"{cut}.doc_key"))
    # The documents that lose lines grow with all: merged at any size, and never sent to all executors.
    joined = documents.join(found.hint("merge"), same, "left")
    lines, spans, loses = F.split("text", "\n"), F.col(f"{cut}.spans"), F.col(cut).isNotNull()
    staying = F.filter(lines, lambda _, i: ~F.exists(spans, lambda s: (s["first"] <= i) & (i < s["after"])))
    no_spans = F.array().cast("array<struct<first:int,after:int>>")
    return joined.select(
        *(
            F.when(loses, F.array_join(staying, "\n")).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c)
            for c in documents.columns
            if c not in ADDED
        ),
        F.when(loses, F.size(lines) - F.size(staying)).otherwise(0).alias("removed_lines"),
        F.coalesce(spans, no_spans).alias("removed_spans"),
        F.coalesce(F.col(f"{cut}.earlier"), F.array().cast("array<bigint>")).alias("earlier_docs"),
    )
