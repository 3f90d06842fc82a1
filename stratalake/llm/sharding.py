"""Sharding: a contiguous partition of ordered groups with the smallest possible largest shard."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.llm.ranges import number_in_groups, place_rows
from stratalake.sources import stage

KEY_BITS = 64
FIRST_BITS = 14  # 16,384 segments at first
MORE_BITS = 6  # an open segment is split in 64


@dataclass
class _Segment:
    """A stretch of the key space: ``prefix`` is the leading ``bits`` of its keys."""

    prefix: int
    bits: int
    total: int
    groups: int
    largest: int

    @property
    def first_key(self) -> int:
        return self.prefix << (KEY_BITS - self.bits)

    @property
    def atomic(self) -> bool:
        return self.groups == 1 or self.bits == KEY_BITS


@dataclass
class _Line:
    """Segments in key order with the bytes before each."""

    segments: list[_Segment]
    ends: list[int] = field(init=False)

    def __post_init__(self) -> None:
        self.ends = [0, *accumulate(s.total for s in self.segments)]

    def cut(self, target: int) -> int:
        """The number of whole segments that end at ``target`` at the latest."""
        return bisect_right(self.ends, target) - 1

    def whole(self, start: int, capacity: int, most: int) -> bool:
        """Whether ``most`` shards of ``capacity`` hold all from segment ``start`` on, segments kept whole."""
        for _ in range(most):
            if start == len(self.segments):
                return True
            start = max(start, self.cut(self.ends[start] + capacity))
        return start == len(self.segments)

    def split(self, capacity: int, most: int) -> bool:
        """The same if a segment of several groups could be cut anywhere: if not, no cut of groups does."""
        at = 0
        for _ in range(most):
            at = self._reach(at + capacity, lowest=False)
        return at >= self.ends[-1]

    def _reach(self, target: int, lowest: bool) -> int:
        """The farthest, or the nearest, place at which a shard that may reach ``target`` can end."""
        k = self.cut(target)
        if k >= len(self.segments):
            return self.ends[-1]
        s = self.segments[k]
        if s.atomic:
            return self.ends[k]
        return max(self.ends[k], target - s.largest) if lowest else target

    def open(self, low: int, high: int, most: int) -> set[int]:
        """Segments in which a cut can lie for some capacity from ``low`` to ``high``."""
        found: set[int] = set()
        near = far = 0
        for _ in range(most - 1):
            near, far = self._reach(near + low, lowest=True), min(self.ends[-1], far + high)
            first, last = self.cut(near), min(self.cut(far), len(self.segments) - 1)
            found.update(k for k in range(first, last + 1) if not self.segments[k].atomic)
        return found


def _least(low: int, high: int, holds) -> int:
    """The smallest value from ``low`` to ``high`` for which ``holds``; it holds for ``high``."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle + 1, high)
    return low


def _segments(groups: DataFrame, bits: int, within: tuple[int, list[int]] | None = None) -> list[_Segment]:
    """Sums per leading ``bits`` of the key: one row per segment, at most 2^14 or 64 per open one."""
    if within is not None:
        old_bits, prefixes = within
        groups = groups.filter(F.shiftright("key", KEY_BITS - old_bits).isin(prefixes))
    prefix = F.shiftright("key", KEY_BITS - bits) if bits < KEY_BITS else F.col("key")
    sums = groups.groupBy(prefix.alias("prefix")).agg(
        F.sum("total").alias("total"), F.count(F.lit(1)).alias("groups"), F.max("total").alias("largest")
    )
    return [_Segment(r["prefix"], bits, int(r["total"]), r["groups"], int(r["largest"])) for r in sums.collect()]


def minimax_cuts(groups: DataFrame, n_shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the first key of each shard but the first.

    ``groups`` has ``key`` (bigint, spread evenly) and ``total`` of each atomic
    group. The driver sees sums of at most 2^14 stretches of the key space, and
    then of those stretches in which a cut can lie, split further until the
    capacity is exact. A probe of the binary search walks shard by shard over
    running sums.
    """
    line = _Line(sorted(_segments(groups, FIRST_BITS), key=lambda s: s.first_key))
    if not line.segments:
        return 0, []
    total = line.ends[-1]
    while True:
        floor = max(-(-total // n_shards), max(s.largest for s in line.segments))
        low = _least(floor, total, lambda c: line.split(c, n_shards))
        high = _least(low, total, lambda c: line.whole(0, c, n_shards))
        split = line.open(low, high, n_shards) if low < high else set()
        if not split:
            break
        kept = [s for k, s in enumerate(line.segments) if k not in split]
        for bits in {line.segments[k].bits for k in split}:
            prefixes = [line.segments[k].prefix for k in split if line.segments[k].bits == bits]
            kept += _segments(groups, min(KEY_BITS, bits + MORE_BITS), (bits, prefixes))
        line = _Line(sorted(kept, key=lambda s: s.first_key))
    # Each shard takes an even share of what is left, and more only where the rest would not fit otherwise.
    cuts, start = [], 0
    for left in range(n_shards - 1, 0, -1):
        share = -(-(total - line.ends[start]) // (left + 1))
        end = min(max(line.cut(line.ends[start] + share), start + 1), len(line.segments))
        if line.ends[end] - line.ends[start] > high or not line.whole(end, high, left):
            end = line.cut(line.ends[start] + high)
        if end == len(line.segments):
            break
        cuts.append(line.segments[end].first_key)
        start = end
    return high, cuts


def shard_documents(documents: DataFrame, n_shards: int = 40, overhead: int = 16) -> DataFrame:
    """Every document's shard and its slot there; the largest shard is as small as it can be.

    A document weighs its UTF-8 bytes plus ``overhead`` (a null text: only that).
    Equal texts form a group that stays together. Groups are ordered by the hash
    of their text and cut into ``n_shards`` contiguous stretches; null texts form
    one group, apart from the empty ones. Slots count from 0 in each shard. Rows
    that repeat in doc_id and text get slots of their own. An empty table gives
    no rows; other columns are not looked at. Groups may exceed an even share:
    then such a group sets the capacity.

    Columns: doc_id, size, text_crc32, shard, slot.
    """
    text = F.col("text")
    base = stage(
        documents.select(
            "doc_id",
            (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("bigint").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        ),
        "shard-sizes",
    )
    groups = stage(base.groupBy("key").agg(F.sum("size").alias("total")), "shard-groups")
    _, cuts = minimax_cuts(groups, n_shards)
    return number_in_groups(
        place_rows(
            base.withColumn("shard", _shard_of(F.col("key"), cuts)),
            ["shard", "key", "doc_id", "size"],
            "shard-rows",
        ),
        "shard",
        "slot",
    ).select("doc_id", "size", "text_crc32", "shard", "slot")


def _shard_of(key: Column, cuts: list[int]) -> Column:
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (key >= F.lit(cut)).cast("int")
    return shard
