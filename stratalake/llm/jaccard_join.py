"""Exact self join of documents on the Jaccard similarity of their word shingles, through a token-group matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratalake.llm.components import connected_components
from stratalake.llm.line_dedup import doc_key
from stratalake.llm.words import U64, mix, shingle_sets
from stratalake.llm.worker import slices, utf8
from stratalake.sources import stage

PERCENT = 80
WIDTH = 5
SLOTS = 4  # smallest hashes; sets that share two of them can form a group
MORE = 16  # one more token in common is asked for, per so many tokens of a set
SKETCH_BITS, CHUNK_BITS = 20, 10
BLOCK_TOKENS, BLOCK_SETS, VISITORS = 200_000, 512, 4096
GUIDES, CROWD = 8, 64  # sets that visit all blocks of a crowd; sets that make one
_SEEDS = [0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89]


_LEFT, _RIGHT = np.triu_indices(SLOTS, 1)


def _needed(n: int, percent: int) -> int:
    """The least overlap that a set of ``n`` has with any set linked to it."""
    return -(-n * percent // 100)


def _set_key(tokens: np.ndarray) -> int:
    """A hash of the whole set."""
    total = mix(np.array([len(tokens)], U64) + np.sum(mix(tokens ^ U64(_SEEDS[0])), dtype=U64))
    return int(total.astype(np.int64)[0])


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and shingle set of each text of a batch."""
    data, offsets = utf8(batch.column("text"))
    for a, b in slices(offsets):
        sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1], WIDTH)
        yield from zip(range(a, b), sets, strict=True)


SUMMARY = "doc_id long, doc_key long, n_shingles long, set_key long, lows array<long>, chunk int, counts binary"


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, key and smallest hashes of each set; at the end of a task its counts of hashed tokens."""
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    for batch in batches:
        sizes, keys, lows = [], [], []
        for _, tokens in _texts(batch):
            sizes.append(len(tokens))
            keys.append(_set_key(tokens))
            if len(tokens):
                least = np.array([mix(tokens ^ U64(s)).min() for s in _SEEDS[:SLOTS]], U64)
                lows.append(mix(least[_LEFT] + U64(3) * least[_RIGHT]).view(np.int64).tolist())
                # Distinct tokens of one set rarely share a counter; where they do, the count is one too low.
                sketch[(tokens >> U64(64 - SKETCH_BITS)).astype(np.int64)] += np.uint32(1)
            else:
                lows.append([])
        n = batch.num_rows
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("doc_key"),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.int64()),
                pa.array(lows, pa.list_(pa.int64())),
                pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.binary()),
            ],
            ["doc_id", "doc_key", "n_shingles", "set_key", "lows", "chunk", "counts"],
        )
    rows = sketch.reshape(-1, 1 << CHUNK_BITS)
    used = np.flatnonzero(rows.any(axis=1))
    m = len(used)
    if m:
        yield pa.record_batch(
            [
                pa.nulls(m, pa.int64()),
                pa.nulls(m, pa.int64()),
                pa.nulls(m, pa.int64()),
                pa.nulls(m, pa.int64()),
                pa.nulls(m, pa.list_(pa.int64())),
                pa.array(used, pa.int32()),
                pa.array([rows[k].tobytes() for k in used.tolist()], pa.binary()),
            ],
            ["doc_id", "doc_key", "n_shingles", "set_key", "lows", "chunk", "counts"],
        )


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters added up over all tasks, as eighths of a power of two in one byte."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            total = totals.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.int64))
            total += np.frombuffer(counts, np.uint32)
    if totals:
        levels = [np.minimum(255, 8 * np.log2(1 + t)).astype(np.uint8).tobytes() for t in totals.values()]
        yield pa.record_batch(
            [pa.array(list(totals), pa.int32()), pa.array(levels, pa.binary())], ["chunk", "levels"]
        )


def _token_levels(summary: DataFrame) -> bytes:
    """One byte per counter, 1 MB whatever the size of the input: how often tokens of that hash occur in all sets."""
    counts = summary.filter(F.col("chunk").isNotNull()).select("chunk", "counts")
    found = counts.repartition("chunk").mapInArrow(_add_counts, "chunk int, levels binary").collect()
    levels = np.zeros((1 << (SKETCH_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.uint8)
    for chunk, row in found:
        levels[chunk] = np.frombuffer(bytes(row), np.uint8)
    return levels.tobytes()


def _prefixes(levels: bytes, percent: int):
    """The rarest tokens of each set, so many that a linked set has 1 + n // MORE of them among its own.

    Two linked sets have all but n - needed tokens of either in common. So of the
    n - needed + k rarest of each, in an order that holds for all sets, k are shared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(levels, np.uint8)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets, 1 << 22):
                keys, chosen, ends = [], [], [0]
                for tokens in shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1], WIDTH):
                    keys.append(_set_key(tokens))
                    if n := len(tokens):
                        rank = level[(tokens >> U64(64 - SKETCH_BITS)).astype(np.int64)]
                        rarest = np.argsort(rank, kind="stable")[: n - _needed(n, percent) + 1 + n // MORE]
                        chosen.append(tokens[rarest])
                        ends.append(ends[-1] + len(rarest))
                    else:
                        ends.append(ends[-1])
                flat = np.concatenate([*chosen, np.zeros(0, U64)]).view(np.int64)
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(keys, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    ],
                    ["doc_id", "set_key", "tokens"],
                )

    return run


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks with sizes that allow a link, and how many tokens they have in common.

    Rows come sorted by token, component and block; blocks of one component make
    no pair. The lowest byte of a block is the class of its sets' sizes; sets two
    classes apart are too unlike in size.
    """
    rest = [np.zeros(0, np.int64)] * 3

    def pairs(token: np.ndarray, part: np.ndarray, block: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(token):
            return
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (block[1:] != block[:-1])
        token, part, block = token[new], part[new], block[new]
        other_token = np.flatnonzero(np.append(token[1:] != token[:-1], True)) + 1
        other_part = np.flatnonzero(np.append((token[1:] != token[:-1]) | (part[1:] != part[:-1]), True)) + 1
        row = np.arange(len(token))
        end = other_token[np.searchsorted(other_token, row, "right")]
        partner = other_part[np.searchsorted(other_part, row, "right")]  # the first of another component
        while True:  # the next partner of each row, until no token has one more
            left = partner < end
            row, end, partner = row[left], end[left], partner[left]
            if not len(row):
                break
            one, two = block[row], block[partner]
            fits = np.abs((one & 255) - (two & 255)) <= 1
            if fits.any():
                one, two = one[fits], two[fits]
                made = np.stack([np.minimum(one, two), np.maximum(one, two)], axis=1)
                made, shared = np.unique(made.view([("a", np.int64), ("b", np.int64)]).ravel(), return_counts=True)
                columns = [pa.array(np.ascontiguousarray(made[c])) for c in ("a", "b")]
                yield pa.record_batch([*columns, pa.array(shared)], ["a", "b", "shared"])
            partner = partner + 1

    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("token", "part", "block")]
        columns = [np.concatenate(pair) for pair in zip(rest, columns, strict=True)]
        if not len(columns[0]):
            continue
        whole = int(np.searchsorted(columns[0], columns[0][-1]))  # the last token may go on in the next batch
        yield from pairs(*(c[:whole] for c in columns))
        rest = [c[whole:] for c in columns]
    yield from pairs(*rest)


SETS = "set_key long, moves array<struct<target long, parts int, visits int>>, tokens binary"


def _open_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sets of the candidates' texts. Should other words have the same id and hash, they are none of them."""
    for batch in batches:
        keys, moves = batch.column("set_key").to_pylist(), batch.column("moves")
        rows, sets = [], []
        for row, tokens in _texts(batch):
            if _set_key(tokens) == keys[row]:
                rows.append(row)
                sets.append(tokens.tobytes())
        picked = pa.array(rows, pa.int64())
        yield pa.record_batch(
            [batch.column("set_key").take(picked), moves.take(picked), pa.array(sets, pa.binary())],
            ["set_key", "moves", "tokens"],
        )


class _Block:
    """A group's sets as its token union with the sets that hold each token."""

    def __init__(self, keys: list[int], sets: list[np.ndarray], percent: int) -> None:
        self.keys, self.percent = keys, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets)
        holder = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, self.holder = tokens[order], holder[order]
        self.union, first = np.unique(tokens, return_index=True)
        self.first = np.append(first, len(tokens))

    def linked(self, tokens: np.ndarray) -> np.ndarray:
        """Which sets are similar enough; none is looked at if even the union has too few of the tokens."""
        at = np.searchsorted(self.union, tokens)
        at[at == len(self.union)] = 0
        hit = at[self.union[at] == tokens]
        if len(hit) < _needed(len(tokens), self.percent):
            return np.zeros(0, np.int64)
        counts = self.first[hit + 1] - self.first[hit]
        ends = np.cumsum(counts)
        spots = np.arange(ends[-1]) - np.repeat(ends - counts - self.first[hit], counts)
        common = np.bincount(self.holder[spots], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= self.percent * (self.sizes + len(tokens) - common))


def _links(percent: int):
    """Links between a block's sets and those that visit it, as few as join all that are joined, and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = block = None
        keys: list[int] = []
        sets: list[np.ndarray] = []
        known: set[int] = set()
        parent: dict[int, int] = {}
        within = False
        found_u: list[int] = []
        found_v: list[int] = []

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def join(x: int, others: list[int]) -> None:
            for y in others:
                a, b = root(x), root(y)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    found_u.append(x)
                    found_v.append(y)

        def close() -> None:
            """All rows of the block itself have come."""
            nonlocal block
            block = _Block(keys, sets, percent)
            if within and place[1] == 0:
                for k, (key, tokens) in enumerate(zip(keys, sets, strict=True)):
                    join(key, [keys[i] for i in block.linked(tokens).tolist() if i < k])

        def flush() -> pa.RecordBatch:
            made = pa.record_batch([pa.array(found_u, pa.int64()), pa.array(found_v, pa.int64())], ["u", "v"])
            found_u.clear()
            found_v.clear()
            return made

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("target", "part", "visits", "set_key", "tokens")]
            for target, part, visits, key, raw in zip(*columns, strict=True):
                if (target, part) != place:
                    if place is not None and block is None:
                        close()
                    place, block = (target, part), None
                    keys, sets, known, parent = [], [], set(), {}
                tokens = np.frombuffer(raw, U64)
                if visits < 1:
                    within = visits == 0
                    if key not in known:
                        known.add(key)
                        keys.append(key)
                        sets.append(tokens)
                    continue
                if block is None:
                    close()
                join(key, [keys[i] for i in block.linked(tokens).tolist()])
            if len(found_u):
                yield flush()
        if place is not None and block is None:
            close()
        yield flush()

    return run


def jaccard_components(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Each document's number of shingles and the smallest doc_id it is linked to, directly or through others.

    Words are runs of other than white space, A-Z lowered; a set has the distinct
    5-word shingles, or the whole text as one if shorter. Sets are linked when
    their intersection has ``percent`` of their union. Documents without words
    are linked with nothing and keep their own id. Equal sets are one set from
    the start. A null doc_id counts as larger than all. Repeated rows are equal
    sets; an empty table gives no rows; other columns are not looked at.

    1. Every set gets a key, its size and its smallest hashes; counts of hashed
       tokens over all sets show which tokens are common.
    2. Sets of like size that share two smallest hashes (of four; the two that most
       sets share) form a group; large groups are dealt into blocks.
    3. The sets of a block are compared with one another, and with a few guides: sets
       that visit every block in which their smallest hashes are found too, if many
       have them. This joins most near copies, and takes a number of visits that
       grows as the number of blocks. Groups are then dealt anew: what is joined
       already lies in blocks of its own, apart from the rest.
    4. The token-block matrix holds, for each block, the union of its sets' rarest
       tokens, so many that linked sets have a sixteenth of their size in common.
       Blocks with so many tokens in common are candidates, unless all their sets
       are joined already. The sets of the smaller visit the other: the overlap of a
       set with the block's token union bounds its overlap with any member, and only
       if that is enough is the block opened.
    5. What is linked in a task leaves it as a spanning set of links, and the
       links of all are joined to components. Links found within a component
       already joined are not repeated; no link between components is lost.

    Columns: doc_id, n_shingles, component_id.
    """
    return jaccard_groups(documents, percent).select("doc_id", "n_shingles", "component_id")


def _first(doc_id: str, key: str) -> Column:
    """The least doc_id, null last, and of its texts that with the least key."""
    return F.min(F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("doc_id"), F.col(key).alias("doc_key")))


def jaccard_groups(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """As ``jaccard_components``, with ``doc_key``, which tells texts of one id apart, and ``first_key``.

    The row of a component that has ``component_id`` and ``first_key`` is its first,
    also where ids are null or repeated. Rows that repeat id and text are one.
    """
    texts = documents.select("doc_id", doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"), "text")
    summary = stage(texts.mapInArrow(_summarise, SUMMARY), "shingle-sets")
    levels = _token_levels(summary)
    docs = summary.filter(F.col("chunk").isNull()).select("doc_id", "doc_key", "n_shingles", "set_key", "lows")
    vertices = stage(
        docs.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(_first("doc_id", "doc_key").alias("rep"), F.first("n_shingles").alias("n"), F.first("lows").alias("lows"))
        .select("set_key", F.col("rep.doc_id").alias("rep"), F.col("rep.doc_key").alias("rep_key"), "n", "lows"),
        "distinct-sets",
    )
    blocks = stage(_blocks(vertices, percent), "set-blocks")
    several = blocks.groupBy("block").count().filter("count > 1").select(F.col("block").alias("target"))
    near = stage(connected_components(_verified(texts, blocks, several, _guides(blocks), percent)), "near-sets")
    piles = stage(_piles(blocks, near), "set-piles")
    pairs = stage(_candidates(texts, piles, levels, percent), "block-pairs")
    unmet = piles.filter("mixed and split").select(F.col("block").alias("target")).distinct()
    edges = _verified(texts, piles, unmet, _visitors(piles, pairs), percent)
    parts = stage(connected_components(edges.union(near.select("node", "root"))), "set-components")
    tied = vertices.join(parts, F.col("set_key") == F.col("node"), "left").select(
        "set_key", "rep", "rep_key", F.coalesce("root", "set_key").alias("root")
    )
    lowest = tied.groupBy("root").agg(_first("rep", "rep_key").alias("first"))
    of_set = stage(tied.join(lowest, "root").select("set_key", "first"), "set-component-ids")
    out = docs.join(of_set, "set_key", "left")
    alone = F.col("n_shingles") == 0
    return out.select(
        "doc_id",
        "doc_key",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.when(alone, F.col("doc_key")).otherwise(F.col("first.doc_key")).alias("first_key"),
    )


def _dealt(rows: str, tokens: str) -> Column:
    """Into how many blocks sets are dealt."""
    most = F.greatest(F.ceil(F.col(tokens) / BLOCK_TOKENS), F.ceil(F.col(rows) / BLOCK_SETS), F.lit(1))
    return most.cast("bigint")


def _blocks(vertices: DataFrame, percent: int) -> DataFrame:
    """Group and block of each distinct set; a block's lowest byte is the class of its sets' sizes."""
    # Linked sets' sizes differ by a factor of 100 / percent at most: the same or neighbouring classes.
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("bigint")
    lows = vertices.select("set_key", "n", size_class.alias("class"), F.posexplode("lows").alias("slot", "low"))
    shared = lows.groupBy("class", "slot", "low").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens")
    )
    chosen = (
        lows.join(shared.filter("rows > 1"), ["class", "slot", "low"])
        .groupBy("set_key")
        .agg(F.max(F.struct("rows", "tokens", "slot", "low")).alias("best"))
    )
    alone = F.xxhash64(F.lit("alone"), "set_key")
    single = F.col("best").isNull()
    dealt = F.when(single, 1).otherwise(_dealt("best.rows", "best.tokens"))
    placed = vertices.join(chosen, "set_key", "left").select(
        "set_key",
        "rep",
        "rep_key",
        "n",
        "lows",
        F.when(single, alone).otherwise(F.xxhash64("best.slot", "best.low", size_class)).alias("grp"),
        dealt.alias("dealt"),
        _class_byte(size_class).alias("size_class"),
    )
    part = F.pmod(F.xxhash64("set_key"), F.col("dealt"))
    return placed.select(
        "set_key", "rep", "rep_key", "n", "lows", "grp", "size_class", (F.col("dealt") > 1).alias("split"),
        _block(F.xxhash64("grp", part)).alias("block"),
    )


def _block(name: Column) -> Column:
    return F.shiftleft(name, 8).bitwiseOR(F.col("size_class"))


def _guides(blocks: DataFrame) -> DataFrame:
    """Which blocks (``target``) which sets visit first.

    Of all sets with the same two smallest hashes, if they are a crowd, at most
    ``GUIDES`` visit the blocks that hold one of them. They are chosen by hash, in
    an aggregate that is combined before the exchange, so no crowd meets in a task.
    """
    lows = blocks.select("set_key", "block", "size_class", F.posexplode("lows").alias("slot", "low"))
    turn = F.pmod(F.xxhash64("set_key"), F.lit(GUIDES))
    least = lows.groupBy("slot", "low", turn.alias("turn")).agg(
        F.min(F.struct("set_key", "block", "size_class")).alias("guide"), F.count(F.lit(1)).alias("rows")
    )
    crowds = least.groupBy("slot", "low").agg(F.collect_list("guide").alias("guides"), F.sum("rows").alias("rows"))
    crowds = crowds.filter(F.col("rows") >= CROWD).drop("rows")
    found = lows.groupBy("slot", "low", "block", "size_class").agg(F.count(F.lit(1)).alias("sets"))
    met = found.join(crowds, ["slot", "low"]).select(F.col("block").alias("target"), "size_class", F.explode("guides").alias("guide"))
    other = F.col("guide.block") != F.col("target")
    fits = F.abs(F.col("guide.size_class") - F.col("size_class")) <= 1
    return met.filter(other & fits).select(F.col("guide.set_key").alias("set_key"), "target").distinct()


def _piles(blocks: DataFrame, near: DataFrame) -> DataFrame:
    """Groups dealt anew: crowds of joined sets lie in blocks of their own, the rest of a group in others.

    ``part`` is the component of all sets of a block, or the block itself if they have several (``mixed``).
    """
    known = blocks.join(near, F.col("set_key") == F.col("node"), "left").select(
        *(c for c in blocks.columns if c not in ("block", "lows")), F.coalesce("root", "set_key").alias("root")
    )
    counts = known.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens"))
    counts = stage(counts.withColumn("crowd", F.when(F.col("rows") >= CROWD, F.col("root"))), "joined-sets")
    piles = counts.groupBy("grp", "crowd").agg(
        F.sum("rows").alias("rows"), F.sum("tokens").alias("tokens"), (F.min("root") != F.max("root")).alias("mixed")
    )
    piles = piles.select(
        F.col("grp").alias("of_grp"), F.col("crowd").alias("of_crowd"), "mixed", _dealt("rows", "tokens").alias("dealt")
    )
    same = (F.col("grp") == F.col("of_grp")) & F.col("crowd").eqNullSafe(F.col("of_crowd"))
    dealt = counts.join(piles, same).select("grp", "root", "crowd", "mixed", "dealt")
    turn = F.pmod(F.xxhash64("set_key"), F.col("dealt"))
    name = F.xxhash64(F.lit("pile"), "grp", F.coalesce("crowd", F.lit(0)), turn)
    return known.join(dealt, ["grp", "root"]).withColumn("block", _block(name)).select(
        "set_key", "rep", "rep_key", "block", "mixed", "split", F.when(F.col("mixed"), F.col("block")).otherwise(F.col("root")).alias("part")
    )


def _class_byte(size_class):
    return F.least(size_class, F.lit(255)).cast("bigint")


def _candidates(texts: DataFrame, blocks: DataFrame, levels: bytes, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of blocks to compare, not all of whose sets are joined."""
    prefixes = texts.mapInArrow(_prefixes(levels, percent), "doc_id long, set_key long, tokens array<long>")
    reps = blocks.select(F.col("set_key").alias("of_set"), "rep", "block", "part")
    owned = prefixes.join(
        reps, (F.col("set_key") == F.col("of_set")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    ).select("block", "part", F.explode("tokens").alias("token"))
    matrix = owned.repartition("token").sortWithinPartitions("token", "part", "block")
    counted = matrix.mapInArrow(_block_pairs, "a long, b long, shared long").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    # The fewest tokens of a set of either class; a hair below, for rounding.
    smaller = F.least(F.col("a").bitwiseAND(F.lit(255)), F.col("b").bitwiseAND(F.lit(255))).cast("double")
    fewest = F.floor(F.pow(F.lit(100 / percent), smaller) * (1 - 1e-6))
    return counted.filter(F.col("shared") >= 1 + F.floor(fewest / MORE)).select("a", "b")


def _visitors(blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sets of the smaller block of each pair, and the other block as ``target``."""
    sizes = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("rows"))
    rows = [sizes.select(F.col("block").alias(c), F.col("rows").alias(f"rows_{c}")) for c in ("a", "b")]
    sized = pairs.join(rows[0], "a").join(rows[1], "b")
    less = F.col("rows_a") <= F.col("rows_b")
    ways = sized.select(
        F.when(less, F.col("a")).otherwise(F.col("b")).alias("block"),
        F.when(less, F.col("b")).otherwise(F.col("a")).alias("target"),
    )
    return blocks.select("set_key", "block").join(ways, "block").select("set_key", "target")


def _verified(texts: DataFrame, blocks: DataFrame, within: DataFrame, visitors: DataFrame, percent: int) -> DataFrame:
    """Links between the sets of the blocks ``within``, and between a block's sets and its ``visitors``."""
    visitors = stage(visitors, "set-visits")
    crowd = visitors.groupBy("target").agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("parts"))
    homes = stage(
        within.withColumn("own", F.lit(0))
        .join(crowd, "target", "full_outer")
        .select("target", F.coalesce("parts", F.lit(1)).alias("parts"), F.coalesce("own", F.lit(-1)).alias("visits")),
        "open-blocks",
    )
    # All blocks a set goes to, its own too: no more than there are blocks to compare with.
    moves = (
        blocks.select("set_key", F.col("block").alias("target"))
        .join(homes, "target")
        .unionByName(visitors.join(homes.select("target", "parts", F.lit(1).alias("visits")), "target"))
    )
    moves = moves.groupBy("set_key").agg(F.collect_list(F.struct("target", "parts", "visits")).alias("moves"))
    wanted = stage(
        blocks.join(moves, "set_key").select(F.col("rep").alias("of_doc"), F.col("rep_key").alias("of_key"), "set_key", "moves"),
        "candidate-sets",
    )
    # The candidates grow with the documents: merged at any size, and never sent to all executors.
    # The key keeps the texts of one id, or of none, from meeting each other's sets.
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("doc_key") == F.col("of_key"))
    sets = (
        texts.join(wanted.hint("merge"), same)
        .select("text", "set_key", "moves")
        .mapInArrow(_open_sets, SETS)
    )
    own_part = F.array(F.pmod(F.xxhash64("set_key"), F.col("parts").cast("bigint")).cast("int"))
    every_part = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = (
        sets.select("set_key", "tokens", F.explode("moves").alias("move"))
        .select("set_key", "tokens", "move.*")
        .withColumn("part", F.explode(F.when(F.col("visits") == 1, own_part).otherwise(every_part)))
        .select("target", "part", "visits", "set_key", "tokens")
    )
    placed = dealt.repartition("target", "part").sortWithinPartitions("target", "part", "visits")
    return placed.mapInArrow(_links(percent), "u long, v long")
