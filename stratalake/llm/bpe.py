"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding by offsets."""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from stratalake.llm.worker import kept

# Classes of code points. The separator stands between texts.
LETTER, STMD, RV, E, L, NUMBER, OTHER, QUOTE, SPACE, WHITE, SEPARATOR = range(11)
# Unicode's White_Space.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
_SEP = 0x110000  # above every code point
# What the characters since the last boundary are: nothing; a run of letters, numbers or others; a quote that may
# begin 's 't 'm 'd, and with r, v or l before it 're 've 'll; one of these whole; white space, one character or
# more, the last of which is a plain space or not.
(START, LETTERS, NUMBERS, OTHERS, QUOTED, QUOTED_RV, QUOTED_L, ENDING, SPACE_1, SPACE_N, WHITE_1, WHITE_N) = range(12)
HERE, BEFORE = 1, 2  # a piece starts at this character; at the one before it
CHARS = 1 << 20  # characters worked on at a time
_ROW = 64  # characters of a row in the scan
_BITS = 5  # of a function's number
CACHE = 1 << 18  # pieces remembered by a worker


def _class_table() -> np.ndarray:
    table = np.full(_SEP + 1, OTHER, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
    for letters, kind in (("stmd", STMD), ("rv", RV), ("e", E), ("l", L), ("'", QUOTE)):
        for letter in letters:
            table[ord(letter)] = kind
    table[list(WHITE_SPACE)] = WHITE
    table[0x20], table[_SEP] = SPACE, SEPARATOR
    return table


def _step(state: int, kind: int) -> tuple[int, int]:
    """The next state and the boundaries that a character of ``kind`` shows."""
    if kind == SEPARATOR:
        return START, BEFORE if state in (QUOTED_RV, QUOTED_L) else 0
    letter = kind in (LETTER, STMD, RV, E, L)
    if kind in (SPACE, WHITE):
        more = state in (SPACE_1, SPACE_N, WHITE_1, WHITE_N)
        after = (SPACE_N if more else SPACE_1) if kind == SPACE else (WHITE_N if more else WHITE_1)
        return after, (0 if more else HERE) | (BEFORE if state in (QUOTED_RV, QUOTED_L) else 0)
    if state == QUOTED and letter:
        if kind == STMD:
            return ENDING, 0
        if kind in (RV, L):
            return (QUOTED_RV if kind == RV else QUOTED_L), 0
        return LETTERS, HERE
    if (state, kind) in ((QUOTED_RV, E), (QUOTED_L, L)):
        return ENDING, 0
    flags = BEFORE if state in (QUOTED_RV, QUOTED_L) else 0
    if state in (SPACE_N, WHITE_N):
        flags |= BEFORE
    joined = state in (SPACE_1, SPACE_N)  # a plain space belongs to what follows
    if letter:
        goes_on = state in (LETTERS, QUOTED_RV, QUOTED_L)
        return LETTERS, flags | (0 if joined or goes_on else HERE)
    if kind == NUMBER:
        return NUMBERS, flags | (0 if joined or state == NUMBERS else HERE)
    goes_on = state in (OTHERS, QUOTED)
    if joined or goes_on:
        return OTHERS, flags
    return (QUOTED if kind == QUOTE else OTHERS), flags | HERE


def _machine() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions from state to state that sequences of characters can be, numbered, and how they compose.

    Returns each class's function, the table of compositions (first, then second)
    and the boundaries that a class shows after a function.
    """
    n_states, n_kinds = 12, 11
    steps = [[_step(s, k) for k in range(n_kinds)] for s in range(n_states)]
    functions = [tuple(steps[s][k][0] for s in range(n_states)) for k in range(n_kinds)]
    numbers: dict[tuple[int, ...], int] = {tuple(range(n_states)): 0}
    for f in functions:
        numbers.setdefault(f, len(numbers))
    todo = list(numbers)
    while todo:  # a function followed by any class's is one too
        f = todo.pop()
        for g in functions:
            made = tuple(g[x] for x in f)
            if made not in numbers:
                numbers[made] = len(numbers)
                todo.append(made)
    known = list(numbers)
    assert len(known) <= 1 << _BITS
    then = np.zeros((1 << _BITS, 1 << _BITS), np.uint8)
    for i, f in enumerate(known):
        for j, g in enumerate(known):
            then[i, j] = numbers[tuple(g[x] for x in f)]
    # What a function leads to from the start, and a class after it, in one table.
    flags = np.array([[steps[f[START]][k][1] for k in range(n_kinds)] + [0] * (16 - n_kinds) for f in known], np.uint8)
    kinds = np.array([numbers[f] for f in functions], np.uint8)
    return kinds, then.ravel(), flags.ravel()


def _then(table: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    at = first.astype(np.uint16)
    at <<= _BITS
    at |= second
    return table.take(at)


def _compose_before(functions: np.ndarray, then: np.ndarray) -> np.ndarray:
    """For each place the composition of all functions before it.

    Composition is associative, so rows of a fixed length are combined all at
    once, the rows' totals by the same scan, and the totals applied to the rows.
    """
    n = len(functions)
    if n <= _ROW:
        out, so_far = np.zeros(n, np.uint8), 0
        for i, f in enumerate(functions.tolist()):
            out[i] = so_far
            so_far = int(then[so_far << _BITS | f])
        return out
    rows = -(-n // _ROW)
    grid = np.zeros(rows * _ROW, np.uint8)
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, _ROW).T)
    totals = grid[0]
    for i in range(1, _ROW):
        totals = _then(then, totals, grid[i])
    state = _compose_before(totals, then)
    out = np.empty((_ROW, rows), np.uint8)
    for i in range(_ROW):
        out[i] = state
        state = _then(then, state, grid[i])
    return np.ascontiguousarray(out.T).ravel()[:n]


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Where pieces start in code points that end with a separator; separators start pieces of their own."""
    classes = kept("bpe_classes", _class_table)
    kinds, then, flags = kept("bpe_machine", _machine)
    kind = classes.take(points)
    at = _compose_before(kinds.take(kind), then).astype(np.uint16)
    at <<= 4
    at |= kind
    shown = flags.take(at)
    start = (shown & HERE).astype(bool) | (kind == SEPARATOR)
    start[:-1] |= (shown[1:] & BEFORE).astype(bool)
    return np.flatnonzero(start)


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a public vocabulary file: a base64 token and its id per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_NONE = np.int32(2**31 - 1)  # the rank of a pair that is not in the vocabulary


class PairRanks:
    """Ranks of pairs of ids, looked up for many pairs at once in an open hash table."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs = {
            (ranks[token[:k]] << 32) | ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        keys = np.array(list(pairs), np.uint64)
        values = np.array(list(pairs.values()), np.int32)
        self.bits = max(4, int(max(len(keys), 1) * 6).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, _NONE)
        self.single = np.array([ranks.get(bytes([k]), 0) for k in range(256)], np.int32)
        self.probes, slots = 0, self._slot(keys)
        while len(keys):  # one of those that meet at a free slot takes it, the others go one on
            free = self.values[slots] == _NONE
            self.keys[slots[free]] = keys[free]
            self.values[slots[free]] = values[free]
            left = self.keys[slots] != keys
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; an id below 0 is in none."""
        keys = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | right.astype(np.int64).astype(np.uint64)
        slots = self._slot(keys)
        found = self.values.take(slots)
        other = np.flatnonzero((self.keys.take(slots) != keys) & (found != _NONE))
        found[other] = _NONE
        for _ in range(self.probes - 1):
            if not len(other):
                break
            slots[other] = (slots[other] + 1) & ((1 << self.bits) - 1)
            here = slots[other]
            hit = self.keys[here] == keys[other]
            found[other[hit]] = self.values[here[hit]]
            other = other[~hit & (self.values[here] != _NONE)]
        return found


def _merge_rows(pieces: list[bytes], width: int, ranks: PairRanks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces of up to ``width`` bytes and how many each has.

    The pieces are rows; in each step every piece joins its pair of lowest rank,
    until none of a piece's pairs is in the vocabulary.
    """
    n = len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, n)
    data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
    ids = ranks.single[data]
    columns = np.arange(width)
    ids[columns >= sizes[:, None]] = -1
    best = ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
    best[columns[1:] >= sizes[:, None]] = _NONE
    rows = np.arange(n)
    done_ids = np.empty_like(ids)
    while len(rows):
        at = best.argmin(axis=1)
        here = np.arange(len(rows))
        rank = best[here, at]
        going = rank != _NONE
        if not going.all():
            done_ids[rows[~going]] = ids[~going]
            rows, ids, best, at, rank = rows[going], ids[going], best[going], at[going], rank[going]
            here = here[: len(rows)]
            if not len(rows):
                break
        ids[here, at] = rank
        # What follows the joined pair moves up by one.
        shift = np.minimum(columns + (columns > at[:, None]), width - 1)
        ids = np.take_along_axis(ids, shift, 1)
        ids[:, -1] = -1
        best = np.take_along_axis(best, np.minimum(columns[:-1] + (columns[:-1] >= at[:, None]), width - 2), 1)
        best[:, -1] = _NONE
        left = np.maximum(at - 1, 0)
        before = ranks(ids[here, left], ids[here, at])
        best[here, left] = np.where(at > 0, before, best[here, left])
        inner = at < width - 1
        after = ranks(ids[here, at], ids[here, np.minimum(at + 1, width - 1)])
        best[here[inner], at[inner]] = np.where(ids[here[inner], at[inner] + 1] >= 0, after[inner], _NONE)
    kept_ids = done_ids >= 0
    return done_ids[kept_ids], kept_ids.sum(axis=1)


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with the pairs in a heap: steps grow with the length times its logarithm."""
    n = len(piece)
    ends = list(range(1, n + 1))  # of the part that starts here; 0 where none does any more
    before = list(range(-1, n - 1))

    def rank(i: int) -> int | None:
        j = ends[i]
        return ranks.get(piece[i : ends[j]]) if j < n else None

    heap = [(r, i, ends[ends[i]]) for i in range(n - 1) if (r := rank(i)) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        j = ends[i]
        if not j or j >= n or ends[j] != end:
            continue  # one of the two parts has changed since
        ends[i], ends[j] = end, 0
        if end < n:
            before[end] = i
            if (r := rank(i)) is not None:
                heappush(heap, (r, i, ends[end]))
        if (p := before[i]) >= 0 and (r := rank(p)) is not None:
            heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


class Pieces:
    """The ids of pieces met so far. It is emptied when full: what is forgotten is merged again."""

    def __init__(self, path: str) -> None:
        self.ranks = read_ranks(path)
        self.pair_ranks = PairRanks(self.ranks)
        self.number: dict[str, int] = {}
        self.ids, self.first, self.count = (np.zeros(0, t) for t in (np.int32, np.int64, np.int64))

    def of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in a row, and how many each has."""
        if len(self.number) > CACHE:
            self.number = {}
            self.ids, self.first, self.count = self.ids[:0], self.first[:0], self.count[:0]
        known = self.number.get
        numbers = [known(p, -1) for p in pieces]
        if -1 in numbers:
            self._add(list({p for p, k in zip(pieces, numbers, strict=True) if k < 0}))
            known = self.number.__getitem__
            numbers = [k if k >= 0 else known(p) for p, k in zip(pieces, numbers, strict=True)]
        at = np.array(numbers, np.int64)
        count = self.count[at]
        ends = np.cumsum(count)
        spots = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[at] - ends + count, count)
        return self.ids[spots], count

    def _add(self, new: list[str]) -> None:
        """Merges pieces not met before, those of like length side by side."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in new:
            raw = piece.encode()
            width = 1 if raw in self.ranks else 0 if len(raw) > 64 else 4 * -(-len(raw) // 4)
            by_width.setdefault(width, []).append((piece, raw))
        for width, found in by_width.items():
            raws = [raw for _, raw in found]
            if width > 1:
                ids, count = _merge_rows(raws, width, self.pair_ranks)
            else:
                lists = [[self.ranks[r]] if width else _merge_long(r, self.ranks) for r in raws]
                ids = np.array(list(chain.from_iterable(lists)), np.int32)
                count = np.array([len(x) for x in lists], np.int64)
            self.number.update(zip((p for p, _ in found), range(len(self.count), len(self.count) + len(found)), strict=True))
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.ids = np.concatenate([self.ids, ids])


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in runs of about CHARS characters; a longer text is a run of its own."""
    some, chars = [], 0
    for text in texts:
        if some and chars + len(text) > CHARS:
            yield some
            some, chars = [], 0
        some.append(text)
        chars += len(text) + 1
    if some:
        yield some


def _encoded(column: pa.Array, path: str) -> pa.Array:
    pieces = kept(f"bpe_pieces_{path}", lambda: Pieces(path))
    ids, offsets, n_ids, n_pieces = [], [], [], []
    for texts in _chunks(column.fill_null("").to_pylist()):
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        points[ends] = _SEP
        starts = piece_starts(points)
        inside = points[starts[:-1]] != _SEP
        first, last = starts[:-1][inside], starts[1:][inside]
        found, sizes = pieces.of([joined[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)])
        before = np.concatenate([[0], np.cumsum(sizes)])
        bounds = np.concatenate([[0], np.searchsorted(first, ends)])
        counts = np.diff(bounds)
        ids.append(found)
        offsets.append((before[:-1] - np.repeat(before[bounds[:-1]], counts)).astype(np.int32))
        n_ids.append(np.diff(before[bounds]))
        n_pieces.append(counts)
    none = [np.zeros(0, np.int32)]

    def lists(values: list[np.ndarray], sizes: list[np.ndarray]) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(np.concatenate(none + sizes))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(none + values)))

    return pa.StructArray.from_arrays([lists(ids, n_ids), lists(offsets, n_pieces)], ["ids", "pieces"])


def bpe_encode(text: Column | str, path: str) -> Column:
    """A struct of ``ids`` and ``pieces``, the place in ids at which each piece starts.

    Whole texts are split as by the pattern of the byte-level vocabularies, and
    each piece is merged by the ranks in the file at ``path``, without special
    tokens. A null text is encoded as an empty one: no ids.
    """

    @arrow_udf("struct<ids array<int>, pieces array<int>>")
    def encode(column: pa.Array) -> pa.Array:
        return _encoded(column, path)

    return encode(text)


def _token_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in a row, and each id's place and length there."""
    ranks = read_ranks(path)
    length = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
    length[list(ranks.values())] = [len(t) for t in ranks]
    data = np.frombuffer(b"".join(sorted(ranks, key=ranks.__getitem__)), np.uint8)
    return data, np.cumsum(length) - length, length


def bpe_decode(ids: Column | str, path: str) -> Column:
    """The bytes that ids stand for; null for null.

    All ids of a batch are looked up at once; the offsets of the lists of ids
    give each row its stretch of the bytes.
    """

    @arrow_udf("binary")
    def decode(column: pa.Array) -> pa.Array:
        return _decoded(column, path)

    return decode(ids)


def _decoded(column: pa.Array, path: str) -> pa.Array:
    data, place, length = kept(f"bpe_tokens_{path}", lambda: _token_table(path))
    out: list[bytes | None] = []
    for k in range(0, len(column), 256):
        part = column.slice(k, 256)
        flat = part.flatten().to_numpy(zero_copy_only=False)
        sizes = length[flat]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        spots = np.arange(ends[-1]) + np.repeat(place[flat] - ends[:-1], sizes)
        joined = data[spots].tobytes()
        rows = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy())])
        bounds = ends[rows].tolist()
        known = part.is_valid().to_pylist()
        out += [joined[a:b] if ok else None for a, b, ok in zip(bounds, bounds[1:], known, strict=False)]
    return pa.array(out, pa.binary())


def bpe_decode_pieces(ids: Column, pieces: Column, first: Column, count: Column, path: str) -> Column:
    """The bytes of ``count`` pieces from the ``first`` (0, 1, ...) on, found by their offsets in the ids."""
    start = F.get(pieces, first)
    end = F.coalesce(F.get(pieces, first + count), F.size(ids))
    return bpe_decode(F.slice(ids, start + 1, end - start), path)


def bpe_documents(documents: DataFrame, path: str) -> DataFrame:
    """Every document's ids, the offsets of its pieces, and the bytes decoded from them.

    Repeated rows are encoded alike; an empty table gives no rows; other columns
    are not looked at. Columns: doc_id, ids, pieces, decoded.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            so_far = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            first = 0
            while first < batch.num_rows:  # a worker holds what belongs to about CHARS characters
                last = max(first + 1, int(np.searchsorted(so_far, so_far[first] + CHARS, "right")) - 1)
                coded = _encoded(batch.column("text").slice(first, last - first), path)
                ids = coded.field("ids")
                yield pa.record_batch(
                    [batch.column("doc_id").slice(first, last - first), ids, coded.field("pieces"), _decoded(ids, path)],
                    ["doc_id", "ids", "pieces", "decoded"],
                )
                first = last

    return documents.select("doc_id", "text").mapInArrow(
        code, "doc_id long, ids array<int>, pieces array<int>, decoded binary"
    )


def vocabulary(spark: SparkSession, name: str = "byte_bpe_50k.tiktoken") -> str:
    """The path of a public vocabulary, installed alike on the driver and executors."""
    import public_tokenizers

    return public_tokenizers.path(name)
