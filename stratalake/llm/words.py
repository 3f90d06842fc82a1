"""Words and 5-word shingles of many texts at once, as 64-bit hashes. Runs inside tasks."""

from __future__ import annotations

import numpy as np

from stratalake.llm.worker import kept

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_SALTS = [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all of it."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to ``size``; a long text extends them for itself only."""

    def make(n: int) -> tuple[np.ndarray, np.ndarray]:
        inverse = pow(_BASE, -1, 1 << 64)
        return tuple(
            np.cumprod(np.concatenate([np.ones(1, U64), np.full(n - 1, base, U64)]), dtype=U64)
            for base in (_BASE, inverse)
        )

    usual = 1 << 21
    return kept("powers", lambda: make(usual)) if size <= usual else make(size)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+``, A-Z lowered, and the offsets of each text's words."""
    offsets = offsets - offsets[0]
    n = int(offsets[-1])
    white = (data == 32) | ((data >= 9) & (data <= 13))
    first, last = np.empty(n, bool), np.empty(n, bool)
    if n:
        first[0] = last[-1] = True
        first[1:], last[:-1] = white[:-1], white[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]
        first[inner], last[inner - 1] = True, True
    starts, ends = np.flatnonzero(first & ~white), np.flatnonzero(last & ~white) + 1
    lowered = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum((lowered.astype(U64) + U64(1)) * power[:n], out=sums[1:], dtype=U64)
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(hashes + (ends - starts).astype(U64) * U64(_SALTS[0])), np.searchsorted(starts, offsets)


def line_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and word counts of all lines, split at line feeds, and the offsets of each text's lines."""
    offsets = offsets - offsets[0]
    n = int(offsets[-1])
    feed = data == 10
    white = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~white
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    begins[1:] &= white[:-1] | first[1:]
    words = np.concatenate([[0], np.cumsum(begins)])
    # A text of k line feeds has k + 1 lines, an empty one too.
    breaks = np.flatnonzero(feed)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * power[:n], out=sums[1:], dtype=U64)
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64) * U64(_SALTS[1]))
    bounds = np.concatenate([[0], np.cumsum(np.diff(np.searchsorted(breaks, offsets)) + 1)])
    return hashes, words[ends] - words[starts], bounds


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5):
    """For each text the sorted distinct hashes of its shingles; fewer words make one shingle, none none."""
    words, bounds = word_hashes(data, offsets)
    salts = [U64(s) for s in _SALTS[:width]]
    total = max(len(words) - width + 1, 0)
    sums = np.zeros(total, U64)
    for k in range(width):
        sums += words[k : k + total] * salts[k]
    shingles = mix(sums)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            found = np.sort(shingles[a : b - width + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif b > a:
            short = sum(int(w) * _SALTS[k] for k, w in enumerate(words[a:b])) + (b - a)
            yield mix(np.array([short % (1 << 64)], U64))
        else:
            yield np.zeros(0, U64)
