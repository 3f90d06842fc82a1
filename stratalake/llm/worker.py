"""What the functions in Python workers share: texts as byte arrays, and state kept by a worker."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import SimpleNamespace
from typing import Any

import numpy as np
import pyarrow as pa

# Text worked on at a time: a few arrays of eight bytes per byte of it stay small.
SLICE_BYTES = 1 << 20


def kept(name: str, make: Callable[[], Any]) -> Any:
    """A value made once per Python worker. Functions travel by value, so their globals are new in each task."""
    store = sys.modules.setdefault("_stratalake_worker", SimpleNamespace())
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow column and the offsets of each; null is empty."""
    texts = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), ends


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes; a longer text is a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last
