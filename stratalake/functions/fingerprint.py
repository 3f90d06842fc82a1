"""Row fingerprints for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def hashdiff(values: Sequence[Column | str], sep: str = "||") -> Column:
    """SHA-256 (hex) over the values as text, joined by ``sep``.

    NULL counts as the empty string, so each value keeps its place; a change
    between NULL and ``''`` is therefore not a change.
    """
    texts = [F.col(v) if isinstance(v, str) else v for v in values]
    filled = [F.coalesce(t.cast("string"), F.lit("")) for t in texts]
    return F.sha2(F.concat_ws(sep, *filled), 256)
