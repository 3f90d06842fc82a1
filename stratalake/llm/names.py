"""Column names that clash with none of the caller's."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, led by as many underscores as keep it apart from all ``taken`` ones; case does not count."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name = "_" + name
    return name
