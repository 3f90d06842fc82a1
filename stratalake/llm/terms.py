"""Words of whole texts as Spark expressions."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, functions as F


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, no other letter: Spark's lower() would change those too, so it serves texts of ASCII only."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def words_between(text: Column, separators: str) -> Column:
    """The words of ``text``, A-Z lowered, between runs of ``separators`` (a regular expression); null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), separators), "")
