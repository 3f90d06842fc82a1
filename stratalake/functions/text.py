"""Text normalisers, Column in and Column out, all inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
TRUE_WORDS = ("1", "true", "t", "y", "yes")
NOT_PHONE = "[^0-9+]"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def norm_key(value: Column | str) -> Column:
    """Strip spaces (only spaces: a tab is part of the key)."""
    return F.trim(_col(value))


def norm_title(value: Column | str) -> Column:
    """Strip spaces and capitalise each space-separated word."""
    return F.initcap(norm_key(value))


def norm_upper(value: Column | str) -> Column:
    return F.upper(norm_key(value))


def norm_lower(value: Column | str) -> Column:
    return F.lower(norm_key(value))


def norm_phone(value: Column | str) -> Column:
    """Keep digits and plus signs."""
    return F.regexp_replace(_col(value), NOT_PHONE, "")


def parse_bool(value: Column | str) -> Column:
    """True for a yes-word in any case, false for anything else and for NULL."""
    word = F.lower(_col(value).cast("string"))
    return F.coalesce(word.isin(*TRUE_WORDS), F.lit(False))
