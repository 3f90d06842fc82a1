from .fingerprint import hashdiff
from .money import sales_amounts
from .text import (
    norm_key,
    norm_lower,
    norm_phone,
    norm_title,
    norm_upper,
    parse_bool,
)

__all__ = [
    "hashdiff",
    "norm_key",
    "norm_lower",
    "norm_phone",
    "norm_title",
    "norm_upper",
    "parse_bool",
    "sales_amounts",
]
