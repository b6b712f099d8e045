"""Text cleaning of numbers-as-text and status tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Tag pattern, its capture form, leading-digits pattern, default state.
TAG_PATTERN = r"\[[^\]]+\]"
TAG_CAPTURE = r"\[([^\]]+)\]"
LEADING_DIGITS = r"^(\d+)"
DEFAULT_STATE = "normal"
# White space of any script, the no-break space included.
WHITE = r"[\s\p{Z}]"
# A whole number text: sign, digits with one point, exponent; or a named value. Casts to
# double would else accept the type suffixes d and f ('7f').
NUMBER = r"(?i)^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"


def decimal_comma(c) -> Column:
    """Number written with a decimal comma -> double; anything unparsable -> NULL.

    '61,5' -> 61.5, '1.234,5' -> NULL, '' -> NULL, '7f' -> NULL, 'Sin información' -> NULL.
    Numeric input goes through its text form first, so it passes unchanged.
    """
    txt = as_col(c).cast("string")
    pointed = F.replace(txt, F.lit(","), F.lit("."))
    return F.when(F.regexp_like(pointed, F.lit(NUMBER)), pointed.try_cast("double"))


def strip_tags(c) -> Column:
    """Remove every bracketed tag, then trim white space of any script."""
    return F.regexp_replace(F.regexp_replace(as_col(c), TAG_PATTERN, ""), f"^{WHITE}+|{WHITE}+$", "")


def state_tag(c) -> Column:
    """First bracketed tag, lower-cased; 'normal' when there is none."""
    tag = F.regexp_extract(as_col(c), TAG_CAPTURE, 1)
    return F.coalesce(F.lower(F.nullif(tag, F.lit(""))), F.lit(DEFAULT_STATE))


def leading_int(c) -> Column:
    """Leading digits as bigint ('19G' -> 19); no digits -> NULL."""
    return F.regexp_extract(as_col(c), LEADING_DIGITS, 1).try_cast("bigint")


def entity_name(c) -> Column:
    """Endpoint path -> entity name: strip '/' at both ends, inner '/' -> '_'."""
    return F.regexp_replace(F.regexp_replace(as_col(c), r"^/+|/+$", ""), "/", "_")
