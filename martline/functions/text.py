"""Text column expressions (all JVM built-ins, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PLAIN_TEXT_PATTERN, SYMBOL_RANGES


def symbol_class(ranges: list[tuple[int, int]] = SYMBOL_RANGES) -> str:
    """Java regex character class covering the given code point ranges."""
    parts = "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in ranges)
    return f"[{parts}]"


SYMBOL_CLASS = symbol_class()


def strip_symbols(c: Column | str) -> Column:
    """Replace each emoji or symbol code point by one space (runs are kept apart).

    No symbol is ASCII, so texts with as many bytes as characters are passed on unsearched.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.octet_length(col) == F.char_length(col), col).otherwise(F.regexp_replace(col, SYMBOL_CLASS, " "))


def strip_quotes(c: Column | str, quotes: str = "'") -> Column:
    """Delete every character of ``quotes`` (single quote by default)."""
    return F.translate(F.col(c) if isinstance(c, str) else c, quotes, "")


def amenity_list(c: Column | str) -> Column:
    """``"['TV', 'Wifi',Heating]"`` -> ``["TV", "Wifi", "Heating"]``.

    Trim, split on commas, trim each piece and drop brackets and single
    quotes.  Empty pieces are dropped.
    """
    col = F.col(c) if isinstance(c, str) else c
    pieces = F.split(F.trim(col), r",\s*")
    cleaned = F.transform(pieces, lambda p: F.trim(F.translate(F.trim(p), "[]'", "")))
    return F.filter(cleaned, lambda p: p != F.lit(""))


def is_plain_text(c: Column | str, pattern: str = PLAIN_TEXT_PATTERN) -> Column:
    """True when the value is plain text; NULL stays NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return col.rlike(pattern)
