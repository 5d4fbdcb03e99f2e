"""Text flags to booleans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(c: Column | str, true_value: str = "t") -> Column:
    """``"t"`` -> true; anything else, NULL included -> false."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col == F.lit(true_value), F.lit(False))
