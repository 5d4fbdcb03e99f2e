"""Check-in text and 12-hour clock parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import FLEXIBLE_TIME

# Leading "h:mm AM" of a text such as " 2:00 AM (next day)".
CLOCK_PREFIX = r"^\s*(\d{1,2}:\d{2} [AaPp][Mm])"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def checkin_window(c: Column | str) -> tuple[Column, Column]:
    """Split check-in text into (start, end) text.

    ``"10:00 AM - 11:30 PM, self check-in"`` -> (``10:00 AM``, ``11:30 PM``);
    ``"After 3:00 PM"`` -> (``3:00 PM``, NULL); ``"Flexible"`` -> both
    ``12:00 AM``.  Pieces are trimmed so that equal times count as one value.
    """
    first = F.get(F.split(_col(c), ","), 0)
    text = F.regexp_replace(first, r"After\s", "")
    parts = F.split(text, "-")
    start = F.trim(F.get(parts, 0))
    end = F.trim(F.get(parts, 1))
    flexible = start == F.lit("Flexible")
    end = F.when(flexible, F.lit(FLEXIBLE_TIME)).otherwise(end)
    start = F.regexp_replace(start, "Flexible", FLEXIBLE_TIME)
    return start, end


def clock_24h(c: Column | str) -> Column:
    """``"3:00 PM "`` -> ``"15:00"``; text without a leading 12-hour time -> NULL."""
    clock = F.regexp_extract(_col(c), CLOCK_PREFIX, 1)
    return F.date_format(F.try_to_timestamp(clock, F.lit("h:mm a")), "HH:mm")
