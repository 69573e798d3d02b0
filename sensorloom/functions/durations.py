"""Duration texts such as ``"2 minutes"``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds per unit.
UNIT_MILLISECONDS = {
    "millisecond": 1,
    "second": 1_000,
    "minute": 60_000,
    "hour": 3_600_000,
    "day": 86_400_000,
    "week": 604_800_000,
}


def milliseconds(duration: str) -> int:
    """Length of a duration of fixed units, e.g. ``"1 hour 30 minutes"``."""
    parts = re.findall(r"(\d+)\s*([a-z]+?)s?\b", duration.lower())
    leftover = re.sub(r"(\d+)\s*([a-z]+?)s?\b", "", duration.lower()).strip()
    if not parts or leftover or any(unit not in UNIT_MILLISECONDS for _, unit in parts):
        raise ValueError(f"not a duration of fixed units: {duration!r}")
    return sum(int(count) * UNIT_MILLISECONDS[unit] for count, unit in parts)


def times(duration: str, number: int) -> str:
    """A duration ``number`` times as long."""
    return f"{milliseconds(duration) * number} milliseconds"


def interval(duration: str) -> Column:
    """The duration as a column that can be added to a timestamp."""
    ms = milliseconds(duration)
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ms).cast("decimal(18,3)") / 1000)
