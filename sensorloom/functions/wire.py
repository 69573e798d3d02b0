"""Columns that read single fields of a wire record.

All of them are built-in Spark expressions and none of them throws on bad
input under ANSI mode: a value that cannot be read becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom.contract import (
    CORRUPT_RECORD,
    EVENT_TIME_FORMAT,
    EVENT_TIME_SUFFIX,
    RECORD_SCHEMA,
)


def record(text: Column) -> Column:
    """Struct of the wire fields; its corrupt field holds the text if it is not an object."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD}
    return F.from_json(text, RECORD_SCHEMA, options)


def number(text: Column) -> Column:
    """Double, or null where the text is not a number."""
    return text.try_cast("double")


def instant(text: Column) -> Column:
    """Timestamp of a UTC text with or without milliseconds, else null."""
    utc = F.when(text.endswith(EVENT_TIME_SUFFIX), text)
    return F.try_to_timestamp(utc, F.lit(EVENT_TIME_FORMAT))
