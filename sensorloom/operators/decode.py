"""Envelope <-> columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.contract import CORRUPT_RECORD, WIRE_FIELDS
from sensorloom.functions import wire


def decode(
    raw: DataFrame,
    key_col: str = "key",
    value_col: str = "value",
    arrival_col: str | None = None,
) -> DataFrame:
    """Read the JSON text of every message into flat, still unchecked columns.

    Works on a table and on a stream; key and value may be binary or text and
    the key may be absent.  No row is lost: text that is not a JSON object is
    kept in ``raw_value`` and flagged in ``corrupt_record``.  ``arrival_col``
    is carried along as ``arrival_time`` for the operators that need it.

    Text, time and number are each parsed once per row.  A one-element
    ``inline`` holds the result: a filter on decoded columns would otherwise
    be pushed below the parse and repeat it (see README, "Plans").
    """
    key = F.col(key_col) if key_col in raw.columns else F.lit(None)
    carried = [] if arrival_col is None else [F.col(arrival_col).alias("arrival_time")]

    messages = raw.select(
        key.cast("string").alias("device_key"),
        F.col(value_col).cast("string").alias("raw_value"),
        *carried,
    )
    records = messages.select("*", F.inline(F.array(wire.record(F.col("raw_value")))))
    typed = F.struct(
        wire.number(F.col("value")).alias("number"),
        wire.instant(F.col("timestamp")).alias("event_time"),
    )
    return records.select("*", F.inline(F.array(typed))).select(
        "device_key",
        "raw_value",
        "device_id",
        F.col("timestamp").alias("raw_timestamp"),
        "metric_type",
        F.col("number").alias("value"),
        "site_id",
        "firmware_version",
        F.col(CORRUPT_RECORD).alias("corrupt_record"),
        "event_time",
        *["arrival_time" for _ in carried],
    )


def encode(
    events: DataFrame,
    key_col: str = "device_id",
    payload_col: str | None = None,
    keep: Sequence[str] = (),
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Write events as (key, value) messages keyed by device.

    The value is the whole event: a JSON object of all columns, the wire fields
    first, without ``payload_col`` and ``keep``; ``fields`` names others.  A
    field that is null is left out of the object.  ``payload_col`` names a
    column of ready-made text that is sent as it is where it is not null.
    Columns named in ``keep`` travel beside the message.
    """
    if fields is None:
        aside = {payload_col, *keep}
        own = [name for name in events.columns if name not in aside]
        fields = [n for n in WIRE_FIELDS if n in own] + [n for n in own if n not in WIRE_FIELDS]
    value = F.to_json(F.struct(*fields))
    if payload_col is not None:
        value = F.coalesce(F.col(payload_col), value)
    return events.select(F.col(key_col).alias("key"), value.alias("value"), *keep)
