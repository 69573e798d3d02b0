"""Devices that have gone quiet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.durations import interval
from sensorloom.functions.watermarks import watermarked


def quiet_periods(
    events: DataFrame,
    threshold: str,
    time_col: str = "event_time",
    as_of: Column | None = None,
    at_end: bool = False,
) -> DataFrame:
    """Silences longer than ``threshold`` per device, over a table.

    Gives ``device_id, quiet_from, quiet_until``; the latter is null for a
    device that is still silent at ``as_of``, or with ``at_end`` at the last
    reading of the fleet.  Without either, those are left out.

    Two readings in the same slot of ``threshold`` length cannot be that far
    apart, so the first and last reading per slot are enough.  They come from
    a map-side combined aggregate, and the ordering step after it sees at most
    one row per device and slot however much a device has sent.
    """
    slots = events.groupBy("device_id", F.window(time_col, threshold).alias("slot")).agg(
        F.min(time_col).alias("first_seen"), F.max(time_col).alias("last_seen")
    )
    by_time = Window.partitionBy("device_id").orderBy("first_seen")
    silences = slots.select(
        "device_id",
        F.col("last_seen").alias("quiet_from"),
        F.lead("first_seen").over(by_time).alias("quiet_until"),
    )
    if at_end:
        # The first reading is never the later one.  It is asked for so that both sides
        # are one aggregate, which is then computed once.
        as_of = slots.agg(F.greatest(F.max("last_seen"), F.min("first_seen"))).scalar()
    until = F.col("quiet_until") if as_of is None else F.coalesce("quiet_until", as_of)
    return silences.where(until > F.col("quiet_from") + interval(threshold))


def quiet_signals(events: DataFrame, threshold: str, watermark_delay: str) -> DataFrame:
    """Activity sessions per device; a session that closes is a quiet signal.

    Gives ``device_id, active_from, quiet_from, event_count``.  On a stream in
    append mode a row appears when the watermark passes the last reading plus
    ``threshold``.  The watermark is moved by the whole fleet: if every device
    stops, nothing is reported, unless there is a heartbeat
    (:func:`quiet_signals_with_heartbeat`).
    """
    return _sessions(watermarked(events, "event_time", watermark_delay), threshold)


def quiet_signals_with_heartbeat(
    events: DataFrame,
    heartbeats: DataFrame,
    threshold: str,
    watermark_delay: str,
    heartbeat_delay: str,
    beat_col: str = "timestamp",
) -> DataFrame:
    """``quiet_signals`` that also tells of a fleet that has fallen silent as a whole.

    ``heartbeats`` is a stream of clock ticks in ``beat_col``, such as Spark's rate
    source.  Readings and ticks carry a watermark each, and the query must go by the
    greater one: start it in a session with ``spark.sql.streaming.multipleWatermarkPolicy``
    ``max`` (:func:`sensorloom.session.heartbeat_session`).  Ticks then move time on when
    no reading does.  ``heartbeat_delay`` is how far a reading may lag behind the
    clock; a reading that is older than both watermarks is dropped as late.

    Ticks belong to no device.  They share one session, which is left out at the
    end by its count of devices; a filter before that would take them from the
    watermark as well.
    """
    readings = watermarked(events, "event_time", watermark_delay).select("device_id", "event_time")
    ticks = heartbeats.select(F.col(beat_col).alias("event_time"))
    beats = watermarked(ticks, "event_time", heartbeat_delay).select(
        F.lit(None).cast("string").alias("device_id"), "event_time"
    )
    return _sessions(readings.unionByName(beats), threshold).where("event_count > 0")


def _sessions(rows: DataFrame, threshold: str) -> DataFrame:
    return (
        rows.groupBy(F.session_window("event_time", threshold).alias("session"), "device_id")
        .agg(F.count("device_id").alias("event_count"))
        .select(
            "device_id",
            F.col("session.start").alias("active_from"),
            (F.col("session.end") - interval(threshold)).alias("quiet_from"),
            "event_count",
        )
    )
