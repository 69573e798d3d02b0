"""Which rows would a stream have considered late?  Answered over a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.durations import interval, milliseconds

# Batches per chunk of the two-level running maximum.
CHUNK_BATCHES = 1024


def replay_watermark(
    events: DataFrame,
    trigger_interval: str,
    watermark_delay: str,
    window_duration: str | None = None,
    arrival_col: str = "arrival_time",
    time_col: str = "event_time",
) -> DataFrame:
    """Add the watermark each row met on arrival: ``batch_start, watermark, is_late``.

    Rows are put into micro-batches by arrival time.  As in a running query, a
    batch meets the watermark left by the batches before it: their greatest
    event time minus the delay, null for the first.  A row is late if it is
    older than that; with ``window_duration``, ``is_dropped`` tells whether its
    tumbling window was closed already, which is the test an aggregate applies.

    The greatest event time is found per batch first.  The running maximum
    over batches works within chunks of batches and then over one row per
    chunk, so no task orders the rows or even all batches.  The rows are read
    twice, for the peaks with two columns only; over stored valid rows with
    their arrival time, that is two columns of a table and no parsing.

    Every row is kept.  One without an arrival time belongs to no batch and
    meets no watermark; one without an event time is not late.  As in a running
    query, watermarks have milliseconds.
    """
    batched = events.withColumn("batch_start", _slot(arrival_col, trigger_interval))
    chunk_length = f"{CHUNK_BATCHES * milliseconds(trigger_interval)} milliseconds"
    peaks = (
        batched.where("batch_start IS NOT NULL")
        .groupBy("batch_start")
        .agg(F.date_trunc("millisecond", F.max(time_col)).alias("peak"))
        .withColumn("chunk", F.window("batch_start", chunk_length)["start"])
    )

    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        peaks.groupBy("chunk")
        .agg(F.max("peak").alias("peak"))
        .select("chunk", F.max("peak").over(before.orderBy("chunk")).alias("peak_before_chunk"))
    )
    within = F.max("peak").over(before.partitionBy("chunk").orderBy("batch_start"))
    watermarks = (
        peaks.select("chunk", "batch_start", within.alias("peak_in_chunk"))
        # a left join leaves both sides of it one shuffled aggregate to share
        .join(chunks, "chunk", "left")
        .select(
            "batch_start",
            (F.greatest("peak_in_chunk", "peak_before_chunk") - interval(watermark_delay)).alias(
                "watermark"
            ),
        )
    )

    late = F.coalesce(F.col(time_col) < F.col("watermark"), F.lit(False))
    replayed = batched.join(watermarks, "batch_start", "left").withColumn("is_late", late)
    if window_duration is None:
        return replayed
    end = _slot(time_col, window_duration) + interval(window_duration)
    closed = end <= F.col("watermark")
    return replayed.withColumn("is_dropped", F.coalesce(closed, F.lit(False)))


def _slot(time_col: str, length: str) -> Column:
    """Start of the slot that holds a time; unlike ``window`` it keeps rows without one."""
    step = milliseconds(length) * 1000
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step)))


def late_rows(
    events: DataFrame,
    trigger_interval: str,
    watermark_delay: str,
    arrival_col: str = "arrival_time",
    time_col: str = "event_time",
) -> DataFrame:
    """The rows that arrived behind the watermark, with the watermark they met."""
    replayed = replay_watermark(
        events,
        trigger_interval,
        watermark_delay,
        arrival_col=arrival_col,
        time_col=time_col,
    )
    return replayed.where("is_late").drop("is_late")
