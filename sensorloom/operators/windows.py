"""Event-time window aggregates."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.contract import AGGREGATE_COLUMNS, EVENT_KEY
from sensorloom.functions.durations import milliseconds
from sensorloom.functions.watermarks import watermarked


# Means are taken over values in millionths, which add up exactly in any order.
UNITS = 1_000_000


def _millionths() -> Column:
    """The value in whole millionths, null where it is no number or does not fit."""
    return F.round(F.col("value") * UNITS).try_cast("long")


def _statistics() -> list[Column]:
    return [
        F.try_sum(_millionths()).alias("total"),
        F.count(_millionths()).alias("totalled"),
        F.count("value").alias("measured"),
        F.avg("value").alias("rough"),
        F.count(F.lit(1)).alias("event_count"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    ]


def _mean() -> Column:
    """Mean at three places, half away from zero, in whole numbers throughout.

    The order of rows and of partial sums has no say in it.  A group with values
    that do not fit, such as NaN or 1e15, gets the rounded mean of doubles.
    """
    thousandth = F.col("measured") * (UNITS // 1000)
    size = F.abs("total")
    half = F.when(2 * F.pmod(size, thousandth) >= thousandth, 1).otherwise(0)
    whole = (F.call_function("div", size, thousandth) + half) / 1000
    exact = F.when(F.col("total") < 0, -whole).otherwise(whole)
    fits = F.col("total").isNotNull() & (F.col("totalled") == F.col("measured"))
    return F.when(fits, exact).otherwise(F.round("rough", 3))


def _flat(aggregated: DataFrame) -> DataFrame:
    """Flatten the window and round the mean, which is the only rounded column."""
    made = {
        "window_start": F.col("window.start"),
        "window_end": F.col("window.end"),
        "avg_value": _mean(),
    }
    return aggregated.select(*[made.get(n, F.col(n)).alias(n) for n in AGGREGATE_COLUMNS])


def finished_windows(partial: DataFrame) -> DataFrame:
    """Result rows of windows whose running statistics are columns already."""
    return _flat(partial)


def windowed_aggregates(
    valid: DataFrame,
    window_duration: str = "1 minute",
    watermark_delay: str = "2 minutes",
    slide_duration: str | None = None,
    count_copies: bool = True,
) -> DataFrame:
    """Mean, count, minimum and maximum per window, device and metric.

    Windows are half open, start at the epoch, and are chosen by event time
    only.  With ``slide_duration`` a reading counts in every window that
    covers it.  On a stream the watermark bounds the state and drops readings
    whose window is closed; on a table it has no effect.

    ``count_copies=False`` counts redelivered readings (equal in device, metric,
    time and value) once.  They are merged within each window, so a reading is
    late by the end of its window and not by its own time, exactly as without.

    Every statistic is combined map-side, so a device that sends most of the
    rows reaches the shuffle as one partial row per task and window.
    """
    bucket = F.window("event_time", window_duration, slide_duration).alias("window")
    rows = watermarked(valid, "event_time", watermark_delay)
    if not count_copies:
        # As a number, since a row may carry one watermarked column only: the window.
        moment = F.unix_micros("event_time").alias("moment")
        key = [moment if name == "event_time" else name for name in EVENT_KEY]
        rows = rows.groupBy(bucket, *key).agg(F.count(F.lit(1)).alias("copies"))
        bucket = F.col("window")
    return _flat(rows.groupBy(bucket, "device_id", "metric_type").agg(*_statistics()))


def sliding_by_panes(
    valid: DataFrame, window_duration: str, slide_duration: str
) -> DataFrame:
    """Sliding windows over a table, for slides much shorter than the window.

    The plain form copies every reading into each of the duration/slide
    windows before it aggregates.  Here readings are aggregated once, into
    panes that tile both the window and the slide, and only the panes are
    copied.  The result is the same; for batch only, as a stream would judge
    lateness by the pane and not by the window.
    """
    if valid.isStreaming:
        raise ValueError("panes are for tables; use windowed_aggregates on a stream")
    pane_ms = gcd(milliseconds(window_duration), milliseconds(slide_duration))
    panes = valid.groupBy(
        F.window("event_time", f"{pane_ms} milliseconds").alias("pane"), "device_id", "metric_type"
    ).agg(*_statistics())
    merged = (
        panes.withColumn("pane_start", F.col("pane.start"))
        .groupBy(
            F.window("pane_start", window_duration, slide_duration), "device_id", "metric_type"
        )
        .agg(
            # A pane whose total does not fit spoils the count of totalled values too.
            F.try_sum("total").alias("total"),
            F.sum(F.when(F.col("total").isNotNull(), F.col("totalled"))).alias("totalled"),
            F.sum("measured").alias("measured"),
            (F.sum(F.col("rough") * F.col("measured")) / F.sum("measured")).alias("rough"),
            F.sum("event_count").alias("event_count"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
        )
    )
    return _flat(merged)
