"""What happens to dead letters afterwards: rates, spikes, replay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.durations import interval, times
from sensorloom.functions.watermarks import watermarked
from sensorloom.operators.classify import classify, split
from sensorloom.operators.decode import decode


def dead_letter_volume(
    dead: DataFrame, window_duration: str, watermark_delay: str = "2 minutes"
) -> DataFrame:
    """Dead letters per window of ``quarantined_at`` and reason; table or stream."""
    return (
        watermarked(dead, "quarantined_at", watermark_delay)
        .groupBy(F.window("quarantined_at", window_duration), "error_reason")
        .agg(F.count(F.lit(1)).alias("dead_letters"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "error_reason",
            "dead_letters",
        )
    )


def dead_letter_rate(
    classified: DataFrame,
    window_duration: str,
    alert_rate: float = 0.5,
    watermark_delay: str = "2 minutes",
    time_col: str = "arrival_time",
) -> DataFrame:
    """Share of refused records per window of arrival; table or stream.

    ``is_spike`` marks windows whose rate reaches ``alert_rate``.
    """
    counted = (
        watermarked(classified, time_col, watermark_delay)
        .groupBy(F.window(time_col, window_duration))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(~F.col("is_valid")).alias("dead_letters"),
        )
    )
    rate = F.col("dead_letters") / F.col("records")
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "records",
        "dead_letters",
        rate.alias("rate"),
        (rate >= F.lit(alert_rate)).alias("is_spike"),
    )


def spikes_against_past(
    rates: DataFrame, window_duration: str, lookback: int = 6, factor: float = 2.0
) -> DataFrame:
    """Replace ``is_spike`` by a comparison with the ``lookback`` windows before.

    ``past_rate`` is the rate over those windows together, null if they are
    empty; a spike is ``factor`` times that or more.  Each window is sent ahead
    to the windows it serves as past of, which needs no global order.
    """
    step = interval(window_duration)
    ahead = rates.select(
        "records",
        "dead_letters",
        F.explode(F.sequence(F.lit(1), F.lit(lookback))).alias("steps"),
        "window_start",
    ).select(
        (F.col("window_start") + F.col("steps") * step).alias("window_start"),
        "records",
        "dead_letters",
    )
    past = ahead.groupBy("window_start").agg(
        (F.sum("dead_letters") / F.sum("records")).alias("past_rate")
    )
    spike = F.coalesce(F.col("rate") >= F.col("past_rate") * F.lit(factor), F.lit(False))
    return (
        rates.drop("is_spike").join(past, "window_start", "left").withColumn("is_spike", spike)
    )


def spikes_on_stream(
    classified: DataFrame,
    window_duration: str,
    lookback: int = 6,
    factor: float = 2.0,
    watermark_delay: str = "2 minutes",
    time_col: str = "arrival_time",
) -> DataFrame:
    """:func:`dead_letter_rate` with the spikes of :func:`spikes_against_past`; table or stream.

    A window and the ``lookback`` ones before it make one longer window that slides by
    a window's length and ends where the window does.  So the past needs no second read
    and no join: the longer windows are summed from the counts of the plain ones, under
    the same watermark, and a window is told as soon as it closes.  The state has a
    row per open window and, of the counts alone, ``lookback`` rows more.
    """
    step = interval(window_duration)
    counts = (
        watermarked(classified, time_col, watermark_delay)
        .groupBy(F.window(time_col, window_duration))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(~F.col("is_valid")).alias("refused"),
        )
        .select("records", "refused", F.col("window.start").alias("start"), F.window_time("window").alias("at"))
    )
    longer = F.window("at", times(window_duration, lookback + 1), window_duration)
    placed = counts.withColumn("over", longer)
    own = F.col("start") + step == F.col("over.end")

    def total(name: str, of_own: bool) -> Column:
        return F.coalesce(F.sum(F.when(own if of_own else ~own, F.col(name))), F.lit(0))

    summed = placed.groupBy("over").agg(
        total("records", True).alias("records"),
        total("refused", True).alias("dead_letters"),
        total("records", False).alias("past_records"),
        total("refused", False).alias("past_refused"),
    )
    rate = F.col("dead_letters") / F.col("records")
    past = F.try_divide(F.col("past_refused"), F.col("past_records"))
    return summed.where("records > 0").select(
        (F.col("over.end") - step).alias("window_start"),
        F.col("over.end").alias("window_end"),
        "records",
        "dead_letters",
        rate.alias("rate"),
        past.alias("past_rate"),
        F.coalesce(rate >= past * F.lit(factor), F.lit(False)).alias("is_spike"),
    )


def replay(
    dead: DataFrame,
    repair: Callable[[DataFrame], DataFrame] | None = None,
    arrival_col: str | None = None,
    **classify_options,
) -> tuple[DataFrame, DataFrame]:
    """Send dead letters through decode, classify and split again.

    ``repair`` may rewrite ``raw_value`` first.  Gives the readings that are
    good now and those that are still refused.  ``arrival_col`` may be any time
    stamp of the letters, such as ``quarantined_at``; ``future_tolerance`` needs it.
    """
    repaired = dead if repair is None else repair(dead)
    decoded = decode(repaired, value_col="raw_value", arrival_col=arrival_col)
    return split(classify(decoded, **classify_options))
