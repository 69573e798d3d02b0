"""Reports over the result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("total"))


def recent_windows(aggregates: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` latest windows; metric and start break ties, so it is one answer."""
    order = [F.desc("window_end"), "device_id", "metric_type", F.desc("window_start")]
    return aggregates.orderBy(*order).limit(n)


def recent_dead_letters(dead: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` latest dead letters; all of a micro-batch carry the same stamp."""
    columns = ["quarantined_at", "device_id", "error_reason", "raw_value"]
    order = [F.desc("quarantined_at"), "raw_value", "device_id", "error_reason"]
    return dead.select(*columns).orderBy(*order).limit(n)


def metric_rollup(aggregates: DataFrame) -> DataFrame:
    """Windows and events per metric, with the plain mean of the window means."""
    return (
        aggregates.groupBy("metric_type")
        .agg(
            F.count(F.lit(1)).alias("windows"),
            F.sum("event_count").alias("total_events"),
            F.avg("avg_value").alias("overall_avg"),
        )
        .orderBy("metric_type")
    )


def weighted_rollup(aggregates: DataFrame) -> DataFrame:
    """As :func:`metric_rollup`, but every event weighs the same.

    It weighs window means, which are rounded to three places, so it may lie up
    to half a thousandth off the mean of the events themselves.
    """
    weighted = F.sum(F.col("avg_value") * F.col("event_count")) / F.sum("event_count")
    return (
        aggregates.groupBy("metric_type")
        .agg(
            F.count(F.lit(1)).alias("windows"),
            F.sum("event_count").alias("total_events"),
            weighted.alias("weighted_avg"),
        )
        .orderBy("metric_type")
    )


def route_totals(classified: DataFrame) -> DataFrame:
    """Valid and refused records, counted in one pass: (name, total)."""
    counts = classified.agg(
        F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("dead_letter")
    )
    return counts.unpivot([], ["valid", "dead_letter"], "name", "total")


def reason_breakdown(dead: DataFrame) -> DataFrame:
    """Dead letters per reason, most frequent first."""
    return (
        dead.groupBy("error_reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "error_reason")
    )
