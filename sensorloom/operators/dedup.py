"""Redelivered events: the same reading sent more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.contract import EVENT_KEY
from sensorloom.functions.watermarks import watermarked


def merge_copies(
    events: DataFrame,
    watermark_delay: str = "2 minutes",
    keys: Sequence[str] | None = EVENT_KEY,
) -> DataFrame:
    """One row per event, by aggregation; for use before a window aggregate.

    Copies meet map-side, so an event that makes up a large part of the input
    reaches the shuffle as one row per task.

    Where copies differ outside ``keys``, the least combination of the other
    columns is kept, which does not depend on the order of arrival.  Columns
    that no later step reads are not computed at all; if they are read, Spark
    has to sort for them.  ``keys=None`` takes rows for copies only if they
    agree in every column, and that is a hash aggregate in any case.

    On a stream a row is passed on once the watermark reaches its event time, and
    a row that arrives behind the watermark is dropped, even if a window that
    would hold it is still open.  To count copies once in windows, use
    ``windowed_aggregates(.., count_copies=False)``, which drops no such row.
    """
    columns = events.columns
    identity = columns if keys is None else list(keys)
    others = [name for name in columns if name not in identity]
    grouped = watermarked(events, "event_time", watermark_delay).groupBy(*identity)
    if not others:
        return grouped.agg(F.count(F.lit(1)).alias("_copies")).select(*columns)
    return grouped.agg(F.min(F.struct(*others)).alias("_kept")).select(
        *[F.col(f"_kept.{name}") if name in others else F.col(name) for name in columns]
    )


def drop_copies_within_watermark(
    events: DataFrame,
    watermark_delay: str = "2 minutes",
    keys: Sequence[str] = EVENT_KEY,
    spread: int | None = None,
) -> DataFrame:
    """Pass the first copy of each event on at once; for streams only.

    Copies are recognised for as long as the watermark keeps their key.  The
    operator has to bring all copies of a key together, so with ``spread`` > 1
    they are first thinned out within ``spread`` independent slices: whatever
    the size of a group of copies, at most ``spread`` rows of it go on to the
    final step.  The result does not depend on the slice a copy lands in.  By
    default there are as many slices as shuffle partitions.

    Rows that arrive behind the watermark are dropped, since nothing is known of
    their earlier copies any more; ``dropped_rows`` of the query's metrics
    (:func:`sensorloom.streaming.metrics.recent_progress`) counts them.
    """
    if not events.isStreaming:
        raise ValueError("for streams only; use merge_copies on a table")
    if spread is None:
        spread = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arriving = watermarked(events, "event_time", watermark_delay)
    if spread > 1:
        slice_no = F.pmod(F.spark_partition_id(), F.lit(spread))
        arriving = (
            arriving.withColumn("_slice", slice_no)
            .dropDuplicatesWithinWatermark([*keys, "_slice"])
            .drop("_slice")
        )
    return arriving.dropDuplicatesWithinWatermark(list(keys))
