"""Watermarks that are defined once."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: the metadata entry by which Spark marks a watermarked column.
_DELAY_ENTRY = "spark.watermarkDelayMs"


def watermarked(rows: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Put a watermark on ``time_col`` unless it carries one already.

    In a chain of stateful steps the first watermark is the one that counts.
    A second one would only see what the first step has let go, and as the
    query goes by the least of its watermarks, everything would wait for it.
    A table needs none.
    """
    if not rows.isStreaming or _DELAY_ENTRY in rows.schema[time_col].metadata:
        return rows
    return rows.withWatermark(time_col, delay)
