"""The whole chain from messages to result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sensorloom.operators.classify import classify, split
from sensorloom.operators.decode import decode
from sensorloom.operators.windows import windowed_aggregates


def telemetry_tables(
    raw: DataFrame,
    window_duration: str = "1 minute",
    watermark_delay: str = "2 minutes",
    slide_duration: str | None = None,
    merge_redelivered: bool = False,
    arrival_col: str | None = None,
    **classify_options,
) -> dict[str, DataFrame]:
    """``valid``, ``dead_letter`` and ``aggregates`` of a table or stream of messages.

    ``merge_redelivered`` counts copies of an event once in the aggregates.
    ``arrival_col`` names the column of ``raw`` that says when a message came in
    (``timestamp`` of a Kafka source); ``future_tolerance`` needs it.
    """
    valid, dead = split(classify(decode(raw, arrival_col=arrival_col), **classify_options))
    return {
        "valid": valid,
        "dead_letter": dead,
        "aggregates": windowed_aggregates(
            valid, window_duration, watermark_delay, slide_duration, not merge_redelivered
        ),
    }
