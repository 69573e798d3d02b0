"""Give every record at most one reason, and route it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.contract import VALID_COLUMNS
from sensorloom.functions.checks import first_reason, rules


def classify(
    decoded: DataFrame,
    strict_null_metric: bool = False,
    future_tolerance: str | None = None,
) -> DataFrame:
    """Add ``error_reason`` (null for a good record) and ``is_valid``.

    The two options are described at :func:`sensorloom.functions.checks.rules`.
    """
    arrival = "arrival_time" if "arrival_time" in decoded.columns else None
    chain = rules(strict_null_metric, arrival, future_tolerance)
    return decoded.withColumn("error_reason", first_reason(chain)).withColumn(
        "is_valid", F.col("error_reason").isNull()
    )


def valid_rows(classified: DataFrame, with_arrival: bool = False) -> DataFrame:
    """The typed business columns of the good records.

    ``with_arrival`` adds ``arrival_time``, so that a stored table can be audited
    for late rows without parsing the messages again.
    """
    more = ("arrival_time",) if with_arrival else ()
    return classified.where("is_valid").select(*VALID_COLUMNS, *more)


def dead_letters(classified: DataFrame) -> DataFrame:
    """The refused records: untouched text, reason, and when they were set aside.

    The stamp is the clock of the query, one value per micro-batch on a stream.
    """
    return classified.where("NOT is_valid").select(
        "raw_value",
        "device_id",
        "error_reason",
        F.current_timestamp().alias("quarantined_at"),
    )


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both routes; together they hold every classified record exactly once."""
    return valid_rows(classified), dead_letters(classified)
