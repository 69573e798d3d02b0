"""One read and one parse for all result tables.

A first query reads the messages, decodes and classifies them, and appends every
record to a staged table that is laid out by route.  The queries behind it read
that table as a stream, each only the files of its route, each on its own trigger
and checkpoint.  A slow or stopped query behind the stage keeps nobody waiting: the
table holds what it has not read yet, and it goes on from its own checkpoint.

The staged table stays.  It is also the archive of valid rows that the audits of
late rows read (:mod:`sensorloom.streaming.late_table`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.contract import DEAD_LETTER_COLUMNS, VALID_COLUMNS, VALID_SCHEMA
from sensorloom.operators.classify import classify
from sensorloom.operators.decode import decode
from sensorloom.operators.windows import windowed_aggregates
from sensorloom.streaming.sinks import append_to_parquet

VALID, DEAD_LETTER = "valid", "dead_letter"
STAGED_SCHEMA = (
    f"{VALID_SCHEMA}, arrival_time TIMESTAMP, raw_value STRING, error_reason STRING, "
    "quarantined_at TIMESTAMP, route STRING"
)


def staged_rows(classified: DataFrame) -> DataFrame:
    """Every classified record with the columns of its route; the others are null.

    ``quarantined_at`` is the clock of the stage, as a refused record is set aside here.
    """
    good = F.col("is_valid")
    arrival = F.col("arrival_time") if "arrival_time" in classified.columns else F.lit(None)
    made = {
        "device_id": F.col("device_id"),
        "arrival_time": F.when(good, arrival.cast("timestamp")),
        "raw_value": F.when(~good, F.col("raw_value")),
        "error_reason": F.col("error_reason"),
        "quarantined_at": F.when(~good, F.current_timestamp()),
        "route": F.when(good, F.lit(VALID)).otherwise(F.lit(DEAD_LETTER)),
    }
    business = {name: F.when(good, F.col(name)) for name in VALID_COLUMNS if name not in made}
    columns = made | business
    names = [field.split()[0] for field in STAGED_SCHEMA.split(", ")]
    return classified.select(*[columns[name].alias(name) for name in names])


def start_stage(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    trigger_interval: str | None = "30 seconds",
    arrival_col: str | None = None,
    files_per_batch: int | None = None,
    **classify_options,
) -> StreamingQuery:
    """Start the query that decodes and classifies a stream of messages into the staged table."""
    classified = classify(decode(raw, arrival_col=arrival_col), **classify_options)
    return append_to_parquet(
        staged_rows(classified),
        path,
        checkpoint,
        trigger_interval,
        partition_by=("route",),
        files_per_batch=files_per_batch,
    )


def staged_stream(spark: SparkSession, path: str, route: str, **options) -> DataFrame:
    """Stream of one route of a staged table; the stage must have been started once.

    Files count once their batch is committed, and only those of the route are read.
    """
    rows = spark.readStream.schema(STAGED_SCHEMA).options(**options).parquet(path)
    columns = (*VALID_COLUMNS, "arrival_time") if route == VALID else DEAD_LETTER_COLUMNS
    return rows.where(F.col("route") == route).select(*columns)


def start_staged_queries(
    raw: DataFrame, settings, until_done: bool = False, arrival_col: str | None = None, **classify_options
) -> tuple[StreamingQuery, StreamingQuery, StreamingQuery]:
    """Start stage, aggregates and dead letters with the job's settings (``stage_path`` is needed).

    ``until_done`` works off the stage first and then what it has left for the others.
    """
    if settings.future_tolerance:
        classify_options["future_tolerance"] = settings.future_tolerance
    files = settings.files_per_batch or None

    def every(own: str) -> str | None:
        return None if until_done else own or settings.trigger_interval

    stage = start_stage(
        raw, settings.stage_path, f"{settings.checkpoint_path}/stage", every(settings.stage_interval),
        arrival_col, files, **classify_options,
    )
    if until_done:
        stage.awaitTermination()
    spark = raw.sparkSession
    aggregates = windowed_aggregates(
        staged_stream(spark, settings.stage_path, VALID),
        settings.window_duration,
        settings.watermark_delay,
        count_copies=not settings.merge_redelivered,
    )
    dead = staged_stream(spark, settings.stage_path, DEAD_LETTER)
    by_date = settings.tables_by_date
    return (
        stage,
        append_to_parquet(
            aggregates, settings.output_path, f"{settings.checkpoint_path}/aggregates", every(""),
            "window_start" if by_date else None, files_per_batch=files,
        ),
        append_to_parquet(
            dead, settings.dead_letter_path, f"{settings.checkpoint_path}/dead_letter",
            every(settings.dead_letter_interval), "quarantined_at" if by_date else None,
            files_per_batch=files,
        ),
    )
