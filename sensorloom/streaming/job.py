"""The live job: messages in, aggregates and dead letters out.

    spark-submit --packages <kafka connector> -m sensorloom.streaming.job

Two queries, because only the aggregates have to wait for the watermark; a
dead letter is written with the next batch.  The price is a second read of the
topic, unless ``stage_path`` names a table for what is read and parsed once.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sensorloom.plans.pipeline import telemetry_tables
from sensorloom.session import telemetry_session
from sensorloom.sources.streams import kafka_stream
from sensorloom.streaming.sinks import append_to_parquet
from sensorloom.streaming.staged import start_staged_queries

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class JobSettings:
    """Settings of the job; each is read from the variable of its name in capitals."""

    # The names and defaults are the interface of the job.
    kafka_bootstrap_servers: str = "localhost:29092"
    kafka_topic: str = "raw.iot-telemetry"
    output_path: str = "./data/output/aggregates"
    dead_letter_path: str = "./data/output/dead_letter"
    checkpoint_path: str = "./data/checkpoints"
    window_duration: str = "1 minute"
    watermark_delay: str = "2 minutes"
    trigger_interval: str = "30 seconds"
    starting_offsets: str = "latest"
    # Settings for a large cluster; 0 and empty mean no limit, no guard.
    max_offsets_per_trigger: int = 10_000_000
    files_per_batch: int = 0
    tables_by_date: bool = False
    merge_redelivered: bool = False
    future_tolerance: str = ""
    # A staged table, so that messages are read and parsed once; empty means two reads.
    # Its own interval and that of the dead letters; empty means the trigger interval.
    stage_path: str = ""
    stage_interval: str = ""
    dead_letter_interval: str = ""

    @classmethod
    def from_environment(cls, environment: Mapping[str, str] = os.environ) -> JobSettings:
        given = {f.name: environment[f.name.upper()] for f in fields(cls) if f.name.upper() in environment}
        return cls(**{name: _READ[type(getattr(cls, name))](text) for name, text in given.items()})

    def source_options(self) -> dict[str, str]:
        limit = self.max_offsets_per_trigger
        return {"maxOffsetsPerTrigger": str(limit)} if limit else {}

    def require_shared_paths(self) -> None:
        """Paths without a root belong to one machine, whatever the cluster."""
        for path in (self.output_path, self.dead_letter_path, self.checkpoint_path, self.stage_path):
            if path and not (path.startswith("/") or "://" in path):
                raise ValueError(f"{path!r} is relative; name a folder that all executors reach")


_READ = {str: str, int: int, bool: lambda text: text.strip().lower() in ("1", "true", "yes")}


def start_queries(
    raw: DataFrame,
    settings: JobSettings,
    until_done: bool = False,
    arrival_col: str | None = None,
    **pipeline_options,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the aggregates and the dead-letter query on a stream of messages.

    ``until_done`` works off what is there and ends, instead of running on the
    trigger interval.  ``arrival_col`` is needed if the settings have a future
    tolerance.  The layout of both tables is described at
    :func:`sensorloom.streaming.sinks.append_to_parquet`.
    """
    if settings.future_tolerance:
        pipeline_options["future_tolerance"] = settings.future_tolerance
    tables = telemetry_tables(
        raw,
        settings.window_duration,
        settings.watermark_delay,
        merge_redelivered=settings.merge_redelivered,
        arrival_col=arrival_col,
        **pipeline_options,
    )
    every = None if until_done else settings.trigger_interval
    sinks = {
        "aggregates": (settings.output_path, "window_start"),
        "dead_letter": (settings.dead_letter_path, "quarantined_at"),
    }
    started = []
    for name, (path, stamp) in sinks.items():
        query = append_to_parquet(
            tables[name],
            path,
            checkpoint=f"{settings.checkpoint_path}/{name}",
            trigger_interval=every,
            date_from=stamp if settings.tables_by_date else None,
            files_per_batch=settings.files_per_batch or None,
        )
        log.info("query %s (%s) appends to %s", name, query.id, path)
        started.append(query)
    return started[0], started[1]


def run(spark: SparkSession, settings: JobSettings) -> None:
    """Run on the topic until one of the queries ends; if it failed, so does the job."""
    if not spark.sparkContext.master.startswith("local["):
        settings.require_shared_paths()
    raw = kafka_stream(
        spark,
        settings.kafka_bootstrap_servers,
        settings.kafka_topic,
        settings.starting_offsets,
        **settings.source_options(),
    )
    start = start_staged_queries if settings.stage_path else start_queries
    start(raw, settings, arrival_col="timestamp")
    spark.streams.awaitAnyTermination()


def main() -> None:
    logging.basicConfig(level=logging.INFO)
    spark = telemetry_session()
    spark.sparkContext.setLogLevel("WARN")
    run(spark, JobSettings.from_environment())


if __name__ == "__main__":
    main()
