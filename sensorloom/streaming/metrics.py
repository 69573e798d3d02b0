"""A table of what the queries have been doing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

_RETENTION = "spark.sql.streaming.numRecentProgressUpdates"
PROGRESS_SCHEMA = (
    "query_id STRING, run_id STRING, name STRING, batch_id BIGINT, batch_time STRING, "
    "input_rows BIGINT, rows_per_second DOUBLE, duration_ms BIGINT, watermark STRING, "
    "state_rows BIGINT, state_bytes BIGINT, dropped_rows BIGINT"
)


def progress_row(progress: StreamingQueryProgress) -> tuple:
    """One row of the metrics table: sums over the sources and state operators.

    An aggregate looks at the watermark after it has combined the rows of a
    task, so ``dropped_rows`` counts late groups there and not late readings;
    :func:`sensorloom.replay_watermark` counts readings.
    """
    state = progress.stateOperators
    return (
        str(progress.id),
        str(progress.runId),
        progress.name,
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        progress.processedRowsPerSecond,
        progress.batchDuration,
        progress.eventTime.get("watermark"),
        sum(op.numRowsTotal for op in state),
        sum(op.memoryUsedBytes for op in state),
        sum(op.numRowsDroppedByWatermark for op in state),
    )


def progress_table(spark: SparkSession, progresses: Iterable[StreamingQueryProgress]) -> DataFrame:
    return spark.createDataFrame([progress_row(p) for p in progresses], PROGRESS_SCHEMA)


def recent_progress(spark: SparkSession, *queries: StreamingQuery) -> DataFrame:
    """The batches that the given queries still remember, one row each.

    A query forgets its oldest batches once it has reported as many as
    ``spark.sql.streaming.numRecentProgressUpdates``; from then on this raises
    an error, as sums over the rest would be wrong.  :class:`ProgressLog` keeps all.
    """
    remembered = []
    for query in queries:
        progresses = query.recentProgress
        kept = spark.conf.get(_RETENTION)
        if len(progresses) >= int(kept):
            raise ValueError(
                f"query {query.id} keeps {kept} batches and may have forgotten earlier ones; "
                f"raise {_RETENTION} or use a ProgressLog"
            )
        remembered += progresses
    return progress_table(spark, remembered)


class ProgressLog(StreamingQueryListener):
    """Appends a row per micro-batch to a Parquet table; ``spark.streams.addListener(...)``.

    Rows are held back until there are ``every`` of them or a query ends, so
    that a long-running job does not write a small file per trigger.
    They are in the driver's memory until then: a driver that is lost takes up to
    ``every - 1`` rows with it.  With ``every=1`` each row is written at once.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50) -> None:
        self.spark = spark
        self.path = path
        self.every = every
        self.held: list[StreamingQueryProgress] = []

    def flush(self) -> None:
        if self.held:
            rows = progress_table(self.spark, self.held)
            self.held = []
            rows.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        """Nothing to keep."""

    def onQueryProgress(self, event) -> None:
        self.held.append(event.progress)
        if len(self.held) >= self.every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        """Nothing to keep."""

    def onQueryTerminated(self, event) -> None:
        self.flush()
