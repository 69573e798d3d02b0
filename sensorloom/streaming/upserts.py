"""Sink for update mode: the latest state of every window, without waiting for it to close.

A table is a folder with two parts: ``changes``, one directory per micro-batch,
and ``base``, one directory per compaction with the latest version of every key
up to a batch.  Readers take the newest base and the changes after it, so their
work is bounded by the keys and by the batches since the last compaction.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.contract import AGGREGATE_COLUMNS, AGGREGATE_SCHEMA
from sensorloom.sources.streams import read_results

AGGREGATE_KEYS = ("window_start", "window_end", "device_id", "metric_type")
BATCH, UP_TO = "batch_id", "up_to"


def upsert_writer(
    path: str,
    files_per_batch: int | None = None,
    compact_every: int | None = None,
    schema: str = AGGREGATE_SCHEMA,
    keys: Sequence[str] = AGGREGATE_KEYS,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch`` that stores the changed rows of one batch.

    A batch replaces its own directory only, so running it again after a
    failure changes nothing, and neither does running it again after a
    compaction that holds it.  Batch ids belong to a checkpoint, and so does
    ``path``: a query on a new checkpoint needs a new one, as
    :func:`start_upserts` sees to.  Every ``compact_every`` batches the table is
    compacted up to the batch just written.
    """

    def write(changes: DataFrame, batch_id: int) -> None:
        if files_per_batch is not None:
            changes = changes.repartition(files_per_batch)
        changes.write.mode("overwrite").parquet(f"{path}/changes/{BATCH}={batch_id}")
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(changes.sparkSession, path, batch_id, schema, keys)

    return write


def start_upserts(
    aggregates: DataFrame,
    path: str,
    checkpoint: str,
    trigger_interval: str = "30 seconds",
    files_per_batch: int | None = None,
    compact_every: int | None = 100,
    name: str = "upserts",
) -> StreamingQuery:
    """Start the update-mode query ``name``; read its table with ``read_upserts(spark, path/name)``.

    A query on a new checkpoint takes a new name, and so a table of its own.
    """
    return (
        aggregates.writeStream.outputMode("update")
        .queryName(name)
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(processingTime=trigger_interval)
        .foreachBatch(upsert_writer(f"{path}/{name}", files_per_batch, compact_every))
        .start()
    )


def latest(
    versions: DataFrame,
    keys: Sequence[str] = AGGREGATE_KEYS,
    columns: Sequence[str] = AGGREGATE_COLUMNS,
) -> DataFrame:
    """The newest version of every key.

    Each column is taken by batch id on its own: a key occurs once per batch,
    so they all come from the same row, and numbers stay in a hash aggregate.
    """
    newest = [F.max_by(name, BATCH).alias(name) for name in columns if name not in keys]
    return versions.groupBy(*keys).agg(*newest).select(*columns)


def _versions(spark: SparkSession, path: str, schema: str, to_batch: int | None) -> DataFrame:
    """The newest base with its batch number, and the changes after it.

    Both parts are laid out by batch, so directories that don't count are not read.
    """

    def part(name: str, layout: str) -> DataFrame:
        return read_results(spark, f"{path}/{name}", f"{schema}, {layout} BIGINT")

    base, changes = part("base", UP_TO), part("changes", BATCH)
    if to_batch is not None:
        base, changes = base.where(F.col(UP_TO) < to_batch), changes.where(F.col(BATCH) <= to_batch)
    newest = base.agg(F.max(UP_TO)).first()[0]
    held = base.where(F.col(UP_TO) == (-1 if newest is None else newest)).withColumnRenamed(UP_TO, BATCH)
    return held.unionByName(changes.where(F.col(BATCH) > (-1 if newest is None else newest)))


def compact(
    spark: SparkSession,
    path: str,
    up_to: int,
    schema: str = AGGREGATE_SCHEMA,
    keys: Sequence[str] = AGGREGATE_KEYS,
) -> None:
    """Write the latest version of every key up to a batch as a new base.

    Older directories are not deleted, as a reader may be on them; they are no
    longer read, and may be removed once no reader can be.
    """
    columns = [field.name for field in spark.createDataFrame([], schema).schema]
    table = latest(_versions(spark, path, schema, up_to), keys, columns)
    table.write.mode("overwrite").parquet(f"{path}/base/{UP_TO}={up_to}")


def versions_before(
    spark: SparkSession,
    path: str,
    batch_id: int,
    schema: str = AGGREGATE_SCHEMA,
    keys: Sequence[str] = AGGREGATE_KEYS,
) -> DataFrame:
    """The table as it was before a batch; a compaction that holds the batch is not used."""
    columns = [field.name for field in spark.createDataFrame([], schema).schema]
    return latest(_versions(spark, path, schema, batch_id - 1), keys, columns)


def read_upserts(
    spark: SparkSession,
    path: str,
    schema: str = AGGREGATE_SCHEMA,
    keys: Sequence[str] = AGGREGATE_KEYS,
) -> DataFrame:
    """The table as it is now; without rows if nothing has been written yet."""
    columns = [field.name for field in spark.createDataFrame([], schema).schema]
    return latest(_versions(spark, path, schema, None), keys, columns)
