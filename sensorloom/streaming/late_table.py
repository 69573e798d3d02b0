"""The rows that a windowed stream dropped as late, as a table.

A running aggregate drops a row whose window was closed by the watermark that the
row's batch met, and counts it in its metrics only.  Which watermark a batch met,
and which files it read, is in the query's checkpoint.  Here both become a log, one
row per batch, and the log is joined to the staged rows of these files: what the
aggregate has dropped is written, with the batch and the watermark.

Call :func:`append_late_rows` now and then while the query runs, or after it.  Each
call takes the batches committed since the last one, so it reads every staged file
once.  A batch replaces its own part of the table, and the log names it only after
that; a call that was cut off is simply repeated.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.contract import VALID_COLUMNS, VALID_SCHEMA
from sensorloom.sources.streams import path_exists, read_results
from sensorloom.streaming.staged import STAGED_SCHEMA, VALID

LATE_SCHEMA = f"{VALID_SCHEMA}, watermark TIMESTAMP, batch_id BIGINT"
LOG_SCHEMA = "batch_id BIGINT, watermark TIMESTAMP"


@dataclass(frozen=True)
class Batch:
    """A committed batch: the entries of the source it read, and the watermark late rows met."""

    batch_id: int
    after: int
    to: int
    watermark_ms: int


def committed_batches(spark: SparkSession, checkpoint: str) -> list[Batch]:
    """The batches that the checkpoint still knows, by number.

    Spark keeps ``spark.sql.streaming.minBatchesToRetain`` of them (100), which
    bounds what is read here.  A batch's late rows are told by the watermark of the
    batch before it.
    """

    def files(folder: str) -> dict[int, list[str]]:
        if not path_exists(spark, f"{checkpoint}/{folder}"):
            return {}
        whole = spark.read.text(f"{checkpoint}/{folder}", wholetext=True)
        rows = whole.select("value", F.col("_metadata.file_name").alias("name")).collect()
        return {int(row.name): row.value.split("\n") for row in rows if row.name.isdigit()}

    offsets, commits = files("offsets"), files("commits")
    found = []
    for number in sorted(set(offsets) & set(commits)):
        if number and number - 1 not in offsets:
            continue
        before = offsets.get(number - 1)
        if len(offsets[number]) != 3:
            raise ValueError("the query has more than one source; its late rows are not told here")
        found.append(
            Batch(
                number,
                json.loads(before[2])["logOffset"] if before else -1,
                json.loads(offsets[number][2])["logOffset"],
                json.loads(before[1])["batchWatermarkMs"] if before else 0,
            )
        )
    return found


def _files_of(spark: SparkSession, checkpoint: str, batches: list[Batch]) -> DataFrame:
    """(name, path, batch_id, watermark) of each file that these batches read."""
    entry = F.from_json("value", "path STRING, batchId BIGINT")
    entries = (
        spark.read.text(f"{checkpoint}/sources/0")
        .where(F.col("value").startswith("{"))
        .select(entry.alias("entry"))
        .select("entry.path", "entry.batchId")
        .distinct()
    )
    # As many rows as these batches have source entries, each of one or more files.
    rows = [(entry, b.batch_id, b.watermark_ms) for b in batches for entry in range(b.after + 1, b.to + 1)]
    known = spark.createDataFrame(rows, "batchId BIGINT, batch_id BIGINT, ms BIGINT")
    return entries.join(known, "batchId").select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "path",
        "batch_id",
        F.timestamp_millis("ms").alias("watermark"),
    )


def append_late_rows(
    spark: SparkSession, staged: str, checkpoint: str, path: str, window_duration: str
) -> int:
    """Write the late rows of all batches that ``path`` does not have yet; the last batch's number.

    ``checkpoint`` is that of an aggregate in tumbling windows of ``window_duration``
    over ``staged_stream(.., staged, VALID)``.  Raises an error if the checkpoint has
    forgotten a batch that was not looked at.
    """
    log = read_results(spark, f"{path}/log", LOG_SCHEMA)
    last = log.agg(F.max("batch_id")).first()[0]
    last = -1 if last is None else last
    batches = [b for b in committed_batches(spark, checkpoint) if b.batch_id > last]
    if not batches:
        return last
    if batches[0].batch_id != last + 1:
        raise ValueError(
            f"batches {last + 1} to {batches[0].batch_id - 1} are gone from the checkpoint; "
            "call this more often, or raise spark.sql.streaming.minBatchesToRetain"
        )
    files = _files_of(spark, checkpoint, batches)
    # A batch reads a bounded number of files, and the batches since the last call are few.
    paths = [row.path for row in files.select("path").collect()]
    if paths:
        rows = (
            spark.read.schema(STAGED_SCHEMA)
            .option("basePath", staged)
            .parquet(*paths)
            .where(F.col("route") == VALID)
            .select(*VALID_COLUMNS, F.col("_metadata.file_name").alias("name"))
        )
        end = F.window("event_time", window_duration)["end"]
        late = (
            rows.join(files.drop("path"), "name")
            .withColumn("closes", end)
            .where(F.col("closes") <= F.col("watermark"))
            .select(*VALID_COLUMNS, "watermark", "batch_id")
        )
        late.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch_id"
        ).parquet(f"{path}/rows")
    done = spark.createDataFrame([(b.batch_id, b.watermark_ms) for b in batches], "batch_id BIGINT, ms BIGINT")
    done.select("batch_id", F.timestamp_millis("ms").alias("watermark")).coalesce(1).write.mode(
        "append"
    ).parquet(f"{path}/log")
    return batches[-1].batch_id


def read_late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Late rows with ``watermark`` and ``batch_id``, of the batches that the log names."""
    last = read_results(spark, f"{path}/log", LOG_SCHEMA).agg(F.max("batch_id")).first()[0]
    rows = read_results(spark, f"{path}/rows", LATE_SCHEMA)
    return rows.where(F.col("batch_id") <= (-1 if last is None else last))


def read_watermark_log(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, watermark): what late rows of each batch met."""
    return read_results(spark, f"{path}/log", LOG_SCHEMA)
