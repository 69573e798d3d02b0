"""What a running aggregate holds and has not emitted yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.operators.windows import finished_windows

#: The running statistics in the order in which the state keeps them.  Names repeat
#: there, so the struct is given these by a cast, which goes by position.
_KEPT = (
    "struct<total:bigint,total_is_empty:boolean,totalled:bigint,measured:bigint,rough_sum:double,"
    "rough_count:bigint,event_count:bigint,min_value:double,max_value:double>"
)


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The windows in the state of a ``windowed_aggregates`` query, as its sink would get them.

    Read from the checkpoint by Spark's state source, as of the last committed batch
    or of ``batch_id``; the query may be running or stopped and is not touched.  With
    the emitted table this gives every window once, up to the minute.  For aggregates
    that count copies (``count_copies=True``).
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint).select("key", F.col("value").cast(_KEPT).alias("kept"))
    named = state.select("key.window", "key.device_id", "key.metric_type", "kept.*")
    return finished_windows(named.withColumn("rough", F.col("rough_sum") / F.col("rough_count")))


def held_by_partition(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(partition_id, keys, oldest, newest): how the state lies, to see a hot or a stale part."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("keys"),
        F.min("key.window.start").alias("oldest"),
        F.max("key.window.end").alias("newest"),
    )
