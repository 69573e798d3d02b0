"""Append sinks and triggers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Row groups of laid-out tables are held for every open file, so they are small.
BLOCK_BYTES = 16 << 20


def append_to_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger_interval: str | None = "30 seconds",
    date_from: str | None = None,
    partition_by: Sequence[str] = (),
    files_per_batch: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query that appends to a Parquet table.

    ``trigger_interval=None`` works off what is there and ends.  A query that
    is started again on its checkpoint goes on where it stopped, with offsets,
    watermark and state.  ``date_from`` names a timestamp column; the table is
    then laid out by its date, so that reports on some days read only those.

    Every task of the last stage writes a file of its own, which on a large
    cluster means thousands of small ones per trigger.  ``files_per_batch``
    sends the finished rows, and only those, through a shuffle of that many
    partitions first.
    """
    layout = list(partition_by)
    if date_from is not None:
        stream = stream.withColumn("date", F.to_date(date_from))
        layout.append("date")
    if files_per_batch is not None:
        stream = stream.repartition(files_per_batch)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if layout:
        writer = writer.partitionBy(*layout).option("parquet.block.size", BLOCK_BYTES)
    if name is not None:
        writer = writer.queryName(name)
    if trigger_interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger_interval).start()
