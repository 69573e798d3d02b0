"""A table of events that takes each one once, however late its copies come.

A stream's watermark forgets an event's key; this store does not.  It keeps a
bitmap index of the events by date, which tells nearly all new events from
possible copies without a look at the stored rows.  Possible copies are then
compared with the stored events in full, so the index decides nothing alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from sensorloom.contract import EVENT_KEY, VALID_SCHEMA
from sensorloom.operators.dedup import merge_copies
from sensorloom.sources.streams import read_results

RUN, DATE = "run", "event_date"
INDEX_SCHEMA = f"buckets BIGINT, bucket BIGINT, bitmap BINARY, {RUN} BIGINT, {DATE} DATE"
#: Bits of one bitmap, which Spark's functions fix, and events that one is made for:
#: an eighth of the bits, so one new event in eight at most is looked up in vain.
BITS = 1 << 15
EVENTS_PER_BITMAP = 1 << 12


def _address(keys: Sequence[str], buckets: Column) -> dict[str, Column]:
    digest = F.xxhash64(*keys)
    return {
        "bucket": F.pmod(F.shiftrightunsigned(digest, 15), buckets),
        "position": F.pmod(digest, F.lit(BITS).cast("long")),
    }


def _is_set(bitmap: Column, position: Column) -> Column:
    byte = F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), F.pmod(position, F.lit(8)).cast("int")) == 1


def date_index(events: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """(event_date, buckets, bucket, bitmap) of events with their ``event_date``.

    A date has as many bitmaps as its events need, a power of two, so that a busy
    one is spread over many rows and few different numbers occur.
    """
    needed = F.ceil(F.log2(F.count(F.lit(1)) / EVENTS_PER_BITMAP))
    layout = events.groupBy(DATE).agg(
        F.pow(F.lit(2), F.greatest(needed, F.lit(0))).cast("long").alias("buckets")
    )
    placed = events.select(DATE, *keys).join(layout, DATE).select(
        DATE, "buckets", *[c.alias(n) for n, c in _address(keys, F.col("buckets")).items()]
    )
    return placed.groupBy(DATE, "buckets", "bucket").agg(
        F.bitmap_construct_agg("position").alias("bitmap")
    )


def possible_copies(events: DataFrame, index: DataFrame, keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """The keys and dates of events that the index may hold; it holds none of the others."""
    bitmaps = index.groupBy(DATE, "buckets", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    layouts = index.select(DATE, "buckets").distinct()
    probes = events.select(DATE, *keys).join(layouts, DATE)
    probes = probes.withColumns(_address(keys, F.col("buckets")))
    hits = probes.join(bitmaps, [DATE, "buckets", "bucket"])
    return hits.where(_is_set(F.col("bitmap"), F.col("position"))).select(DATE, *keys).distinct()


def _stored_schema(schema: StructType) -> StructType:
    more = StructType().add(RUN, LongType()).add(DATE, "date")
    return StructType([*schema.fields, *more.fields])


def _write_by_date(rows: DataFrame, path: str) -> None:
    """All of the folder is written over, whatever the session says of its dates."""
    whole = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    whole.partitionBy(DATE).parquet(path)


def _last_run(spark: SparkSession, folder: str) -> int:
    last = read_results(spark, f"{folder}/runs", f"events BIGINT, {RUN} BIGINT").agg(F.max(RUN)).first()[0]
    return -1 if last is None else last


def append_new_events(events: DataFrame, folder: str, keys: Sequence[str] = EVENT_KEY) -> int:
    """Add the events that ``folder`` does not hold yet; the number of the run.

    Of copies within ``events`` the least is kept, as :func:`merge_copies` does; a
    stored event stays as it came first.  ``keys`` include ``event_time`` and are
    never null in valid readings; rows with a null among them are refused.  The
    columns ``run`` and ``event_date`` are the store's own.

    A run writes its events, their index and at last a note that makes both
    count.  One that was cut off is written over by the next.  Copies of one event
    meet as one row per task; busy dates are split by Spark when they are written.
    """
    spark = events.sparkSession
    if {RUN, DATE} & set(events.columns) or "event_time" not in keys:
        raise ValueError(f"{RUN} and {DATE} are the store's own columns, and event_time is a key")
    run = _last_run(spark, folder) + 1
    incoming, path = f"{folder}/incoming/{RUN}={run}", f"{folder}/events/{RUN}={run}"
    missing = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x)
    checked = events.withColumn(
        "event_time",
        F.when(missing, F.raise_error(F.lit("a key of an event is null"))).otherwise(F.col("event_time")),
    )
    # Written first: events and index must agree on which rows came.
    merge_copies(checked, keys=keys).withColumn(DATE, F.to_date("event_time")).write.mode(
        "overwrite"
    ).parquet(incoming)
    once = spark.read.parquet(incoming)
    index = read_results(spark, f"{folder}/index", INDEX_SCHEMA).where(F.col(RUN) < run)
    stored = read_results(spark, f"{folder}/events", _stored_schema(events.schema)).where(F.col(RUN) < run)
    copies = possible_copies(once, index, keys).join(stored.select(DATE, *keys), [DATE, *keys], "left_semi")
    fresh = once.join(copies, [DATE, *keys], "left_anti").select(*events.columns, DATE)
    _write_by_date(fresh.hint("rebalance", DATE), path)
    written = spark.read.schema(fresh.schema).parquet(path)
    parts = date_index(written, keys).select(DATE, "buckets", "bucket", "bitmap")
    _write_by_date(parts, f"{folder}/index/{RUN}={run}")
    written.agg(F.count(F.lit(1)).alias("events")).write.mode("overwrite").parquet(f"{folder}/runs/{RUN}={run}")
    return run


def stored_events(spark: SparkSession, folder: str, schema: str = VALID_SCHEMA) -> DataFrame:
    """The events of all runs that were finished, each once."""
    columns = spark.createDataFrame([], schema).schema
    rows = read_results(spark, f"{folder}/events", _stored_schema(columns))
    return rows.where(F.col(RUN) <= _last_run(spark, folder)).select(*columns.names)
