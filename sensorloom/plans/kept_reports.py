"""Reports that are kept up to date batch by batch, without another look at all rows.

A report's state after a batch is made from its state after the batch before and the
batch's own changes, so it costs the changes, not the table.  States are small: a row
per metric or reason, and the latest ``n`` rows.  Each lies in a folder of its batch;
a batch that is written again, after a failure, replaces its own states and starts
from the same earlier ones, so it counts once.

* Windows come as an update-mode query hands them over: new versions of some windows.
  A version takes the place of the one before, which is looked up in the table of
  :mod:`sensorloom.streaming.upserts` within the batch's range of window starts.
* Dead letters are only ever added.

Sums are kept as decimals, so that what is added can be taken away again exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.contract import AGGREGATE_COLUMNS, AGGREGATE_SCHEMA
from sensorloom.plans.reports import recent_dead_letters, recent_windows
from sensorloom.sources.streams import path_exists, read_results
from sensorloom.streaming.upserts import AGGREGATE_KEYS, upsert_writer, versions_before

BATCH = "batch_id"
TOTALS_SCHEMA = (
    "metric_type STRING, windows BIGINT, total_events BIGINT, means DECIMAL(38,3), weighted DECIMAL(38,3)"
)
REASONS_SCHEMA = "error_reason STRING, n BIGINT"
RECENT_LETTERS_SCHEMA = "quarantined_at TIMESTAMP, device_id STRING, error_reason STRING, raw_value STRING"
#: States that stay behind the newest one, for readers that are on them and for a retried batch.
STATES_KEPT = 20


def _state(spark: SparkSession, folder: str, report: str, schema: str, batch_id: int) -> DataFrame:
    """A report's state after a batch; before the first one it is empty."""
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    path = f"{folder}/{report}/{BATCH}={batch_id}"
    if not path_exists(spark, path):
        raise ValueError(f"{report} has no state after batch {batch_id}; batches come one after the other")
    return spark.read.schema(schema).parquet(path)


def _newest(spark: SparkSession, folder: str, report: str, schema: str) -> DataFrame:
    states = read_results(spark, f"{folder}/{report}", f"{schema}, {BATCH} BIGINT")
    last = states.select(BATCH).agg(F.max(BATCH)).first()[0]
    return states.where(F.col(BATCH) == (-1 if last is None else last)).drop(BATCH)


def _keep(state: DataFrame, folder: str, report: str, batch_id: int) -> None:
    """One file, which is there as a whole or not at all; states long past go."""
    state.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{report}/{BATCH}={batch_id}")
    context = state.sparkSession.sparkContext
    old = f"{folder}/{report}/{BATCH}={batch_id - STATES_KEPT}"
    if batch_id >= STATES_KEPT and path_exists(state.sparkSession, old):
        target = context._jvm.org.apache.hadoop.fs.Path(old)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def _totals(windows: DataFrame, sign: int) -> DataFrame:
    """What windows add to the totals of their metric, or take away."""
    mean = F.col("avg_value").cast("decimal(18,3)")

    def total(column: Column) -> Column:
        return (F.sum(column) * F.lit(sign)).cast("decimal(38,3)")

    return windows.groupBy("metric_type").agg(
        total(F.lit(1)).cast("bigint").alias("windows"),
        total(F.col("event_count")).cast("bigint").alias("total_events"),
        total(mean).alias("means"),
        total(mean * F.col("event_count").cast("decimal(19,0)")).alias("weighted"),
    )


def keep_window_reports(changes: DataFrame, batch_id: int, folder: str, n: int = 20, **upsert_options) -> None:
    """Take one batch of changed windows into the rollups and the ``n`` latest windows.

    ``changes`` has a row per window at most, as a batch of an update-mode aggregate
    does, and is stored in ``folder``'s own upsert table (``upsert_options`` are those of
    :func:`upsert_writer`).  Means must be numbers below 10^15; others raise an error,
    since they could not be taken away again.  A window keeps its place in the order
    of the latest ones when its values change, so the ``n`` latest follow from the ``n``
    before and the changes.
    """
    spark = changes.sparkSession
    table = f"{folder}/windows"
    upsert_writer(table, **upsert_options)(changes, batch_id)
    batch = spark.read.schema(AGGREGATE_SCHEMA).parquet(f"{table}/changes/{BATCH}={batch_id}")
    first, last = batch.agg(F.min("window_start"), F.max("window_start")).first()
    totals = _state(spark, folder, "totals", TOTALS_SCHEMA, batch_id - 1)
    recent = _state(spark, folder, "recent_windows", AGGREGATE_SCHEMA, batch_id - 1)
    if first is not None:
        keys = list(AGGREGATE_KEYS)
        # The range is on a grouping key, so it reaches the files.
        known = versions_before(spark, table, batch_id).where(F.col("window_start").between(first, last))
        replaced = known.join(batch.select(keys), keys, "left_semi")
        parts = totals.unionByName(_totals(batch, 1)).unionByName(_totals(replaced, -1))
        names = ("windows", "total_events", "means", "weighted")
        types = dict(parts.dtypes)
        totals = parts.groupBy("metric_type").agg(*[F.sum(c).cast(types[c]).alias(c) for c in names])
        unchanged = recent.join(batch.select(keys), keys, "left_anti").select(*AGGREGATE_COLUMNS)
        recent = recent_windows(unchanged.unionByName(recent_windows(batch.select(*AGGREGATE_COLUMNS), n)), n)
    _keep(totals, folder, "totals", batch_id)
    _keep(recent, folder, "recent_windows", batch_id)


def keep_letter_reports(letters: DataFrame, batch_id: int, folder: str, n: int = 20) -> None:
    """Take one batch of dead letters into the breakdown by reason and the ``n`` latest ones.

    The letters are read twice, once for each report; cache a batch that is costly to make.
    """
    spark = letters.sparkSession
    reasons = _state(spark, folder, "reasons", REASONS_SCHEMA, batch_id - 1)
    recent = _state(spark, folder, "recent_letters", RECENT_LETTERS_SCHEMA, batch_id - 1)
    added = letters.groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))
    reasons = reasons.unionByName(added).groupBy("error_reason").agg(F.sum("n").alias("n"))
    both = recent.unionByName(recent_dead_letters(letters, n))
    _keep(reasons, folder, "reasons", batch_id)
    _keep(recent_dead_letters(both, n), folder, "recent_letters", batch_id)


def window_report_writer(folder: str, n: int = 20, **upsert_options) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` of an update-mode aggregate."""
    return lambda changes, batch_id: keep_window_reports(changes, batch_id, folder, n, **upsert_options)


def kept_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """As ``metric_rollup`` and ``weighted_rollup`` of the windows so far, in one table."""
    totals = _newest(spark, folder, "totals", TOTALS_SCHEMA)
    return totals.select(
        "metric_type",
        "windows",
        "total_events",
        (F.col("means").cast("double") / F.col("windows")).alias("overall_avg"),
        (F.col("weighted").cast("double") / F.col("total_events")).alias("weighted_avg"),
    ).orderBy("metric_type")


def kept_recent_windows(spark: SparkSession, folder: str, n: int = 20) -> DataFrame:
    """As ``recent_windows`` of the windows so far; ``n`` at most as many as are kept."""
    return recent_windows(_newest(spark, folder, "recent_windows", AGGREGATE_SCHEMA), n)


def kept_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    """As ``reason_breakdown`` of the letters so far."""
    reasons = _newest(spark, folder, "reasons", REASONS_SCHEMA)
    return reasons.orderBy(F.desc("n"), "error_reason")


def kept_recent_letters(spark: SparkSession, folder: str, n: int = 20) -> DataFrame:
    """As ``recent_dead_letters`` of the letters so far."""
    return recent_dead_letters(_newest(spark, folder, "recent_letters", RECENT_LETTERS_SCHEMA), n)
