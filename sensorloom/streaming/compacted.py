"""Compaction of append tables, and a manifest that readers follow.

A streaming sink writes at least one file per batch and partition for as long as it
runs.  Compaction writes committed files together into *runs* and names the live runs
in a manifest, one version per compaction.  A reader takes the runs of the newest
version, and from the sink's own commit log the files that no version has replaced.
So it sees every committed row once, before, during and after a compaction.

Runs have tiers: ``fan`` runs of a tier become one run of the next, so a row is
written once per tier and there are fewer than ``fan`` runs of each.

Nothing that a reader may be on is changed or deleted.  :func:`remove_unlisted` takes
away the runs that the last versions do not name.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.sources.streams import path_exists, read_results

VERSION, RUN = "version", "run"
MANIFEST_SCHEMA = f"{RUN} BIGINT, tier INT, {VERSION} BIGINT"
REPLACED_SCHEMA = f"path STRING, {VERSION} BIGINT"


def committed_files(spark: SparkSession, table: str) -> DataFrame:
    """(path) of the files that the sink of ``table`` has committed.

    As Spark's own reader knows them: the driver takes them from the sink's log.
    """
    files = []
    if path_exists(spark, f"{table}/_spark_metadata"):
        files = spark.read.schema("file STRING").parquet(table).inputFiles()
    return spark.createDataFrame([(path,) for path in files], "path STRING")


def _last_version(spark: SparkSession, folder: str) -> int:
    last = read_results(spark, f"{folder}/manifest", MANIFEST_SCHEMA).agg(F.max(VERSION)).first()[0]
    return -1 if last is None else last


def live_runs(spark: SparkSession, folder: str, version: int | None = None) -> list[tuple[int, int]]:
    """(run, tier) of a version, or of the newest; fewer than ``fan`` per tier."""
    version = _last_version(spark, folder) if version is None else version
    runs = read_results(spark, f"{folder}/manifest", MANIFEST_SCHEMA).where(F.col(VERSION) == version)
    return sorted((row[RUN], row["tier"]) for row in runs.collect())


def _fresh_files(spark: SparkSession, table: str, folder: str, version: int) -> DataFrame:
    replaced = read_results(spark, f"{folder}/replaced", REPLACED_SCHEMA)
    old = replaced.where(F.col(VERSION) <= version).select("path")
    return committed_files(spark, table).join(old, "path", "left_anti")


def _read(spark: SparkSession, paths: Sequence[str], base: str, schema: str) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def _rows(
    spark: SparkSession, table: str, folder: str, schema: str, files: Sequence[str], runs: Sequence[int]
) -> DataFrame:
    """Rows of some of the sink's files and of some runs."""
    rows = _read(spark, [unquote(path) for path in files], table, schema)
    for run in runs:
        path = f"{folder}/runs/{RUN}={run}"
        rows = rows.unionByName(_read(spark, [path], path, schema))
    return rows


def compact_table(
    spark: SparkSession,
    table: str,
    folder: str,
    schema: str,
    partition_by: Sequence[str] = (),
    fan: int = 8,
) -> int:
    """Write what was committed since the last compaction as a run; the newest version.

    ``folder`` lies outside ``table``.  ``schema`` is that of the table with its
    partition columns, and ``partition_by`` names these.  Files get the size that
    adaptive execution aims at (``spark.sql.adaptive.advisoryPartitionSizeInBytes``);
    a busy partition gets several.  Where tiers are full their runs join the new one.

    The paths of files not yet compacted are known to the driver, as they are to
    Spark's own reader; compact often enough to keep them few.  One compaction at a
    time: a version counts once its manifest is written, which is a single file, and
    one that was cut off is written over.
    """
    if fan < 2:
        raise ValueError("fan is 2 or more")
    last = _last_version(spark, folder)
    files = sorted(row.path for row in _fresh_files(spark, table, folder, last).collect())
    if not files:
        return last
    version = last + 1
    kept, merged, tier = live_runs(spark, folder, last), [], 0
    while True:
        same = [run for run, of in kept if of == tier]
        if len(same) + 1 < fan:
            break
        merged += same
        kept = [(run, of) for run, of in kept if of != tier]
        tier += 1
    rows = _rows(spark, table, folder, schema, files, merged)
    writer = rows.hint("rebalance", *partition_by).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder}/runs/{RUN}={version}")
    spark.createDataFrame([(path,) for path in files], "path STRING").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{folder}/replaced/{VERSION}={version}")
    manifest = spark.createDataFrame([*kept, (version, tier)], f"{RUN} BIGINT, tier INT")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest/{VERSION}={version}")
    return version


def read_compacted(
    spark: SparkSession, table: str, folder: str, schema: str, version: int | None = None
) -> DataFrame:
    """All committed rows of ``table``, through the newest version or a given one.

    The files are fixed when this is called, so a compaction that ends while the
    result is being read changes nothing.  An older version gives the same rows from
    more files, as long as its runs are there.
    """
    version = _last_version(spark, folder) if version is None else version
    files = sorted(row.path for row in _fresh_files(spark, table, folder, version).collect())
    runs = [run for run, _ in live_runs(spark, folder, version)]
    return _rows(spark, table, folder, schema, files, runs)


def remove_unlisted(spark: SparkSession, folder: str, versions_kept: int = 2) -> list[int]:
    """Delete the runs that none of the last versions names; their numbers.

    Call it when no reader can be on an older version.  Files of the sink stay, as
    Spark's own reader goes by them.
    """
    last = _last_version(spark, folder)
    manifest = read_results(spark, f"{folder}/manifest", MANIFEST_SCHEMA)
    recent = manifest.where(F.col(VERSION) > last - max(versions_kept, 1)).select(RUN)
    older = manifest.where(F.col(VERSION) <= last).select(RUN).distinct()
    gone = []
    for row in older.join(recent, RUN, "left_anti").collect():
        path = f"{folder}/runs/{RUN}={row[RUN]}"
        if path_exists(spark, path):
            context = spark.sparkContext
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
            gone.append(row[RUN])
    return sorted(gone)
