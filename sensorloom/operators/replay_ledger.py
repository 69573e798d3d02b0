"""Replay that takes every dead letter once, however often it is asked to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.contract import VALID_SCHEMA
from sensorloom.operators.refused import replay
from sensorloom.sources.streams import read_results

RUN = "run"
LEDGER_SCHEMA = f"digest STRING, copies BIGINT, {RUN} BIGINT"
STILL_SCHEMA = "raw_value STRING, error_reason STRING"


def letter_digest() -> Column:
    """Address of a letter's content: untouched text, device and reason, null apart from empty."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in ("device_id", "error_reason")]
    text = F.coalesce(F.concat(F.lit("="), F.col("raw_value")), F.lit("-"))
    return F.sha2(F.concat_ws("\n", *parts, text).cast("binary"), 256)


def replay_once(
    dead: DataFrame,
    folder: str,
    repair: Callable[[DataFrame], DataFrame] | None = None,
    **classify_options,
) -> int:
    """Replay the letters that ``folder`` has not replayed yet; the number of the run.

    ``dead`` holds all letters so far, old ones included.  The ledger has, for each
    run, how many letters of a content it took, so letters of equal content are told
    apart by their number: of five where three were taken, two are new.

    A run writes the letters that are good now and those still refused, then its
    ledger, which makes the run count.  One that was cut off is written over by the
    next.  Only digests are grouped; a content that makes up much of all letters meets
    as one row per task, and its new copies are one row until they are written.
    """
    spark = dead.sparkSession
    ledger = read_results(spark, f"{folder}/ledger", LEDGER_SCHEMA)
    last = ledger.agg(F.max(RUN)).first()[0]
    run = 0 if last is None else last + 1
    taken = ledger.groupBy("digest").agg(F.sum("copies").alias("taken"))
    # The content is the same in all letters of a digest, so any of them will do.
    names = ("raw_value", "device_id", "error_reason")
    letters = dead.select(letter_digest().alias("digest"), *names)
    found = letters.groupBy("digest", *names).agg(F.count(F.lit(1)).alias("found"))
    fresh = (
        found.join(taken, "digest", "left")
        .withColumn("copies", F.col("found") - F.coalesce("taken", F.lit(0)))
        .where("copies > 0")
        .select("digest", *names, "copies")
    )
    # Written first: the ledger must name exactly the letters that were replayed.
    fresh.write.mode("overwrite").parquet(f"{folder}/taken/{RUN}={run}")
    fresh = spark.read.schema(fresh.schema).parquet(f"{folder}/taken/{RUN}={run}")
    each = fresh.select(*names, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("col")
    valid, still = replay(each, repair, **classify_options)
    valid.write.mode("overwrite").parquet(f"{folder}/valid/{RUN}={run}")
    still.select("raw_value", "error_reason").write.mode("overwrite").parquet(f"{folder}/still/{RUN}={run}")
    fresh.select("digest", "copies").write.mode("overwrite").parquet(f"{folder}/ledger/{RUN}={run}")
    return run


def _counted(spark: SparkSession, folder: str, part: str, schema: str) -> DataFrame:
    last = read_results(spark, f"{folder}/ledger", LEDGER_SCHEMA).agg(F.max(RUN)).first()[0]
    rows = read_results(spark, f"{folder}/{part}", f"{schema}, {RUN} BIGINT")
    return rows.where(F.col(RUN) <= (-1 if last is None else last)).drop(RUN)


def replayed(spark: SparkSession, folder: str) -> DataFrame:
    """The readings that all runs so far have made good."""
    return _counted(spark, folder, "valid", VALID_SCHEMA)


def still_refused(spark: SparkSession, folder: str) -> DataFrame:
    """(raw_value, error_reason) of the letters that were replayed and refused again."""
    return _counted(spark, folder, "still", STILL_SCHEMA)
