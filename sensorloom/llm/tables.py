"""Tables that several stages of an operator read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import new_folder


def saved(frame: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder, or to ``path``, and read it again.

    This cuts the lineage, and the table outlives any executor.
    """
    path = path or new_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a saved table that nothing reads any more, lazy results included."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


#: Copies of a row that one task makes in a row of its own.
COPIES_AT_ONCE = 1 << 16


def copies(frame: DataFrame, count: str) -> DataFrame:
    """Each row as often as ``count`` says, with ``copy`` counting from 0 instead of it.

    A row of very many copies is made into pieces that several tasks share; the
    frame is written and read again, since both kinds of row are taken from it.
    """
    frame = saved(frame, "counted_rows")
    last = F.col(count) - 1
    few = frame.filter(F.col(count) <= COPIES_AT_ONCE)
    pieces = frame.filter(F.col(count) > COPIES_AT_ONCE).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES_AT_ONCE).cast("long"))).alias("_from")
    )
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = pieces.repartition(tasks, *[F.col(f"`{name}`") for name in frame.columns], "_from")
    to = F.least(F.col("_from") + (COPIES_AT_ONCE - 1), last)
    return (
        few.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .unionByName(spread.withColumn("copy", F.explode(F.sequence("_from", to))).drop("_from"))
        .drop(count)
    )


def boxed(frame: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all columns as ``row``, whose names then cannot clash."""
    every = F.struct(*[F.col(f"`{name}`") for name in frame.columns]).alias("row")
    return frame.select(every, *[F.col(f"`{name}`") for name in names])


def unboxed(frame: DataFrame, names: list[str], **replaced: Column) -> DataFrame:
    """The columns of ``row`` again, some of them replaced."""
    return frame.select(
        *[replaced.get(name, F.col(f"row.`{name}`")).alias(name) for name in names],
        *[column.alias(name) for name, column in replaced.items() if name not in names],
    )
