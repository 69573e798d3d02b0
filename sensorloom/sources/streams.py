"""Sources of messages and readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.contract import READING_LINES_SCHEMA, VALID_SCHEMA


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    **more: str,
) -> dict[str, str]:
    """Reader options; ``more`` takes e.g. ``minPartitions`` or ``maxOffsetsPerTrigger``."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **more,
    }


def kafka_stream(spark: SparkSession, *args, **options) -> DataFrame:
    """Stream of one topic, with the arguments of :func:`kafka_options`.

    Needs the Kafka connector on the class path.  ``timestamp`` of the result
    can serve as the arrival column.
    """
    return spark.readStream.format("kafka").options(**kafka_options(*args, **options)).load()


def envelope_stream(
    spark: SparkSession, path: str, schema: str = "key STRING, value STRING", **options
) -> DataFrame:
    """Stream of (key, value) messages kept as Parquet, e.g. an archived topic."""
    return spark.readStream.format("parquet").schema(schema).options(**options).load(path)


def reading_lines_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Stream of readings kept as JSON lines; the time is text on disk."""
    lines = (
        spark.readStream.format("json").schema(READING_LINES_SCHEMA).options(**options).load(path)
    )
    return lines.withColumn("event_time", F.col("event_time").try_cast("timestamp"))


def literal_readings(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A small table of valid readings from Python rows, in contract column order."""
    texts = spark.createDataFrame(rows, VALID_SCHEMA.replace("TIMESTAMP", "STRING"))
    return texts.withColumn("event_time", F.col("event_time").try_cast("timestamp"))


def literal_messages(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A small table of (key, value) messages from Python rows."""
    return spark.createDataFrame(rows, "key STRING, value STRING")


def read_results(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A result table.

    With a schema, a table that no query has written to yet is empty; without
    one, Spark says that the path is not there.

    Spark's own reader goes by the commit log of the streaming sink, so files
    of a batch that was not committed are not seen.
    """
    if schema is None:
        return spark.read.parquet(path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system that holds the path."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder)
