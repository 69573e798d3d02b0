"""Sessions and the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Large numbers of device keys live outside the heap, and a checkpoint uploads
# changes instead of whole snapshots.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Let sessions meet within each task before the shuffle, for busy devices.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}
#: Files of a laid-out table that a task of a stream writes at once, before it begins to sort.
OPEN_FILES = 32


def telemetry_session(app_name: str = "sensorloom", **conf: str) -> SparkSession:
    """Session in UTC, with adaptive execution and the state store for streams.

    The cluster decides on master, memory and parallelism.  Where it leaves the
    number of shuffle partitions open, there are three per core: adaptive
    execution joins small ones, but it does not split large ones.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STATE_STORE_CONF,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    context = spark.sparkContext
    partitions = "spark.sql.shuffle.partitions"
    if partitions not in conf and not context.getConf().contains(partitions):
        spark.conf.set(partitions, str(max(200, 3 * context.defaultParallelism)))
    return spark


def stream_session(
    spark: SparkSession, partitions: int | None = None, remembered_batches: int = 10_000
) -> SparkSession:
    """A sibling session for stateful queries; the settings of ``spark`` stay as they are.

    The number of shuffle partitions is frozen by a query's first checkpoint.
    It is ``partitions``, or what ``spark`` was set to, or else three per core
    registered now and eight at least; choose it for the cluster at its largest,
    as executors that join later cannot share fewer.

    A task that appends to a table with a layout keeps up to ``OPEN_FILES`` files open
    and writes rows as they come, instead of sorting all its rows by the layout first.
    """
    sibling = spark.newSession()
    name = "spark.sql.shuffle.partitions"
    if partitions is None and not _is_set(spark, name):
        partitions = max(8, 3 * spark.sparkContext.defaultParallelism)
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set(name, str(partitions or spark.conf.get(name)))
    sibling.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(remembered_batches))
    sibling.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    for key, value in STATE_STORE_CONF.items():
        sibling.conf.set(key, value)
    return sibling


def heartbeat_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for queries over several streams that go by the greatest of their watermarks."""
    session = stream_session(spark, partitions)
    session.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    return session


def _is_set(spark: SparkSession, name: str) -> bool:
    """Did anybody choose a value, on the cluster or in the session?"""
    default = spark.sparkContext._jvm.org.apache.spark.sql.internal.SQLConf().getConfString(name)
    return spark.sparkContext.getConf().contains(name) or spark.conf.get(name) != default


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a new folder that all executors can reach.

    It lies below ``spark.checkpoint.dir``, or else the checkpoint folder of the
    context, or else the warehouse, which a cluster shares as well.
    """
    shared = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{shared.rstrip('/')}/sensorloom/{purpose}-{uuid.uuid4().hex}"
