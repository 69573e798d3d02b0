"""Append tables that are compacted while they are written and read."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorloom.contract import VALID_COLUMNS, VALID_SCHEMA
from sensorloom.session import new_folder, stream_session
from sensorloom.sources.streams import read_results
from sensorloom.streaming.compacted import (
    committed_files,
    compact_table,
    live_runs,
    read_compacted,
    remove_unlisted,
)
from sensorloom.streaming.sinks import append_to_parquet

START = datetime(2031, 3, 5)
DATED = f"{VALID_SCHEMA}, date DATE"


def reading(n):
    return (f"dev-{n % 5:08x}", START + timedelta(hours=n), "humidity", float(n % 90), None, "1.0")


def rows_of(table):
    return Counter(tuple(row) for row in table.select(*VALID_COLUMNS).collect())


def append(spark, folder, numbers, per_batch=None):
    """One file per number and batch, appended by a stream over one checkpoint."""
    inbox = f"{folder}/inbox"
    rows = spark.createDataFrame([reading(n) for n in numbers], VALID_SCHEMA)
    rows.repartitionByRange(len(numbers), "event_time").write.mode("append").parquet(inbox)
    options = {"maxFilesPerTrigger": str(per_batch)} if per_batch else {}
    session = stream_session(spark)
    stream = session.readStream.schema(VALID_SCHEMA).options(**options).parquet(inbox)
    append_to_parquet(
        stream, f"{folder}/table", f"{folder}/checkpoint", None, date_from="event_time"
    ).awaitTermination()


def test_few_files_after_many_batches(spark):
    folder = new_folder(spark, "compacted")
    table, kept = f"{folder}/table", f"{folder}/compacted"
    assert read_compacted(spark, table, kept, DATED).count() == 0
    assert compact_table(spark, table, kept, DATED, ["date"]) == -1
    append(spark, folder, range(24), per_batch=1)
    written = committed_files(spark, table).count()
    assert written >= 20
    before = read_compacted(spark, table, kept, DATED)
    assert rows_of(before) == rows_of(read_results(spark, table))
    assert compact_table(spark, table, kept, DATED, ["date"]) == 0
    after = read_compacted(spark, table, kept, DATED)
    assert rows_of(before) == rows_of(after) == Counter(reading(n) for n in range(24))
    assert len(after.inputFiles()) <= 2 < written
    assert compact_table(spark, table, kept, DATED, ["date"]) == 0


def test_tiers_and_reads_in_between(spark):
    folder = new_folder(spark, "compacted")
    table, kept = f"{folder}/table", f"{folder}/compacted"
    seen, reads = Counter(), []
    for batch in range(9):
        numbers = range(batch * 3, batch * 3 + 3)
        append(spark, folder, numbers)
        seen += Counter(reading(n) for n in numbers)
        reads.append((Counter(seen), read_compacted(spark, table, kept, DATED)))
        assert compact_table(spark, table, kept, DATED, ["date"], fan=3) == batch
        assert rows_of(read_compacted(spark, table, kept, DATED)) == seen
        tiers = Counter(tier for _, tier in live_runs(spark, kept))
        assert max(tiers.values()) < 3
    # Nine runs of the first tier make one of the third.
    assert live_runs(spark, kept) == [(8, 2)]
    for held, table_then in reads:
        assert rows_of(table_then) == held
    assert rows_of(read_compacted(spark, table, kept, DATED, version=4)) == seen
    assert remove_unlisted(spark, kept, versions_kept=1) == list(range(8))
    assert rows_of(read_compacted(spark, table, kept, DATED)) == seen


def test_a_compaction_that_was_cut_off(spark):
    folder = new_folder(spark, "compacted")
    table, kept = f"{folder}/table", f"{folder}/compacted"
    append(spark, folder, range(4))
    # Run and replaced files were written, the manifest was not.
    junk = spark.createDataFrame([reading(99)], VALID_SCHEMA).withColumn("date", F.to_date("event_time"))
    junk.write.partitionBy("date").parquet(f"{kept}/runs/run=0")
    committed_files(spark, table).write.parquet(f"{kept}/replaced/version=0")
    whole = Counter(reading(n) for n in range(4))
    assert rows_of(read_compacted(spark, table, kept, DATED)) == whole
    assert compact_table(spark, table, kept, DATED, ["date"]) == 0
    assert rows_of(read_compacted(spark, table, kept, DATED)) == whole


def test_a_date_is_read_from_its_files_only(spark):
    folder = new_folder(spark, "compacted")
    table, kept = f"{folder}/table", f"{folder}/compacted"
    append(spark, folder, range(72))
    compact_table(spark, table, kept, DATED, ["date"])
    one = read_compacted(spark, table, kept, DATED).where("date = DATE'2031-03-06'")
    assert rows_of(one) == Counter(reading(n) for n in range(24, 48))
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    with pytest.raises(ValueError):
        compact_table(spark, table, kept, DATED, ["date"], fan=1)
