"""How the registered queries that go batch by batch share their work out."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

import __spark_entry__ as entry
from sensorloom.session import OPEN_FILES, stream_session
from sensorloom.streaming.sinks import append_to_parquet


def events(spark, tmp_path):
    rows = [
        (n, datetime(2024, 1, 1) + timedelta(minutes=97 * n), n % 7, kind, 20.0 + n % 9, "{}")
        for n in range(400)
        for kind in [("click", "view", "purchase", "signup", "error")[n % 5]]
    ]
    schema = entry.EVENTS_SCHEMA
    spark.createDataFrame(rows, schema).repartition(4, "event_id").write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_parts_are_written_by_every_task(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    sent = spark.range(4000, numPartitions=4).select(
        F.col("id").cast("string").alias("key"), F.lit("{}").alias("value"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("id").cast("int") % 30)).alias("arrival_time"),
    )
    assert list(entry._parts(sent, str(tmp_path))) == [0, 1, 2, 3, 4, 5]
    assert all(len(list((tmp_path / "sent" / f"part={n}").glob("*.parquet"))) == 4 for n in range(6))
    inbox = spark.read.parquet(str(tmp_path / "inbox"))
    assert inbox.count() == inbox.select("key").distinct().count() == 4000


def test_upserts_parse_once(spark, tmp_path, monkeypatch):
    plans, made = [], entry.upsert_writer

    def writer(*args, **options):
        write = made(*args, **options)

        def looked_at(changes, batch_id):
            plans.append(plan(changes))
            write(changes, batch_id)

        return looked_at

    monkeypatch.setattr(entry, "upsert_writer", writer)
    windows = entry.upserts(spark, events(spark, tmp_path))
    assert windows.count() > 50 and len(plans) == 13
    assert not any("from_json" in text for text in plans)


def test_kept_windows_group_all_rows_once_a_batch(spark, tmp_path, monkeypatch):
    plans, keep = [], entry.kept_reports.keep_window_reports

    def looked_at(changes, batch_id, *args, **options):
        plans.append(plan(changes))
        keep(changes, batch_id, *args, **options)

    monkeypatch.setattr(entry.kept_reports, "keep_window_reports", looked_at)
    entry._kept_windows(spark, events(spark, tmp_path))
    # Besides the windows themselves, distinct keys of the batch's own hours.
    assert len(plans) == 12 and not any("count_if" in text or "count(if" in text for text in plans)


def test_a_layout_is_written_without_a_sort(spark, tmp_path):
    """More dates than files that may be open: all rows are there, each in its date."""
    session = stream_session(spark)
    assert int(session.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == OPEN_FILES
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    rows = spark.range(5000).select("id", (start + F.make_dt_interval(F.col("id").cast("int") % 50)).alias("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = session.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    append_to_parquet(
        stream, str(tmp_path / "out"), str(tmp_path / "c"), None, date_from="ts", files_per_batch=2
    ).awaitTermination()
    table = spark.read.parquet(str(tmp_path / "out"))
    assert table.count() == table.select("id").distinct().count() == 5000
    assert table.where(F.to_date("ts") != F.col("date")).count() == 0
    assert len(list((tmp_path / "out").glob("date=*"))) == 50
