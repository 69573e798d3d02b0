"""Real streaming queries over files: watermark, restart, sinks, dedup, sessions."""

import json
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sensorloom import (
    classify,
    decode,
    drop_copies_within_watermark,
    quiet_signals,
    replay_watermark,
    split,
    windowed_aggregates,
)
from sensorloom.session import new_folder, stream_session
from sensorloom.sources.streams import (
    envelope_stream,
    kafka_options,
    read_results,
    reading_lines_stream,
)
from sensorloom.streaming.job import JobSettings, start_queries
from sensorloom.streaming.metrics import ProgressLog, progress_table, recent_progress
from sensorloom.streaming.sinks import append_to_parquet
from sensorloom.streaming.upserts import compact, latest, read_upserts, upsert_writer

DEVICE = "dev-9999ffff"


@pytest.fixture(scope="module")
def streams(spark):
    return stream_session(spark, partitions=2)


class Feed:
    """A folder of JSON lines and the query over it, run once per step."""

    def __init__(self, spark, folder, build):
        self.spark, self.folder, self.build = spark, folder, build
        self.steps = 0
        (folder / "in").mkdir()

    def step(self, *readings):
        lines = [
            json.dumps(
                {
                    "device_id": device,
                    "event_time": f"2031-03-05T{at}",
                    "metric_type": "temperature",
                    "value": float(value),
                    "site_id": "site-01",
                    "firmware_version": "1.4.2",
                }
            )
            for device, at, value in readings
        ]
        self.steps += 1
        (self.folder / "in" / f"{self.steps:03}.json").write_text("\n".join(lines) + "\n")
        stream = reading_lines_stream(self.spark, str(self.folder / "in"))
        self.query = append_to_parquet(
            self.build(stream), str(self.folder / "out"), str(self.folder / "check"), None
        )
        self.query.awaitTermination()
        return self.output()

    def output(self):
        rows = read_results(self.spark, str(self.folder / "out")).collect()
        return sorted(rows, key=str)

    def last(self, column):
        table = recent_progress(self.spark, self.query).orderBy("batch_id").collect()
        return [row[column] for row in table]


def test_watermark_over_restarts(streams, tmp_path):
    feed = Feed(
        streams, tmp_path, lambda s: windowed_aggregates(s, "10 minutes", watermark_delay="3 minutes")
    )

    def seen(rows):
        return [(r.window_start.strftime("%H:%M"), r.avg_value, r.event_count) for r in rows]

    morning = ("06:20", 4.0, 3)
    assert seen(feed.step((DEVICE, "06:21:30", 3), (DEVICE, "06:29:59", 8))) == []
    # late by two minutes, within the delay: counted
    assert seen(feed.step((DEVICE, "06:27:45", 1))) == []
    assert seen(feed.step((DEVICE, "06:41:00", 70))) == [morning]
    assert feed.last("watermark")[-1] == "2031-03-05T06:38:00.000Z"
    # its window is closed: dropped, nothing changes
    assert seen(feed.step((DEVICE, "06:22:00", 60), (DEVICE, "06:22:05", 61))) == [morning]
    assert sum(feed.last("dropped_rows")) == 1
    # older than the watermark, but its window is open: kept in state
    assert seen(feed.step((DEVICE, "06:31:00", 12))) == [morning]
    assert sum(feed.last("dropped_rows")) == 0
    second = ("06:30", 12.0, 1)
    assert seen(feed.step((DEVICE, "06:43:00", 5))) == [morning, second]
    # its window ends exactly at the watermark
    assert seen(feed.step((DEVICE, "06:39:59", 7))) == [morning, second]
    assert sum(feed.last("dropped_rows")) == 1


LATE_STEPS = ["07:00:20", "07:25:00", "07:03:00", "08:31:00"]


@pytest.mark.parametrize("count_copies", [True, False])
def test_open_windows_take_late_rows(streams, tmp_path, count_copies):
    """A row behind the watermark counts as long as its window is open, copies merged or not."""
    feed = Feed(
        streams, tmp_path,
        lambda s: windowed_aggregates(s, "1 hour", "2 minutes", count_copies=count_copies),
    )
    for n, moment in enumerate(LATE_STEPS):
        rows = feed.step((DEVICE, moment, n), (DEVICE, moment, n))
    (row,) = rows
    assert (row.window_start.hour, row.event_count) == (7, 6 if count_copies else 3)


def test_sliding_windows_of_distinct_readings(spark, streams, tmp_path):
    def build(s):
        return windowed_aggregates(s, "20 minutes", "1 minute", "10 minutes", count_copies=False)

    feed = Feed(streams, tmp_path, build)
    feed.step((DEVICE, "07:05:00", 1), (DEVICE, "07:05:00", 1), (DEVICE, "07:15:00", 3))
    feed.step((DEVICE, "07:05:00", 1), (DEVICE, "07:17:00", 5))
    rows = feed.step((DEVICE, "07:32:00", 9))
    got = [(r.window_start.strftime("%H:%M"), r.event_count, r.avg_value) for r in rows]
    assert got == [("06:50", 1, 1.0), ("07:00", 3, 3.0), ("07:10", 2, 4.0)]


def test_far_future_reading_closes_nothing(streams, spark, tmp_path):
    """With the guard on, one bad clock neither counts nor moves the watermark."""
    settings = JobSettings(
        output_path=str(tmp_path / "a"), dead_letter_path=str(tmp_path / "d"),
        checkpoint_path=str(tmp_path / "c"), future_tolerance="5 minutes", merge_redelivered=True,
        files_per_batch=1,
    )
    topic = str(tmp_path / "topic")
    schema = "key STRING, value STRING, timestamp TIMESTAMP"

    def publish(*sent):
        rows = [(DEVICE, message(at), datetime(2031, 3, 5, *came)) for at, came in sent]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(topic)
        raw = envelope_stream(streams, topic, schema)
        for query in start_queries(raw, settings, until_done=True, arrival_col="timestamp"):
            query.awaitTermination()
        tables = (settings.output_path, settings.dead_letter_path)
        return [read_results(spark, path).collect() for path in tables]

    publish(("10:00:10", (10, 0, 11)), ("23:00:00", (10, 0, 12)))
    aggregates, dead = publish(("10:00:30", (10, 0, 31)))
    assert aggregates == [] and [r.error_reason for r in dead] == ["future_timestamp"]
    aggregates, _ = publish(("10:05:00", (10, 5, 1)))
    assert [r.event_count for r in aggregates] == [2]


def test_settings_from_the_environment(tmp_path):
    given = {"FILES_PER_BATCH": "3", "TABLES_BY_DATE": "true", "FUTURE_TOLERANCE": "1 hour",
             "WINDOW_DURATION": "5 minutes"}
    settings = JobSettings.from_environment(given)
    assert (settings.files_per_batch, settings.tables_by_date) == (3, True)
    assert (settings.future_tolerance, settings.window_duration) == ("1 hour", "5 minutes")
    assert settings.source_options() == {"maxOffsetsPerTrigger": "10000000"}
    assert JobSettings(max_offsets_per_trigger=0).source_options() == {}
    with pytest.raises(ValueError):
        JobSettings().require_shared_paths()
    JobSettings("b", "t", "/a", "s3a://d", "hdfs:///c").require_shared_paths()


def test_stream_sessions_keep_the_users_partitions(spark):
    assert stream_session(spark).conf.get("spark.sql.shuffle.partitions") == "2"
    assert stream_session(spark, 7).conf.get("spark.sql.shuffle.partitions") == "7"


def test_forgotten_batches_are_an_error(streams, tmp_path):
    feed = Feed(streams, tmp_path, lambda s: windowed_aggregates(s, "1 minute", "1 minute"))
    feed.step((DEVICE, "10:00:10", 10), (DEVICE, "10:05:40", 20))
    kept = streams.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    streams.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with pytest.raises(ValueError, match="forgotten"):
            recent_progress(streams, feed.query)
    finally:
        streams.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_many_batches_are_remembered(spark, streams, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    for n in range(104):
        text = pa.table({"key": [DEVICE], "value": [message(f"10:{n // 60:02}:{n % 60:02}")]})
        pq.write_table(text, folder / f"{n:03}.parquet")
    raw = envelope_stream(streams, str(folder), maxFilesPerTrigger=1)
    query = append_to_parquet(decode(raw), str(tmp_path / "o"), str(tmp_path / "c"), None)
    query.awaitTermination()
    progress = recent_progress(streams, query)
    assert progress.count() > 100
    assert progress.agg(F.sum("input_rows")).first()[0] == 104


def test_replay_agrees_with_the_stream(spark, streams, tmp_path):
    """The late-row audit over a table predicts what the query drops."""
    feed = Feed(streams, tmp_path, lambda s: windowed_aggregates(s, watermark_delay="1 minute"))
    steps = [
        ["10:00:10", "10:01:00"],
        ["10:05:00", "10:00:40"],
        ["10:00:15", "10:04:10", "10:03:59"],
        ["10:07:00", "10:04:30"],
        ["10:05:59", "10:06:00", "10:02:00"],
    ]
    dropped, rows = [], []
    for n, times in enumerate(steps):
        feed.step(*[(DEVICE, at, 1) for at in times])
        dropped.append(sum(feed.last("dropped_rows")))
        rows += [(n, f"2031-03-05T{at}") for at in times]
    table = spark.createDataFrame(rows, "n INT, at STRING").select(
        "n", F.to_timestamp("at").alias("event_time"),
        F.timestamp_seconds(F.col("n") * 30).alias("arrival_time"),
    )
    replayed = replay_watermark(table, "30 seconds", "1 minute", "1 minute")
    counted = replayed.groupBy("n").agg(F.count_if("is_dropped").alias("k")).orderBy("n")
    # the query aggregates each batch before it looks at the watermark
    windows = (
        replayed.where("is_dropped").groupBy("n").agg(
            F.count_distinct(F.window("event_time", "1 minute")["start"]).alias("k"))
    )
    by_window = {r.n: r.k for r in windows.collect()}
    assert dropped == [by_window.get(n, 0) for n in range(len(steps))]
    assert sum(r.k for r in counted.collect()) >= sum(dropped) > 0


def message(at, device=DEVICE, value=50.0):
    stamp = f"2031-03-05T{at}Z"
    return json.dumps(
        {"device_id": device, "timestamp": stamp, "metric_type": "battery", "value": value}
    )


def test_two_query_job(spark, streams, tmp_path):
    settings = JobSettings(
        output_path=str(tmp_path / "aggregates"),
        dead_letter_path=str(tmp_path / "dead"),
        checkpoint_path=str(tmp_path / "check"),
    )
    source = str(tmp_path / "topic")

    def publish(*texts):
        rows = [(DEVICE, text) for text in texts]
        spark.createDataFrame(rows, "key STRING, value STRING").coalesce(1).write.mode(
            "append"
        ).parquet(source)
        for query in start_queries(envelope_stream(streams, source), settings, until_done=True):
            query.awaitTermination()
        dead = read_results(spark, settings.dead_letter_path)
        aggregates = read_results(spark, settings.output_path)
        return aggregates.collect(), dead.collect()

    aggregates, dead = publish(message("10:00:10"), message("10:00:20", value=60), "{broken")
    # a dead letter does not wait for the watermark
    assert aggregates == []
    assert [(r.error_reason, r.raw_value) for r in dead] == [("invalid_json", "{broken")]
    aggregates, dead = publish(message("10:09:00"), message("10:09:00", value=999))
    assert [(r.avg_value, r.event_count) for r in aggregates] == [(55.0, 2)]
    assert sorted(r.error_reason for r in dead) == ["invalid_json", "value_out_of_range"]


def test_layout_by_date(spark, streams, tmp_path):
    feed_folder = tmp_path / "topic"
    days = [message("10:00:10"), message("10:00:10").replace("03-05", "03-06"),
            message("10:00:10").replace("03-05", "03-07")]
    spark.createDataFrame([("k", t) for t in days], "key STRING, value STRING").write.parquet(
        str(feed_folder)
    )
    settings = JobSettings(
        str(tmp_path), "t", *[str(tmp_path / n) for n in ("a", "d", "c")],
        tables_by_date=True, files_per_batch=1,
    )
    raw = envelope_stream(streams, str(feed_folder))
    for query in start_queries(raw, settings, until_done=True):
        query.awaitTermination()
    assert len(list((tmp_path / "a").glob("date=*/*.parquet"))) == 2
    table = read_results(spark, str(tmp_path / "a"))
    assert table.count() == 2
    one_day = table.where("date = DATE'2031-03-06'")
    assert one_day.count() == 1
    assert "PartitionFilters: [isnotnull(date" in one_day._jdf.queryExecution().toString()


@pytest.mark.parametrize("spread", [1, 4])
def test_first_copy_passes_at_once(streams, tmp_path, spread):
    feed = Feed(
        streams, tmp_path, lambda s: drop_copies_within_watermark(s, "1 minute", spread=spread)
    )
    assert len(feed.step((DEVICE, "10:00:10", 10), (DEVICE, "10:00:10", 10))) == 1
    assert len(feed.step((DEVICE, "10:00:10", 10), (DEVICE, "10:00:20", 10))) == 2
    assert len(feed.step((DEVICE, "10:00:20", 10), ("dev-other", "10:00:20", 10))) == 3


def test_quiet_signals(streams, tmp_path):
    feed = Feed(streams, tmp_path, lambda s: quiet_signals(s, "5 minutes", "1 minute"))
    assert feed.step(("a", "10:00:10", 1), ("b", "10:00:20", 1), ("a", "10:04:00", 1)) == []
    rows = feed.step(("b", "10:07:00", 1), ("b", "10:11:00", 1))
    got = [(r.device_id, r.active_from.minute, r.quiet_from.minute, r.event_count) for r in rows]
    assert got == [("a", 0, 4, 2), ("b", 0, 0, 1)]


def test_stream_equals_table(spark, streams, tmp_path):
    """Closed windows of a stream are those of the same rows in a table."""
    texts = [message(f"10:{m:02}:{s:02}", f"dev-{d}", m + s) for m in range(30)
             for s in (1, 20, 59) for d in range(3)] + ["{", ""]
    folder = str(tmp_path / "topic")
    table = spark.createDataFrame([("k", t) for t in texts], "key STRING, value STRING")
    table.repartition(3).write.parquet(folder)

    def aggregates(raw):
        return windowed_aggregates(split(classify(decode(raw)))[0], "5 minutes", "2 minutes")

    query = append_to_parquet(
        aggregates(envelope_stream(streams, folder)), str(tmp_path / "o"), str(tmp_path / "c"), None
    )
    query.awaitTermination()
    closed = aggregates(table).where("window_end <= TIMESTAMP'2031-03-05 10:27:59'")
    got = read_results(spark, str(tmp_path / "o"))
    assert got.count() == 15
    assert got.exceptAll(closed).count() == closed.exceptAll(got).count() == 0


def test_upserts_are_idempotent(spark, tmp_path):
    start = datetime(2031, 3, 5, 10)

    def changes(*rows):
        full = [
            (start, start + timedelta(minutes=1), device, "battery", mean, n, 0.0, 1.0)
            for device, mean, n in rows
        ]
        return spark.createDataFrame(
            full,
            "window_start TIMESTAMP, window_end TIMESTAMP, device_id STRING, metric_type STRING, "
            "avg_value DOUBLE, event_count BIGINT, min_value DOUBLE, max_value DOUBLE",
        )

    path = str(tmp_path / "upserts")
    assert read_upserts(spark, path).count() == 0
    write = upsert_writer(path, files_per_batch=1)
    write(changes(("a", 1.0, 1), ("b", 5.0, 1)), 0)
    write(changes(("a", 2.0, 2)), 1)
    write(changes(("a", 2.0, 2)), 1)
    got = {(r.device_id, r.avg_value, r.event_count) for r in read_upserts(spark, path).collect()}
    assert got == {("a", 2.0, 2), ("b", 5.0, 1)}
    compact(spark, path, 1)
    write(changes(("a", 7.0, 7), ("c", 1.0, 1)), 1)  # held by the base: changes nothing
    write(changes(("b", 6.0, 2)), 2)
    got = {(r.device_id, r.avg_value, r.event_count) for r in read_upserts(spark, path).collect()}
    assert got == {("a", 2.0, 2), ("b", 6.0, 2)}
    plan = latest(spark.read.parquet(f"{path}/changes"))._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan


def test_progress_log(spark, streams, tmp_path):
    (tmp_path / "feed").mkdir()
    feed = Feed(
        streams, tmp_path / "feed", lambda s: windowed_aggregates(s, "1 minute", "1 minute")
    )
    feed.step((DEVICE, "10:00:10", 10), (DEVICE, "10:05:40", 20))
    assert sum(feed.last("input_rows")) == 2
    assert feed.last("state_rows")[-1] == 1

    class Event:
        progress = feed.query.recentProgress[0]

    log = ProgressLog(spark, str(tmp_path / "log"), every=2)
    log.onQueryProgress(Event)
    assert not (tmp_path / "log").exists()
    log.onQueryProgress(Event)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    log.onQueryProgress(Event)
    log.onQueryTerminated(Event)
    stored = spark.read.parquet(str(tmp_path / "log"))
    assert stored.count() == 3
    assert stored.schema.names == progress_table(spark, []).schema.names
    assert stored.first().query_id == str(feed.query.id)


def test_processing_time_trigger(spark, streams, tmp_path):
    folder = str(tmp_path / "topic")
    rows = [("k", message("10:00:10")), ("k", "{")]
    spark.createDataFrame(rows, "key STRING, value STRING").write.parquet(folder)
    _, dead = split(classify(decode(envelope_stream(streams, folder))))
    paths = str(tmp_path / "out"), str(tmp_path / "check")
    query = append_to_parquet(dead, *paths, trigger_interval="1 second", name="refused")
    try:
        query.processAllAvailable()
        assert query.isActive and query.name == "refused"
    finally:
        query.stop()
    assert [r.raw_value for r in read_results(spark, paths[0]).collect()] == ["{"]


def test_settings():
    assert JobSettings.from_environment({}) == JobSettings()
    environment = {"KAFKA_TOPIC": "t", "WINDOW_DURATION": "5 minutes", "X": "1"}
    given = JobSettings.from_environment(environment)
    assert (given.kafka_topic, given.window_duration) == ("t", "5 minutes")
    assert given.watermark_delay == "2 minutes"


def test_kafka_options():
    assert kafka_options("h:1", "t", maxOffsetsPerTrigger="10") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10",
    }


def test_new_folder_lies_below_the_shared_setting(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    one, two = new_folder(spark, "x"), new_folder(spark, "x")
    assert one != two and one.startswith(shared) and two.startswith(shared)
