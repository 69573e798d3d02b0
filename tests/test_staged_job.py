"""Staged job, late rows as a table, open windows, a silent fleet, replay once."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import sensorloom as sl
from sensorloom.operators import replay_ledger
from sensorloom.operators.quiet import quiet_signals_with_heartbeat
from sensorloom.session import heartbeat_session, stream_session
from sensorloom.sources.streams import envelope_stream, read_results
from sensorloom.streaming.job import JobSettings
from sensorloom.streaming.late_table import (
    append_late_rows, committed_batches, read_late_rows, read_watermark_log,
)
from sensorloom.streaming.open_windows import held_by_partition, open_windows
from sensorloom.streaming.sinks import append_to_parquet
from sensorloom.streaming.staged import VALID, staged_rows, staged_stream, start_stage, start_staged_queries

START = datetime(2031, 3, 4, 6)


@pytest.fixture(scope="module")
def streams(spark):
    return stream_session(spark, partitions=2)


def message(device, minutes, value=20.5, metric="temperature"):
    at = (START + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = f'{{"device_id":"{device}","timestamp":"{at}","metric_type":"{metric}","value":{value}}}'
    return device, body


class Inbox:
    """Messages as Parquet files; each step is one file."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)

    def send(self, *messages):
        frame = self.spark.createDataFrame(list(messages), "key STRING, value STRING").coalesce(1)
        frame.write.mode("append").parquet(f"{self.folder}/inbox")

    def stream(self, session):
        return envelope_stream(session, f"{self.folder}/inbox")


def settings_in(folder, **more):
    return JobSettings(
        output_path=f"{folder}/aggregates", dead_letter_path=f"{folder}/dead", checkpoint_path=f"{folder}/check",
        stage_path=f"{folder}/staged", window_duration="10 minutes", watermark_delay="5 minutes", **more,
    )


def run_job(session, inbox, settings):
    queries = start_staged_queries(inbox.stream(session), settings, until_done=True)
    for query in queries:
        query.awaitTermination()
    return queries


def plan_of(query):
    return query._jsq.explainInternal(True)


def test_one_parse_for_both_tables(spark, streams, tmp_path):
    inbox = Inbox(spark, tmp_path)
    inbox.send(message("dev-0000000a", 0), message("dev-0000000b", 1, metric="noise"), ("k", "{"))
    inbox.send(message("dev-0000000a", 60))
    stage, aggregates, dead = run_job(streams, inbox, settings_in(tmp_path))
    # Four plans are printed: of each, the parse must appear in the stage alone.
    assert "from_json" in plan_of(stage).lower() or "json_tuple" in plan_of(stage).lower()
    executed = plan_of(stage).split("== Physical Plan ==")[-1]
    assert executed.lower().count("from_json(") == 1
    assert "json" not in plan_of(aggregates).lower() and "json" not in plan_of(dead).lower()
    refused = read_results(spark, f"{tmp_path}/dead")
    assert {(r.error_reason, r.raw_value == "{") for r in refused.collect()} == {
        ("invalid_metric_type", False), ("invalid_json", True),
    }
    assert read_results(spark, f"{tmp_path}/aggregates").count() == 1


def test_restart_between_the_stages(spark, streams, tmp_path):
    inbox, settings = Inbox(spark, tmp_path), settings_in(tmp_path)
    inbox.send(message("dev-0000000a", 0), ("k", "no json"))
    run_job(streams, inbox, settings)
    # The stage goes on alone, twice, as if the queries behind it were down.
    for minutes in (30, 60):
        inbox.send(message("dev-0000000a", minutes), ("k", f"no json {minutes}"))
        stage = start_stage(inbox.stream(streams), settings.stage_path, f"{settings.checkpoint_path}/stage", None)
        stage.awaitTermination()
    assert read_results(spark, settings.dead_letter_path).count() == 1
    run_job(streams, inbox, settings)
    assert read_results(spark, settings.dead_letter_path).count() == 3
    closed = read_results(spark, settings.output_path).select("window_start").collect()
    assert sorted(r.window_start for r in closed) == [START, START + timedelta(minutes=30)]


def test_settings_of_the_staged_job():
    settings = JobSettings.from_environment({"STAGE_PATH": "staged", "DEAD_LETTER_INTERVAL": "5 seconds"})
    assert (settings.stage_path, settings.dead_letter_interval, settings.stage_interval) == ("staged", "5 seconds", "")
    with pytest.raises(ValueError, match="'./data/output"):
        settings.require_shared_paths()


def test_staged_columns(spark):
    rows = spark.createDataFrame([message("dev-0000000a", 0), ("k", "[]")], "key STRING, value STRING")
    found = {r.route: r for r in staged_rows(sl.classify(sl.decode(rows))).collect()}
    assert found["valid"].raw_value is None and found["valid"].quarantined_at is None
    assert found["dead_letter"].raw_value == "[]" and found["dead_letter"].value is None


def late_job(spark, session, folder, files_per_trigger):
    """A stage of many files and hour windows over it, several batches in one run."""
    inbox = Inbox(spark, folder)
    for hour, minutes in enumerate([(0, 30), (70, 200), (10, 130, 210), (330, 15), (60, 190, 335), (336, 337)]):
        inbox.send(*[message(f"dev-0000000{hour}", m) for m in minutes])
        start_stage(inbox.stream(session), f"{folder}/staged", f"{folder}/stage", None).awaitTermination()
    valid = staged_stream(session, f"{folder}/staged", VALID, maxFilesPerTrigger=files_per_trigger)
    windows = sl.windowed_aggregates(valid, "1 hour", "10 minutes")
    append_to_parquet(windows, f"{folder}/table", f"{folder}/check", None).awaitTermination()


@pytest.mark.parametrize("files_per_trigger", [1, 2, 100])
def test_emitted_open_and_late_are_all(spark, streams, tmp_path, files_per_trigger):
    late_job(spark, streams, tmp_path, files_per_trigger)
    args = f"{tmp_path}/staged", f"{tmp_path}/check", f"{tmp_path}/late", "1 hour"
    last = append_late_rows(spark, *args)
    late = read_late_rows(spark, f"{tmp_path}/late")
    emitted = read_results(spark, f"{tmp_path}/table")
    held = open_windows(spark, f"{tmp_path}/check")
    counts = [frame.agg(F.sum("event_count")).first()[0] or 0 for frame in (emitted, held)]
    assert sum(counts) + late.count() == read_results(spark, f"{tmp_path}/staged").count() == 14
    assert emitted.columns == held.columns
    assert not set(map(tuple, emitted.select("window_start", "device_id").collect())) & set(
        map(tuple, held.select("window_start", "device_id").collect())
    )
    assert late.count() > 0 if files_per_trigger < 100 else late.count() == 0
    assert late.where("event_time >= watermark").count() == 0
    # Again: no batch is new, nothing is added.
    assert append_late_rows(spark, *args) == last
    assert read_watermark_log(spark, f"{tmp_path}/late").count() == last + 1
    assert held_by_partition(spark, f"{tmp_path}/check").agg(F.sum("keys")).first()[0] == held.count()


def test_late_rows_over_restarts_and_a_call_cut_off(spark, streams, tmp_path, monkeypatch):
    late_job(spark, streams, tmp_path, 1)
    args = f"{tmp_path}/staged", f"{tmp_path}/check", f"{tmp_path}/late", "1 hour"
    from sensorloom.streaming import late_table

    every = committed_batches(spark, f"{tmp_path}/check")
    # The first call sees three batches and is cut off before its log is written.
    monkeypatch.setattr(late_table, "committed_batches", lambda *_: every[:3])
    real, frames = spark.createDataFrame, []
    monkeypatch.setattr(
        type(spark), "createDataFrame",
        lambda self, rows, schema: frames.append(1) or (_ for _ in ()).throw(RuntimeError("cut off"))
        if "ms BIGINT" in schema and "batchId" not in schema else real(rows, schema),
    )
    with pytest.raises(RuntimeError, match="cut off"):
        append_late_rows(spark, *args)
    monkeypatch.undo()
    assert frames and read_late_rows(spark, f"{tmp_path}/late").count() == 0
    append_late_rows(spark, *args)
    in_one = read_late_rows(spark, f"{tmp_path}/late")
    append_late_rows(spark, *args[:2], f"{tmp_path}/other", "1 hour")
    other = read_late_rows(spark, f"{tmp_path}/other")
    assert Counter(map(tuple, in_one.collect())) == Counter(map(tuple, other.collect()))


def test_forgotten_batches_are_an_error(spark, streams, tmp_path, monkeypatch):
    late_job(spark, streams, tmp_path, 1)
    from sensorloom.streaming import late_table

    every = committed_batches(spark, f"{tmp_path}/check")
    monkeypatch.setattr(late_table, "committed_batches", lambda *_: every[2:])
    with pytest.raises(ValueError, match="batches 0 to 1 are gone"):
        append_late_rows(spark, f"{tmp_path}/staged", f"{tmp_path}/check", f"{tmp_path}/late", "1 hour")


def test_open_windows_of_an_earlier_batch(spark, streams, tmp_path):
    late_job(spark, streams, tmp_path, 1)
    first = open_windows(spark, f"{tmp_path}/check", batch_id=0).collect()
    assert {(r.device_id, r.event_count, r.avg_value) for r in first} == {("dev-00000000", 2, 20.5)}


def fleet(spark, session, folder, beats):
    rows = [("dev-0000000a", START), ("dev-0000000a", START + timedelta(minutes=20)), ("dev-0000000b", START)]
    spark.createDataFrame(rows, "device_id STRING, event_time TIMESTAMP").write.parquet(f"{folder}/readings")
    ticks = [(START + timedelta(minutes=10 * n),) for n in range(beats)]
    spark.createDataFrame(ticks, "timestamp TIMESTAMP").write.parquet(f"{folder}/ticks")
    readings = session.readStream.schema("device_id STRING, event_time TIMESTAMP").parquet(f"{folder}/readings")
    heartbeats = session.readStream.schema("timestamp TIMESTAMP").parquet(f"{folder}/ticks")
    signals = quiet_signals_with_heartbeat(readings, heartbeats, "1 hour", "5 minutes", "30 minutes")
    append_to_parquet(signals, f"{folder}/out", f"{folder}/check", None).awaitTermination()
    return {(r.device_id, r.event_count) for r in read_results(spark, f"{folder}/out").collect()}


@pytest.mark.parametrize(
    ("beats", "told"),
    [(3, set()), (11, {("dev-0000000b", 1)}), (30, {("dev-0000000a", 2), ("dev-0000000b", 1)})],
)
def test_a_silent_fleet_is_told_by_the_clock(spark, tmp_path, beats, told):
    assert fleet(spark, heartbeat_session(spark, 2), tmp_path, beats) == told


def test_the_greater_watermark_is_needed(spark, streams, tmp_path):
    assert fleet(spark, streams, tmp_path, 30) == set()


def letters(spark, *rows):
    return spark.createDataFrame(list(rows), "raw_value STRING, device_id STRING, error_reason STRING")


def test_replay_once(spark, tmp_path, monkeypatch):
    def opened(frame):
        return frame.withColumn("raw_value", F.replace("raw_value", F.lit("noise"), F.lit("temperature")))

    bad = message("dev-0000000a", 0, metric="noise")[1], "dev-0000000a", "invalid_metric_type"
    other = message("dev-0000000b", 0, metric="noise")[1], "dev-0000000b", "invalid_metric_type"
    hopeless = None, None, "invalid_json"
    folder = str(tmp_path)
    first = letters(spark, bad, bad, hopeless, ("", None, "missing_device_id"))
    assert replay_ledger.replay_once(first, folder, opened) == 0
    assert replay_ledger.replayed(spark, folder).count() == 2
    assert replay_ledger.still_refused(spark, folder).count() == 2
    # A run that finds nothing new leaves nothing behind, its number neither.
    replay_ledger.replay_once(first, folder, opened)
    assert replay_ledger.replayed(spark, folder).count() == 2
    # One more copy, and one new letter; the run is cut off before its ledger, and repeated.
    more = letters(spark, bad, bad, bad, hopeless, ("", None, "missing_device_id"), other)
    real = replay_ledger.replay

    def cut_off(dead, repair=None, **options):
        valid, still = real(dead, repair, **options)
        valid.write.mode("overwrite").parquet(f"{folder}/valid/run=1")
        raise RuntimeError("cut off")

    monkeypatch.setattr(replay_ledger, "replay", cut_off)
    with pytest.raises(RuntimeError, match="cut off"):
        replay_ledger.replay_once(more, folder, opened)
    monkeypatch.undo()
    assert replay_ledger.replayed(spark, folder).count() == 2
    assert replay_ledger.replay_once(more, folder, opened) == 1
    found = Counter(r.device_id for r in replay_ledger.replayed(spark, folder).collect())
    assert found == {"dev-0000000a": 3, "dev-0000000b": 1}
    assert replay_ledger.still_refused(spark, folder).count() == 2
