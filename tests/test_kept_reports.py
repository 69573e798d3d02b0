"""Reports kept batch by batch against the same reports over all rows."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sensorloom.contract import AGGREGATE_COLUMNS, AGGREGATE_SCHEMA, DEAD_LETTER_SCHEMA
from sensorloom.operators.refused import dead_letter_rate, spikes_against_past, spikes_on_stream
from sensorloom.plans import kept_reports as kept
from sensorloom.plans.reports import reason_breakdown, recent_dead_letters, recent_windows
from sensorloom.session import new_folder, stream_session
from sensorloom.sources.streams import path_exists, read_results
from sensorloom.streaming.sinks import append_to_parquet
from sensorloom.streaming.upserts import read_upserts, versions_before

START = datetime(2031, 3, 5)


def window(n, version):
    at = START + timedelta(hours=n)
    mean = round((n * 7919 + version * 31) % 1000 / 7, 3)
    metric = ("humidity", "battery", "temperature")[n % 3]
    return (at, at + timedelta(hours=1), f"dev-{n % 4:08x}", metric, mean, version + 1, mean, mean)


def rollup_of(windows):
    """By plain arithmetic, exactly."""
    found = {}
    for row in windows:
        of = found.setdefault(row[3], [0, 0, Decimal(0), Decimal(0)])
        mean = Decimal(str(row[4]))
        for place, more in enumerate((1, row[5], mean, mean * row[5])):
            of[place] += more
    return sorted((m, n, e, float(s) / n, float(w) / e) for m, (n, e, s, w) in found.items())


def test_windows_after_each_of_ten_batches(spark):
    folder, draw, now = new_folder(spark, "kept"), random.Random(3), {}
    for batch in range(10):
        # New windows, and new versions of old ones; batch 6 changes nothing.
        numbers = set() if batch == 6 else {*draw.sample(range(40), 6), 40 + batch}
        if batch in (3, 9):
            # A first attempt with other rows that was cut off after its states were written.
            torn = spark.createDataFrame([window(n, 90) for n in range(30)], AGGREGATE_SCHEMA)
            kept.keep_window_reports(torn, batch, folder, n=5, compact_every=4)
        changes = [window(n, batch) for n in sorted(numbers)]
        now.update({n: window(n, batch) for n in numbers})
        kept.keep_window_reports(
            spark.createDataFrame(changes, AGGREGATE_SCHEMA), batch, folder, n=5, compact_every=4
        )
        rollup = [tuple(r) for r in kept.kept_rollup(spark, folder).collect()]
        assert [r[:3] for r in rollup] == [r[:3] for r in rollup_of(now.values())]
        for one, other in zip(rollup, rollup_of(now.values()), strict=True):
            assert one[3:] == pytest.approx(other[3:], rel=1e-12)
        whole = spark.createDataFrame(list(now.values()), AGGREGATE_SCHEMA)
        assert kept.kept_recent_windows(spark, folder, 5).collect() == recent_windows(whole, 5).collect()
    stored = read_upserts(spark, f"{folder}/windows").select(*AGGREGATE_COLUMNS)
    assert sorted(map(tuple, stored.collect())) == sorted(now.values())


def test_the_batchs_range_reaches_the_files(spark):
    folder = new_folder(spark, "kept")
    kept.keep_window_reports(spark.createDataFrame([window(1, 0)], AGGREGATE_SCHEMA), 0, folder)
    known = versions_before(spark, f"{folder}/windows", 1)
    plan = known.where(F.col("window_start") >= F.lit(START))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(window_start" in plan.split("PushedFilters")[1]


def test_letters_after_each_batch(spark):
    folder, draw, now = new_folder(spark, "kept"), random.Random(5), []
    reasons = ("invalid_json", "missing_device_id", "invalid_timestamp")
    for batch in range(6):
        rows = [
            (draw.choice(["a", "b", None]), None, draw.choice(reasons), START + timedelta(hours=draw.randrange(9)))
            for _ in range(batch * 4)
        ]
        for attempt in (rows[: batch // 2], rows) if batch % 2 else (rows,):
            kept.keep_letter_reports(spark.createDataFrame(attempt, DEAD_LETTER_SCHEMA), batch, folder, 7)
        now += rows
        whole = spark.createDataFrame(now, DEAD_LETTER_SCHEMA)
        assert kept.kept_breakdown(spark, folder).collect() == reason_breakdown(whole).collect()
        assert kept.kept_recent_letters(spark, folder, 7).collect() == recent_dead_letters(whole, 7).collect()


def test_a_batch_is_not_left_out_and_old_states_go(spark, monkeypatch):
    folder = new_folder(spark, "kept")
    assert kept.kept_rollup(spark, folder).count() == kept.kept_breakdown(spark, folder).count() == 0
    monkeypatch.setattr(kept, "STATES_KEPT", 2)
    letters = spark.createDataFrame([("x", None, "invalid_json", START)], DEAD_LETTER_SCHEMA)
    for batch in range(4):
        kept.keep_letter_reports(letters, batch, folder)
    there = [path_exists(spark, f"{folder}/reasons/batch_id={n}") for n in range(4)]
    assert there == [False, False, True, True]
    with pytest.raises(ValueError):
        kept.keep_letter_reports(letters, 5, folder)
    with pytest.raises(ValueError):
        kept.keep_window_reports(spark.createDataFrame([window(1, 0)], AGGREGATE_SCHEMA), 1, folder)
    assert kept.kept_breakdown(spark, folder).first().n == 4


def records(hours):
    """(arrival_time, is_valid); an hour's records and how many of them are refused."""
    return [
        (START + timedelta(hours=h, minutes=m), m >= bad) for h, (n, bad) in hours.items() for m in range(n)
    ]


HOURS = {0: (10, 2), 1: (10, 1), 2: (20, 2), 3: (10, 5), 7: (10, 1), 9: (10, 10), 10: (10, 0), 20: (5, 5), 24: (1, 0)}
RECORDS_SCHEMA = "arrival_time TIMESTAMP, is_valid BOOLEAN"


def test_spikes_of_a_table(spark):
    rows = spark.createDataFrame(records(HOURS), RECORDS_SCHEMA)
    names = ["window_start", "window_end", "records", "dead_letters", "rate", "past_rate", "is_spike"]
    slow = spikes_against_past(dead_letter_rate(rows, "1 hour"), "1 hour", 3, 2.0)
    fast = spikes_on_stream(rows, "1 hour", 3, 2.0)
    assert sorted(fast.select(names).collect()) == sorted(slow.select(names).collect())
    spikes = {row.window_start.hour for row in fast.where("is_spike").collect() if row.window_start.day == 5}
    assert spikes == {3, 9}


def test_spikes_of_a_stream_in_parts(spark):
    """Hour by hour over one checkpoint: each window is told once, as it closes."""
    folder, session, told = new_folder(spark, "spikes"), stream_session(spark), []
    for hour in HOURS:
        part = records({hour: HOURS[hour]})
        spark.createDataFrame(part, RECORDS_SCHEMA).write.mode("append").parquet(f"{folder}/inbox")
        stream = session.readStream.schema(RECORDS_SCHEMA).parquet(f"{folder}/inbox")
        append_to_parquet(
            spikes_on_stream(stream, "1 hour", 3, 2.0, "1 minute"), f"{folder}/table", f"{folder}/checkpoint", None
        ).awaitTermination()
        told.append(read_results(spark, f"{folder}/table").count())
    assert told == list(range(len(HOURS)))
    closed = [h for h in HOURS if h < 24]
    rows = spark.createDataFrame(records({h: HOURS[h] for h in closed}), RECORDS_SCHEMA)
    found = read_results(spark, f"{folder}/table").collect()
    assert sorted(found) == sorted(spikes_on_stream(rows, "1 hour", 3, 2.0).collect())
