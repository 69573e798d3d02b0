"""Audit, quiet devices, lateness, rates and replay, over tables."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorloom import (
    audit_contract,
    classify,
    dead_letter_rate,
    dead_letter_volume,
    decode,
    quiet_periods,
    replay,
    replay_watermark,
    spikes_against_past,
    split,
)
from sensorloom.functions.durations import milliseconds
from sensorloom.operators import lateness
from sensorloom.plans import reports
from sensorloom.sources.streams import literal_messages

GOOD = {
    "device_id": "dev-0000abcd",
    "timestamp": "2031-03-05T10:00:00.000Z",
    "metric_type": "temperature",
    "value": 21.5,
}
START = datetime(2031, 3, 5, 10)


def body(drop=(), **changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if k not in drop})


AUDIT = [
    (body(), []),
    (body(site_id="s", firmware_version="1"), []),
    (body(value=21), []),
    (body(value=1e300), []),
    (body(timestamp="2031-03-05T10:00:00+05:30"), []),
    (body(device_id="DEV-0000abcd"), ["pattern:device_id"]),
    (body(device_id=None), ["type:device_id"]),
    (body(device_id=7), ["type:device_id"]),
    (body(drop=["device_id", "value"]), ["missing:device_id", "missing:value"]),
    (body(value="21.5"), ["type:value"]),
    (body(value=True), ["type:value"]),
    (body(timestamp="2031-03-05 10:00:00Z"), ["format:timestamp"]),
    (body(timestamp="2026-02-30T10:00:00Z"), ["format:timestamp"]),
    (body(metric_type="TEMPERATURE"), ["enum:metric_type"]),
    (body(site_id=1), ["type:site_id"]),
    (body(zeta=1, alpha={"x": 2}), ["unknown:alpha", "unknown:zeta"]),
    ('{"device_id":"dev-0000000a","device_id":"dev-0000000b"}', ["duplicate:device_id"]),
    ('{"b":1,"a":2,"b":3,"a":4}', ["duplicate:a", "duplicate:b"]),
    ("{'device_id':'dev-0000000a'}", ["syntax"]),
    ("[1]", ["not_an_object"]),
    ("{", ["not_an_object"]),
    ("null", ["not_an_object"]),
    ("", ["not_an_object"]),
    (None, ["not_an_object"]),
    (body() + "tail", []),
]


def test_infinite_number_is_a_number_to_the_audit_only(spark):
    """1e400 is a JSON number, so the audit lets it pass; classify reads no double in it."""
    text = (
        '{"device_id":"dev-0000000a","timestamp":"2025-11-03T04:05:06Z",'
        '"metric_type":"battery","value":1e400}'
    )
    raw = literal_messages(spark, [("k", text)])
    assert audit_contract(raw).first().violations == []
    assert classify(decode(raw)).first().error_reason == "missing_or_non_numeric_value"


def test_audit_of_lateness_keeps_every_row(spark):
    times = [("2025-11-03 04:00:00", "2025-11-03 04:00:01"), (None, "2025-11-03 04:00:05"),
             ("2025-11-03 04:00:02", None), (None, None)]
    events = spark.createDataFrame(times, "event STRING, came STRING").select(
        F.to_timestamp("event").alias("event_time"), F.to_timestamp("came").alias("arrival_time")
    )
    plain = replay_watermark(events, "1 minute", "1 minute")
    windowed = replay_watermark(events, "1 minute", "1 minute", "1 minute")
    assert plain.count() == windowed.count() == 4
    assert windowed.where("batch_start IS NULL AND NOT is_late AND NOT is_dropped").count() == 2


def test_route_totals_read_once(spark):
    raw = literal_messages(spark, [("k", "{"), ("k", ""), ("k", body())])
    totals = reports.route_totals(classify(decode(raw)))
    assert {r.name: r.total for r in totals.collect()} == {"valid": 1, "dead_letter": 2}
    assert totals._jdf.queryExecution().sparkPlan().toString().count("from_json(") == 1


def test_silence_at_the_end_reads_once(spark):
    events = spark.range(10).selectExpr(
        "CONCAT('d', id % 3) AS device_id", "TIMESTAMP_SECONDS(id * 1000) AS event_time"
    )
    silent = quiet_periods(events.repartition(2), "5 minutes", at_end=True)
    silent.collect()
    plan = silent._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_contract_audit(spark):
    raw = literal_messages(spark, [(str(i), text) for i, (text, _) in enumerate(AUDIT)])
    found = {int(row.key): row.violations for row in audit_contract(raw).collect()}
    assert found == {i: expected for i, (_, expected) in enumerate(AUDIT)}


def at(seconds):
    return START + timedelta(seconds=seconds)


def test_quiet_periods_against_brute_force(spark):
    rng = random.Random(7)
    events = [(f"d{rng.randrange(5)}", at(rng.randrange(0, 200_000, 10))) for _ in range(400)]
    events += [("hot", at(i)) for i in range(500)] + [("edge", at(0)), ("edge", at(600))]
    df = spark.createDataFrame(events, "device_id STRING, event_time TIMESTAMP")
    end = max(when for _, when in events)
    limit = timedelta(minutes=10)

    seen = defaultdict(set)
    for device, when in events:
        seen[device].add(when)
    expected, still = set(), set()
    for device, times in seen.items():
        times = sorted(times)
        expected |= {(device, a, b) for a, b in zip(times, times[1:]) if b - a > limit}
        if end - times[-1] > limit:
            still.add((device, times[-1], None))

    assert {tuple(r) for r in quiet_periods(df, "10 minutes").collect()} == expected
    as_of = F.lit(end)
    assert {tuple(r) for r in quiet_periods(df, "10 minutes", as_of=as_of).collect()} == (
        expected | still
    )
    at_end = quiet_periods(df, "10 minutes", at_end=True)
    assert {tuple(r) for r in at_end.collect()} == expected | still
    assert ("edge", at(0), at(600)) not in expected


@pytest.mark.parametrize("chunk", [1, 3, 1024])
def test_watermark_replay_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(lateness, "CHUNK_BATCHES", chunk)
    rng = random.Random(11)
    rows = []
    for i in range(500):
        arrival = at(rng.randrange(3600))
        rows.append((i, arrival, arrival - timedelta(seconds=rng.choice([0, 5, 200, 400]))))
    df = spark.createDataFrame(rows, "id INT, arrival_time TIMESTAMP, event_time TIMESTAMP")
    out = replay_watermark(df, "30 seconds", "2 minutes", window_duration="1 minute")

    def slot(when, seconds):
        return datetime.fromtimestamp(when.timestamp() // seconds * seconds)

    expected = set()
    for i, arrival, event in rows:
        peaks = [e for _, a, e in rows if slot(a, 30) < slot(arrival, 30)]
        mark = max(peaks) - timedelta(minutes=2) if peaks else None
        closes = slot(event, 60) + timedelta(minutes=1)
        late, dropped = mark is not None and event < mark, mark is not None and closes <= mark
        expected.add((i, mark, late, dropped))
    got = out.select("id", "watermark", "is_late", "is_dropped").collect()
    assert {tuple(r) for r in got} == expected
    assert any(r.is_dropped for r in got) and any(r.is_late and not r.is_dropped for r in got)
    late_ids = {r.id for r in lateness.late_rows(df, "30 seconds", "2 minutes").collect()}
    assert late_ids == {i for i, _, late, _ in expected if late}


def test_rates_and_spikes(spark):
    plan = {0: (10, 1), 1: (10, 2), 2: (10, 6), 4: (10, 2), 5: (4, 4)}
    rows = [
        (at(60 * minute + n), n >= bad)
        for minute, (total, bad) in plan.items()
        for n in range(total)
    ]
    df = spark.createDataFrame(rows, "arrival_time TIMESTAMP, is_valid BOOLEAN")
    rates = dead_letter_rate(df, "1 minute", alert_rate=0.6)
    got = {
        r.window_start: (r.records, r.dead_letters, r.rate, r.is_spike) for r in rates.collect()
    }
    assert got == {
        at(60 * m): (total, bad, bad / total, bad / total >= 0.6)
        for m, (total, bad) in plan.items()
    }
    past = {
        r.window_start: (r.past_rate, r.is_spike)
        for r in spikes_against_past(rates, "1 minute", lookback=2).collect()
    }
    assert past == {
        at(0): (None, False),
        at(60): (0.1, True),
        at(120): (0.15, True),
        at(240): (0.6, False),
        at(300): (0.2, True),
    }


def test_dead_letter_volume(spark):
    df = spark.createDataFrame(
        [("a", at(0)), ("a", at(59)), ("b", at(1)), ("a", at(60))],
        "error_reason STRING, quarantined_at TIMESTAMP",
    )
    got = {tuple(r) for r in dead_letter_volume(df, "1 minute").collect()}
    assert got == {
        (at(0), at(60), "a", 2),
        (at(0), at(60), "b", 1),
        (at(60), at(120), "a", 1),
    }


def test_replay_after_a_fix(spark):
    rows = [("k", body(metric_type="temp")), ("k", body(value="N/A")), ("k", body())]
    _, dead = split(classify(decode(literal_messages(spark, rows))))

    def renamed(letters):
        fixed = F.regexp_replace("raw_value", '"temp"', '"temperature"')
        return letters.withColumn("raw_value", fixed)

    valid, still = replay(dead)
    assert (valid.count(), still.count()) == (0, 2)
    valid, still = replay(dead, renamed)
    assert [r.metric_type for r in valid.collect()] == ["temperature"]
    assert [r.error_reason for r in still.collect()] == ["missing_or_non_numeric_value"]


def test_durations():
    assert milliseconds("1 hour 30 minutes") == 5_400_000
    assert milliseconds("250 milliseconds") == 250
    assert milliseconds("1 Day") == 86_400_000
    for bad in ("", "1 month", "soon", "1 minute or so"):
        with pytest.raises(ValueError):
            milliseconds(bad)
