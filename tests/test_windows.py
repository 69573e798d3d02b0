"""Window aggregates and reports over tables."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from sensorloom import merge_copies, sliding_by_panes, telemetry_tables, windowed_aggregates
from sensorloom.contract import AGGREGATE_COLUMNS, METRICS
from sensorloom.plans import reports
from sensorloom.sources.streams import literal_messages, literal_readings

DAY = "2025-03-11T"


def readings(spark, *rows):
    full = [
        (device, DAY + at, metric, float(v), "hall-7", "3.0.9") for device, at, metric, v in rows
    ]
    return literal_readings(spark, full)


def at(hour, minute, second=0):
    return datetime(2025, 3, 11, hour, minute, second)


def generated(seed, count=400):
    """Readings (device, second of the day, metric, thousandths) in no order."""
    draw = random.Random(seed)
    return [
        (f"dev-{draw.randrange(6):08x}", draw.randrange(6 * 3600), draw.choice(METRICS),
         draw.randrange(-20_000, 80_000))
        for _ in range(count)
    ]


def as_table(spark, rows):
    texts = [
        (device, str(timedelta(seconds=second)).rjust(8, "0"), metric, thousandths / 1000)
        for device, second, metric, thousandths in rows
    ]
    return readings(spark, *texts)


def by_hand(rows, length, slide):
    """Every window of every reading, counted in whole numbers."""
    groups = defaultdict(list)
    for device, second, metric, thousandths in rows:
        start = second - second % slide
        while start > second - length:
            groups[start, device, metric].append(thousandths)
            start -= slide
    found = set()
    for (start, device, metric), values in groups.items():
        mean = (Decimal(sum(values)) / len(values)).quantize(Decimal(1), ROUND_HALF_UP)
        found.add((at(0, 0) + timedelta(seconds=start), at(0, 0) + timedelta(seconds=start + length),
                   device, metric, int(mean) / 1000, len(values), min(values) / 1000,
                   max(values) / 1000))
    return found


@pytest.mark.parametrize("length,slide", [(60, 60), (900, 900), (1200, 300), (3600, 2400)])
def test_windows_against_a_count_by_hand(spark, length, slide):
    rows = generated(length + slide)
    step = f"{slide} seconds" if slide != length else None
    aggregates = windowed_aggregates(as_table(spark, rows), f"{length} seconds", slide_duration=step)
    assert tuple(aggregates.columns) == AGGREGATE_COLUMNS
    assert {tuple(row) for row in aggregates.collect()} == by_hand(rows, length, slide)


def test_order_of_rows_cannot_be_seen(spark):
    """Bit by bit the same, whatever the order and the partitions."""
    rows = [("dev-00000001", n % 600, "battery", (n * 7919) % 100_003) for n in range(2000)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        table = as_table(spark, rows).repartition(seed + 1)
        for found in (
            windowed_aggregates(table, "10 minutes", slide_duration="5 minutes"),
            sliding_by_panes(table, "10 minutes", "5 minutes"),
        ):
            seen.add(tuple(sorted((r.window_start, r.avg_value.hex()) for r in found.collect())))
    assert len(seen) == 1


def test_values_that_do_not_fit_have_a_mean_too(spark):
    table = readings(
        spark, ("a", "01:00:00", "battery", 4e15), ("a", "01:00:01", "battery", 2e15),
        ("b", "01:00:00", "battery", float("nan")), ("b", "01:00:01", "battery", 1),
    )
    means = {r.device_id: r.avg_value for r in windowed_aggregates(table).collect()}
    assert means["a"] == 3e15 and means["b"] != means["b"]


def test_copies_counted_once(spark):
    rows = generated(5, 120)
    table = as_table(spark, rows + rows[::3] + rows[::7])
    found = windowed_aggregates(table, "15 minutes", slide_duration="5 minutes", count_copies=False)
    assert {tuple(row) for row in found.collect()} == by_hand(sorted(set(rows)), 900, 300)


def test_start_belongs_to_the_window_and_end_does_not(spark):
    df = readings(
        spark,
        ("dev-00000c0c", "10:00:00", "battery", 1),
        ("dev-00000c0c", "10:00:59.999", "battery", 2),
        ("dev-00000c0c", "10:01:00", "battery", 3),
    )
    counts = {r.window_start: r.event_count for r in windowed_aggregates(df).collect()}
    assert counts == {at(10, 0): 2, at(10, 1): 1}


@pytest.mark.parametrize(
    "window,slide",
    [("1 hour", "5 minutes"), ("10 minutes", "4 minutes"), ("7 minutes", "7 minutes")],
)
def test_panes_give_the_same_windows(spark, window, slide):
    df = (
        spark.range(3000)
        .withColumn("event_time", F.timestamp_seconds(1785312000 + F.col("id") * 37 % 20000))
        .withColumn("device_id", F.concat(F.lit("dev-"), F.col("id") % 3))
        .withColumn("metric_type", F.lit("battery"))
        # whole numbers, so that the order of addition cannot show
        .withColumn("value", (F.col("id") * 7 % 100).cast("double"))
    )
    plain = windowed_aggregates(df, window, slide_duration=slide)
    panes = sliding_by_panes(df, window, slide)
    assert plain.schema.names == panes.schema.names
    assert plain.exceptAll(panes).count() == 0
    assert panes.exceptAll(plain).count() == 0


def test_partial_aggregate_comes_before_the_only_shuffle(spark):
    df = spark.range(10).selectExpr(
        "timestamp_seconds(id) AS event_time", "'d' AS device_id", "'battery' AS metric_type",
        "CAST(id AS DOUBLE) AS value",
    )
    plan = windowed_aggregates(df)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    executed = windowed_aggregates(df)._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange") == 1


def test_copies_are_merged_in_a_hash_aggregate(spark):
    df = readings(
        spark,
        ("dev-aaaa1111", "10:00:05", "temperature", 20),
        ("dev-aaaa1111", "10:00:05", "temperature", 20),
        ("dev-aaaa1111", "10:00:05", "temperature", 26),
    )
    merged = merge_copies(df)
    assert merged.columns == df.columns
    assert sorted(r.value for r in merged.collect()) == [20.0, 26.0]
    (row,) = windowed_aggregates(merged).collect()
    assert (row.avg_value, row.event_count) == (23.0, 2)
    plan = windowed_aggregates(merged)._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan


def test_merge_keeps_one_whole_row(spark):
    rows = [("d", DAY + "10:00:05", "battery", 1.0, site, fw) for site, fw in
            (("b", "1"), ("a", "9"), ("a", "2"), ("c", None))]
    (row,) = merge_copies(literal_readings(spark, rows)).collect()
    assert (row.site_id, row.firmware_version) == ("a", "2")


def test_whole_rows_are_merged_without_a_sort(spark):
    rows = [("d", DAY + "10:00:05", "battery", 1.0, site, "1") for site in ("a", "b", "a", "a")]
    merged = merge_copies(literal_readings(spark, rows), keys=None)
    assert sorted(r.site_id for r in merged.collect()) == ["a", "b"]
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2


def test_chain_from_messages(spark):
    text = ('{"device_id":"dev-00c0ffee","timestamp":"2031-03-05T10:00:00Z",'
            '"metric_type":"battery","value":48.5}')
    raw = literal_messages(spark, [("k", text), ("k", text), ("k", "oops")])
    tables = telemetry_tables(raw)
    assert sorted(tables) == ["aggregates", "dead_letter", "valid"]
    assert tables["valid"].count() == 2
    assert [r.error_reason for r in tables["dead_letter"].collect()] == ["invalid_json"]
    assert [r.event_count for r in tables["aggregates"].collect()] == [2]
    once = telemetry_tables(raw, merge_redelivered=True)
    assert [r.event_count for r in once["aggregates"].collect()] == [1]


def test_reports(spark):
    df = readings(
        spark,
        ("dev-a", "10:00:05", "battery", 10),
        ("dev-a", "10:00:06", "battery", 20),
        ("dev-a", "10:01:05", "battery", 60),
        ("dev-b", "10:01:05", "humidity", 5),
    )
    aggregates = windowed_aggregates(df)
    assert reports.total_rows(aggregates).first().total == 3
    assert [tuple(r) for r in reports.metric_rollup(aggregates).collect()] == [
        ("battery", 2, 3, 37.5),
        ("humidity", 1, 1, 5.0),
    ]
    assert [tuple(r) for r in reports.weighted_rollup(aggregates).collect()] == [
        ("battery", 2, 3, 30.0),
        ("humidity", 1, 1, 5.0),
    ]
    recent = reports.recent_windows(aggregates, 2)
    assert [(r.window_end, r.device_id) for r in recent.collect()] == [
        (at(10, 2), "dev-a"),
        (at(10, 2), "dev-b"),
    ]
    dead = spark.createDataFrame(
        [("r2", "d", "invalid_json", 1), ("r1", "d", "invalid_json", 1), ("r3", None, "x", 2)],
        "raw_value STRING, device_id STRING, error_reason STRING, s BIGINT",
    ).withColumn("quarantined_at", F.timestamp_seconds("s"))
    assert [tuple(r) for r in reports.reason_breakdown(dead).collect()] == [
        ("invalid_json", 2),
        ("x", 1),
    ]
    assert [r.raw_value for r in reports.recent_dead_letters(dead, 2).collect()] == ["r3", "r1"]
    plan = reports.recent_windows(aggregates, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
