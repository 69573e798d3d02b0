"""The store that takes each event once: late copies, false alarms of the index, cut-off runs."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensorloom.contract import VALID_SCHEMA
from sensorloom.operators import event_store
from sensorloom.operators.event_store import append_new_events, date_index, possible_copies, stored_events
from sensorloom.session import new_folder

START = datetime(2031, 3, 5)


def reading(n, day=0, site="a"):
    at = START + timedelta(days=day, seconds=n)
    return (f"dev-{n % 7:08x}", at, "temperature", float(n), site, None)


def table(spark, rows):
    return spark.createDataFrame(rows, VALID_SCHEMA)


def test_a_copy_ten_days_late(spark):
    folder = new_folder(spark, "store")
    assert stored_events(spark, folder).count() == 0
    assert append_new_events(table(spark, [reading(n) for n in range(20)]), folder) == 0
    late = [reading(n, site="b") for n in range(20)] + [reading(n, day=10) for n in range(5)]
    assert append_new_events(table(spark, late + late), folder) == 1
    found = sorted(tuple(r) for r in stored_events(spark, folder).collect())
    assert found == sorted([reading(n) for n in range(20)] + [reading(n, day=10) for n in range(5)])
    assert append_new_events(table(spark, []), folder) == 2
    assert stored_events(spark, folder).count() == 25


@pytest.mark.parametrize("per_bitmap", [16, 1 << 30])
def test_runs_against_a_set(spark, monkeypatch, per_bitmap):
    """Busy dates in many bitmaps, and one bitmap so full that nearly everything is looked up."""
    monkeypatch.setattr(event_store, "EVENTS_PER_BITMAP", per_bitmap)
    folder, draw = new_folder(spark, "store"), random.Random(per_bitmap)
    kept = {}
    for run in range(3):
        day = lambda: 0 if draw.random() < 0.8 else draw.randrange(1, 4)
        rows = [reading(draw.randrange(3000), day(), f"site-{run}") for _ in range(2500)]
        rows += [reading(1, 0, f"site-{run}")] * 1500
        append_new_events(table(spark, rows).repartition(5), folder)
        for row in rows:
            kept.setdefault(row[:4], row)
    assert Counter(tuple(r) for r in stored_events(spark, folder).collect()) == Counter(kept.values())


def test_the_index_misses_nothing(spark):
    some = table(spark, [reading(n) for n in range(40_000)]).withColumn("event_date", F.to_date("event_time"))
    index = date_index(some)
    assert index.count() == index.select("buckets").first()[0] == 16
    assert possible_copies(some, index).count() == 40_000
    others = table(spark, [reading(n) for n in range(40_000, 80_000)])
    others = others.withColumn("event_date", F.to_date("event_time"))
    assert 0 < possible_copies(others, index).count() < 40_000 / 8


def test_a_run_that_was_cut_off(spark):
    folder = new_folder(spark, "store")
    append_new_events(table(spark, [reading(1)]), folder)
    # Events and index were written, the note was not.
    junk = table(spark, [reading(2), reading(3)]).withColumn("event_date", F.to_date("event_time"))
    junk.write.partitionBy("event_date").parquet(f"{folder}/events/run=1")
    date_index(junk).write.partitionBy("event_date").parquet(f"{folder}/index/run=1")
    assert stored_events(spark, folder).count() == 1
    assert append_new_events(table(spark, [reading(1), reading(2)]), folder) == 1
    assert sorted(r.value for r in stored_events(spark, folder).collect()) == [1.0, 2.0]


def test_what_is_refused(spark):
    folder = new_folder(spark, "store")
    with pytest.raises(ValueError):
        append_new_events(table(spark, []).withColumn("run", F.lit(1)), folder)
    with pytest.raises(PySparkException):
        append_new_events(table(spark, [reading(1)]).withColumn("device_id", F.lit(None).cast("string")), folder)
