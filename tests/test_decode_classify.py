"""Decode and classify: one expected reason per kind of message."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from sensorloom import classify, decode, encode, split
from sensorloom.contract import DEAD_LETTER_COLUMNS, VALID_COLUMNS
from sensorloom.sources.streams import literal_messages

GOOD = {
    "device_id": "dev-5eed0017",
    "timestamp": "2025-11-03T04:05:06.789Z",
    "metric_type": "temperature",
    "value": -3.25,
    "site_id": "quarry-3",
    "firmware_version": "0.9-rc1",
}
VALID = None


def body(drop=(), **changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if k not in drop})


def metric(name, value):
    return body(metric_type=name, value=value)


# (what, text, reason)
CASES = [
    ("canonical", body(), VALID),
    ("no device", body(drop=["device_id"]), "missing_device_id"),
    ("unknown metric", metric("pressure", 1.5), "invalid_metric_type"),
    ("value N/A", body(value="offline"), "missing_or_non_numeric_value"),
    ("bad timestamp", body(timestamp="yesterday"), "invalid_timestamp"),
    ("cut short", body()[:-30], "invalid_json"),
    ("hot", body(value=85.01), "value_out_of_range"),
    ("no timestamp", body(drop=["timestamp"]), "invalid_timestamp"),
    ("no value", body(drop=["value"]), "missing_or_non_numeric_value"),
    ("no metric", body(drop=["metric_type"]), "value_out_of_range"),
    ("null metric", body(metric_type=None), "value_out_of_range"),
    ("sql null", None, "missing_device_id"),
    ("empty", "", "missing_device_id"),
    ("blanks", "   ", "missing_device_id"),
    ("empty object", "{}", "missing_device_id"),
    ("json null", "null", "invalid_json"),
    ("number", "5", "invalid_json"),
    ("empty array", "[]", "invalid_json"),
    ("array of one", f"[{body()}]", "invalid_json"),
    ("array of two", f"[{body()},{body()}]", "invalid_json"),
    ("single quotes", body().replace('"', "'"), VALID),
    ("single quotes, cut", body().replace('"', "'")[:-5], "invalid_json"),
    ("trailing text", body() + " and more", VALID),
    ("two objects", body() + body(device_id=None), VALID),
    ("duplicate key", body()[:-1] + ', "value": "N/A"}', "missing_or_non_numeric_value"),
    ("extra property", body(extra=1), VALID),
    ("odd id", body(device_id="xyz"), VALID),
    ("number as id", body(device_id=7), VALID),
    ("empty id", body(device_id=""), VALID),
    ("upper case metric", metric("TEMPERATURE", 1), "invalid_metric_type"),
    ("empty metric", metric("", 1), "invalid_metric_type"),
    ("metric temp", metric("temp", 1), "invalid_metric_type"),
    ("metric unknown", metric("unknown", 1), "invalid_metric_type"),
    ("value empty", body(value=""), "missing_or_non_numeric_value"),
    ("value ERR", body(value="ERR"), "missing_or_non_numeric_value"),
    ("value null text", body(value="null"), "missing_or_non_numeric_value"),
    ("value null", body(value=None), "missing_or_non_numeric_value"),
    ("value bare NaN", body(value=float("nan")), "missing_or_non_numeric_value"),
    ("value true", body(value=True), "missing_or_non_numeric_value"),
    ("value object", body(value={"a": 1}), "missing_or_non_numeric_value"),
    ("value in quotes", body(value="21.5"), VALID),
    ("value with blanks", body(value=" 21.5 "), VALID),
    ("value with suffix", body(value="21.5d"), VALID),
    ("value with exponent", body(value="1e1"), VALID),
    ("value NaN text", body(value="NaN"), "value_out_of_range"),
    ("value Infinity text", body(value="Infinity"), "value_out_of_range"),
    ("temperature low end", metric("temperature", -40), VALID),
    ("temperature high end", metric("temperature", 85), VALID),
    ("temperature above", metric("temperature", 85.01), "value_out_of_range"),
    ("temperature below", metric("temperature", -40.01), "value_out_of_range"),
    ("humidity ends", metric("humidity", 0), VALID),
    ("humidity above", metric("humidity", 100.5), "value_out_of_range"),
    ("battery end", metric("battery", 100), VALID),
    ("battery below", metric("battery", -0.1), "value_out_of_range"),
    ("signal high end", metric("signal_strength", -20), VALID),
    ("signal low end", metric("signal_strength", -130), VALID),
    ("signal above", metric("signal_strength", 9000), "value_out_of_range"),
    ("no fraction", body(timestamp="2031-03-05T10:00:00Z"), VALID),
    ("one digit", body(timestamp="2031-03-05T10:00:00.5Z"), VALID),
    ("six digits", body(timestamp="2031-03-05T10:00:00.000000Z"), "invalid_timestamp"),
    ("offset", body(timestamp="2031-03-05T10:00:00.000+00:00"), "invalid_timestamp"),
    ("no zone", body(timestamp="2031-03-05T10:00:00.000"), "invalid_timestamp"),
    ("timestamp empty", body(timestamp=""), "invalid_timestamp"),
    ("epoch text", body(timestamp="1753776000"), "invalid_timestamp"),
    ("epoch number", body(timestamp=1753776000), "invalid_timestamp"),
    ("impossible date", body(timestamp="2026-13-40T99:99:99Z"), "invalid_timestamp"),
    ("leading blank", body(timestamp=" 2031-03-05T10:00:00Z"), "invalid_timestamp"),
    ("several faults", body(drop=["device_id"], timestamp="x", value="y"), "missing_device_id"),
    ("faults after the device", body(timestamp="x", metric_type="y"), "invalid_timestamp"),
    ("faults after the time", body(metric_type="x", value="y"), "invalid_metric_type"),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    raw = literal_messages(spark, [(what, text) for what, text, _ in CASES])
    return {row.device_key: row for row in classify(decode(raw)).collect()}


@pytest.mark.parametrize("what,text,reason", CASES, ids=[case[0] for case in CASES])
def test_reason(outcomes, what, text, reason):
    row = outcomes[what]
    assert row.error_reason == reason
    assert row.is_valid is (reason is None)
    assert row.raw_value == text


ABSENT = object()
FIELDS = {
    # value -> the reason it gives, in order of precedence of the fields
    "device_id": [
        ("dev-5eed0017", None),
        (ABSENT, "missing_device_id"),
        (None, "missing_device_id"),
    ],
    "timestamp": [
        ("2031-03-05T10:00:00.000Z", None),
        ("2031-03-05T10:00:00Z", None),
        (ABSENT, "invalid_timestamp"),
        ("yesterday", "invalid_timestamp"),
    ],
    "metric_type": [
        ("humidity", None),
        ("signal_strength", None),
        ("warp_factor", "invalid_metric_type"),
        (ABSENT, "no metric"),
        (None, "no metric"),
    ],
    "value": [
        (50, {"signal_strength": "value_out_of_range"}),
        (-50.5, {"humidity": "value_out_of_range"}),
        ("-20", {"humidity": "value_out_of_range"}),
        (1e9, {"humidity": "value_out_of_range", "signal_strength": "value_out_of_range"}),
        ("N/A", "missing_or_non_numeric_value"),
        (ABSENT, "missing_or_non_numeric_value"),
        (None, "missing_or_non_numeric_value"),
    ],
}


def test_precedence_over_all_combinations(spark):
    rows, expected = [], {}
    for n, choice in enumerate(itertools.product(*FIELDS.values())):
        fields = {name: value for name, (value, _) in zip(FIELDS, choice) if value is not ABSENT}
        device, stamp, metric, value = (reason for _, reason in choice)
        if metric == "no metric":
            # passes the metric rule, and no range fits
            metric, value = None, value if isinstance(value, str) else "value_out_of_range"
        elif isinstance(value, dict):
            value = value.get(fields["metric_type"])
        expected[str(n)] = device or stamp or metric or value
        rows.append((str(n), json.dumps(fields)))
    outcome = classify(decode(literal_messages(spark, rows)))
    assert {row.device_key: row.error_reason for row in outcome.collect()} == expected
    assert len(expected) == 420 and None in expected.values()


def test_decoded_fields(outcomes):
    row = outcomes["canonical"]
    assert (row.device_id, row.metric_type, row.value) == ("dev-5eed0017", "temperature", -3.25)
    assert (row.site_id, row.firmware_version) == ("quarry-3", "0.9-rc1")
    assert str(row.event_time) == "2025-11-03 04:05:06.789000"
    assert outcomes["value with exponent"].value == 10.0
    assert outcomes["one digit"].event_time.microsecond == 500_000


def test_strict_null_metric(spark):
    rows = [("none", body(drop=["metric_type"])), ("good", body()), ("hot", body(value=1e6))]
    strict = classify(decode(literal_messages(spark, rows)), strict_null_metric=True)
    reasons = {row.device_key: row.error_reason for row in strict.collect()}
    assert reasons == {"none": "invalid_metric_type", "good": None, "hot": "value_out_of_range"}


def test_binary_envelope_without_key(spark):
    raw = literal_messages(spark, [("k", body()), ("k", "{")])
    binary = raw.select(F.col("value").cast("binary").alias("payload"))
    decoded = decode(binary, value_col="payload")
    assert dict(decoded.dtypes)["device_key"] == "string"
    rows = classify(decoded).collect()
    assert [row.device_key for row in rows] == [None, None]
    assert sorted(str(row.error_reason) for row in rows) == ["None", "invalid_json"]
    assert {row.raw_value for row in rows} == {body(), "{"}


def test_event_time_does_not_depend_on_session_zone(spark):
    raw = literal_messages(spark, [("k", body())])
    seen = set()
    for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            seen.add(decode(raw).select(F.unix_micros("event_time")).first()[0])
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen == {1_762_142_706_789_000}


def test_split_keeps_every_row_once(spark):
    raw = literal_messages(spark, [(what, text) for what, text, _ in CASES])
    valid, dead = split(classify(decode(raw)))
    assert tuple(valid.columns) == VALID_COLUMNS
    assert tuple(dead.columns) == DEAD_LETTER_COLUMNS
    good = sum(reason is None for _, _, reason in CASES)
    assert valid.count() == good
    assert dead.count() == len(CASES) - good
    refused = {(row.raw_value, row.error_reason) for row in dead.collect()}
    assert refused == {(text, reason) for _, text, reason in CASES if reason}
    assert dead.where("quarantined_at IS NULL").count() == 0


def test_future_guard(spark):
    rows = [("on time", body(), "2025-11-03T04:05:07"), ("ahead", body(), "2025-11-03T04:00:05")]
    raw = spark.createDataFrame(rows, "key STRING, value STRING, seen STRING")
    decoded = decode(raw.withColumn("seen", F.to_timestamp("seen")), arrival_col="seen")
    plain = {row.device_key: row.error_reason for row in classify(decoded).collect()}
    assert plain == {"on time": None, "ahead": None}
    guarded = classify(decoded, future_tolerance="5 minutes")
    reasons = {row.device_key: row.error_reason for row in guarded.collect()}
    assert reasons == {"on time": None, "ahead": "future_timestamp"}
    with pytest.raises(ValueError):
        classify(decode(raw), future_tolerance="5 minutes")


def test_encode_round_trip(spark):
    events = spark.createDataFrame(
        [("dev-00000001", "2031-03-05T10:00:00Z", "battery", 50.0, None),
         ("dev-00000002", None, "battery", 50.0, "{raw")],
        "device_id STRING, timestamp STRING, metric_type STRING, value DOUBLE, payload STRING",
    )
    messages = {row.key: row.value for row in encode(events, payload_col="payload").collect()}
    assert json.loads(messages["dev-00000001"]) == {
        "device_id": "dev-00000001",
        "timestamp": "2031-03-05T10:00:00Z",
        "metric_type": "battery",
        "value": 50.0,
    }
    assert messages["dev-00000002"] == "{raw"


def test_encode_sends_the_whole_event(spark):
    event = spark.createDataFrame(
        [("dev-00000001", 7.5, "ok", "aside")], "device_id STRING, value DOUBLE, status STRING, note STRING"
    )
    (whole,) = encode(event, keep=("note",)).collect()
    assert json.loads(whole.value) == {"device_id": "dev-00000001", "value": 7.5, "status": "ok"}
    assert (whole.key, whole.note) == ("dev-00000001", "aside")
    (chosen,) = encode(event, fields=("value", "note")).collect()
    assert json.loads(chosen.value) == {"value": 7.5, "note": "aside"}


def test_text_is_parsed_once(spark):
    raw = spark.range(1).selectExpr("'k' AS key", "CAST(id AS STRING) AS value")
    for route in split(classify(decode(raw))):
        plan = route._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1
        assert plan.count("gettimestamp(") <= 1
        assert "Python" not in plan
