"""Wire contract of a telemetry reading: names, limits, reasons, schemas.

A reading travels as one JSON object keyed by its device.  Everything in this
module is plain data, so that the operators can be written against names
instead of literals.
"""

from __future__ import annotations

# They have to match what devices send and what readers of the
# result tables expect.
REQUIRED_FIELDS = ("device_id", "timestamp", "metric_type", "value")
OPTIONAL_FIELDS = ("site_id", "firmware_version")
WIRE_FIELDS = REQUIRED_FIELDS + OPTIONAL_FIELDS

METRIC_LIMITS: dict[str, tuple[float, float]] = {
    "temperature": (-40.0, 85.0),
    "humidity": (0.0, 100.0),
    "battery": (0.0, 100.0),
    "signal_strength": (-130.0, -20.0),
}
METRICS = tuple(METRIC_LIMITS)

DEVICE_ID_PATTERN = "^dev-[0-9a-fA-F]{8}$"
DATE_TIME_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
)

# The same as a schema document, for the audit.
TELEMETRY_DOCUMENT = {
    "type": "object",
    "required": list(REQUIRED_FIELDS),
    "additionalProperties": False,
    "properties": {
        "device_id": {"type": "string", "pattern": DEVICE_ID_PATTERN},
        "timestamp": {"type": "string", "format": "date-time"},
        "metric_type": {"type": "string", "enum": list(METRICS)},
        "value": {"type": "number"},
        **{name: {"type": "string"} for name in OPTIONAL_FIELDS},
    },
}

# The zone letter is parsed as a zone (X), so the instant does not depend on
# the session time zone; the fraction is optional.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSS]X"
EVENT_TIME_SUFFIX = "Z"

# Why a record was refused, most fundamental first; a record gets the first
# one that applies.
INVALID_JSON = "invalid_json"
MISSING_DEVICE_ID = "missing_device_id"
INVALID_TIMESTAMP = "invalid_timestamp"
INVALID_METRIC_TYPE = "invalid_metric_type"
MISSING_OR_NON_NUMERIC_VALUE = "missing_or_non_numeric_value"
VALUE_OUT_OF_RANGE = "value_out_of_range"
REASONS = (
    INVALID_JSON,
    MISSING_DEVICE_ID,
    INVALID_TIMESTAMP,
    INVALID_METRIC_TYPE,
    MISSING_OR_NON_NUMERIC_VALUE,
    VALUE_OUT_OF_RANGE,
)
# Only given when the future guard is switched on.
FUTURE_TIMESTAMP = "future_timestamp"

CORRUPT_RECORD = "_corrupt_record"

# All fields are read as text.  A typed field that does not fit makes the
# parser report the whole record as corrupt, and "value": "N/A" would look
# like broken JSON.
RECORD_SCHEMA = ", ".join(f"`{name}` STRING" for name in (*WIRE_FIELDS, CORRUPT_RECORD))

VALID_COLUMNS = (
    "device_id",
    "event_time",
    "metric_type",
    "value",
    "site_id",
    "firmware_version",
)
DEAD_LETTER_COLUMNS = ("raw_value", "device_id", "error_reason", "quarantined_at")
AGGREGATE_COLUMNS = (
    "window_start",
    "window_end",
    "device_id",
    "metric_type",
    "avg_value",
    "event_count",
    "min_value",
    "max_value",
)

# Schemas of the stored tables, for readers that must not infer them.
VALID_SCHEMA = (
    "device_id STRING, event_time TIMESTAMP, metric_type STRING, value DOUBLE, "
    "site_id STRING, firmware_version STRING"
)
DEAD_LETTER_SCHEMA = (
    "raw_value STRING, device_id STRING, error_reason STRING, quarantined_at TIMESTAMP"
)
AGGREGATE_SCHEMA = (
    "window_start TIMESTAMP, window_end TIMESTAMP, device_id STRING, metric_type STRING, "
    "avg_value DOUBLE, event_count BIGINT, min_value DOUBLE, max_value DOUBLE"
)
# Readings as JSON lines; the time is text there and is cast after reading.
READING_LINES_SCHEMA = VALID_SCHEMA.replace("event_time TIMESTAMP", "event_time STRING")

# A redelivered event carries no id of its own; these fields identify it.
EVENT_KEY = ("device_id", "metric_type", "event_time", "value")
