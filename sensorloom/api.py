"""The public calls under the names that existing telemetry jobs use.

Only names: every call is the operator of this package that it points to.
"""

from sensorloom.operators.classify import classify as classify_events
from sensorloom.operators.classify import split as split_valid_and_malformed
from sensorloom.operators.decode import decode as parse_kafka_value
from sensorloom.operators.windows import windowed_aggregates as compute_windowed_aggregates
from sensorloom.plans.pipeline import telemetry_tables as build_bronze_and_aggregates
from sensorloom.session import telemetry_session as get_or_create_spark

__all__ = [
    "build_bronze_and_aggregates",
    "classify_events",
    "compute_windowed_aggregates",
    "get_or_create_spark",
    "parse_kafka_value",
    "split_valid_and_malformed",
]
