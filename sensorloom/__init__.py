"""Telemetry analytics on Spark: one set of DataFrame operators for tables and streams."""

from sensorloom.operators.audit import audit_contract
from sensorloom.operators.classify import classify, dead_letters, split, valid_rows
from sensorloom.operators.decode import decode, encode
from sensorloom.operators.dedup import drop_copies_within_watermark, merge_copies
from sensorloom.operators.lateness import late_rows, replay_watermark
from sensorloom.operators.quiet import quiet_periods, quiet_signals
from sensorloom.operators.refused import (
    dead_letter_rate,
    dead_letter_volume,
    replay,
    spikes_against_past,
)
from sensorloom.operators.windows import sliding_by_panes, windowed_aggregates
from sensorloom.plans.pipeline import telemetry_tables
from sensorloom.session import telemetry_session

__all__ = [
    "audit_contract",
    "classify",
    "dead_letter_rate",
    "dead_letter_volume",
    "dead_letters",
    "decode",
    "drop_copies_within_watermark",
    "encode",
    "late_rows",
    "merge_copies",
    "quiet_periods",
    "quiet_signals",
    "replay",
    "replay_watermark",
    "sliding_by_panes",
    "spikes_against_past",
    "split",
    "telemetry_session",
    "telemetry_tables",
    "valid_rows",
    "windowed_aggregates",
]
