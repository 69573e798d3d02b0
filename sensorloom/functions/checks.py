"""Predicates over decoded records, and the rule chain built from them."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom import contract as c
from sensorloom.functions.durations import interval


class Rule(NamedTuple):
    """A reason together with the condition under which it applies."""

    reason: str
    broken: Column


def known_metric(metric: Column) -> Column:
    return metric.isin(*c.METRICS)


def within_limits(metric: Column, value: Column) -> Column:
    """Is the value plausible for its metric?  Both ends count; no metric is false."""
    per_metric = [
        F.when(metric == F.lit(name), value.between(low, high))
        for name, (low, high) in c.METRIC_LIMITS.items()
    ]
    return F.coalesce(*per_metric, F.lit(False))


def rules(
    strict_null_metric: bool = False,
    arrival_col: str | None = None,
    future_tolerance: str | None = None,
) -> list[Rule]:
    """The rule chain over decoded columns, in order of precedence.

    A condition that is null does not apply.  That matters for a record
    without metric_type: membership is unknown, so it falls through to the
    range rule and is reported there.  ``strict_null_metric`` reports it as
    an invalid metric type instead.

    ``future_tolerance`` adds a rule for readings dated later than their
    arrival plus the tolerance: a single one would push the watermark ahead
    and close every open window.
    """
    metric, value = F.col("metric_type"), F.col("value")
    bad_metric = ~known_metric(metric)
    if strict_null_metric:
        bad_metric = F.coalesce(bad_metric, F.lit(True))

    chain = [
        Rule(c.INVALID_JSON, F.col("corrupt_record").isNotNull()),
        Rule(c.MISSING_DEVICE_ID, F.col("device_id").isNull()),
        # null for an absent timestamp as well as for one that does not parse
        Rule(c.INVALID_TIMESTAMP, F.col("event_time").isNull()),
        Rule(c.INVALID_METRIC_TYPE, bad_metric),
        Rule(c.MISSING_OR_NON_NUMERIC_VALUE, value.isNull()),
        Rule(c.VALUE_OUT_OF_RANGE, ~within_limits(metric, value)),
    ]
    if future_tolerance is not None:
        if arrival_col is None:
            raise ValueError("the future guard needs an arrival column")
        latest = F.col(arrival_col) + interval(future_tolerance)
        chain.append(Rule(c.FUTURE_TIMESTAMP, F.col("event_time") > latest))
    return chain


def first_reason(chain: Iterable[Rule]) -> Column:
    """Reason of the first rule that applies, null if none does."""
    return F.coalesce(*[F.when(rule.broken, F.lit(rule.reason)) for rule in chain])
