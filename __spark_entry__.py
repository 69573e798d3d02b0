"""

The ``events`` table is turned into telemetry messages first.  Each user is a
device and each event type a metric; the remainder of the event id decides
which messages carry a fault, so the SQL can tell the expected outcome from the
id and the raw columns without reading any JSON.  All rows are used throughout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import sensorloom as sl
from sensorloom.contract import AGGREGATE_SCHEMA, VALID_SCHEMA
from sensorloom.functions.durations import interval
from sensorloom.operators.audit import audit_by_document
from sensorloom.operators.event_store import append_new_events, stored_events
from sensorloom.operators.quiet import quiet_signals_with_heartbeat
from sensorloom.operators.refused import spikes_on_stream
from sensorloom.operators.replay_ledger import replay_once as replay_run
from sensorloom.operators.replay_ledger import replayed
from sensorloom.plans import kept_reports, reports
from sensorloom.session import heartbeat_session, new_folder, stream_session
from sensorloom.sources.streams import envelope_stream, read_results, reading_lines_stream
from sensorloom.streaming.compacted import compact_table, read_compacted
from sensorloom.streaming.job import JobSettings, start_queries
from sensorloom.streaming.late_table import append_late_rows, read_late_rows
from sensorloom.streaming.metrics import recent_progress
from sensorloom.streaming.open_windows import open_windows
from sensorloom.streaming.sinks import append_to_parquet
from sensorloom.streaming.staged import VALID, staged_stream, start_stage, start_staged_queries
from sensorloom.streaming.upserts import read_upserts, upsert_writer

# --------------------------------------------------------------------------
# Test data: events -> messages

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)
METRIC_OF = {
    "click": "temperature",
    "view": "humidity",
    "purchase": "battery",
    "signup": "signal_strength",
    "error": "fault_code",
}
# Faults by remainder of the event id; the other remainders are sent as they are.
FAULT_CYCLE = 40
(
    NO_DEVICE,
    BAD_TIME,
    NO_TIME,
    NO_METRIC,
    TEXT_VALUE,
    CUT_SHORT,
    NO_VALUE,
    HUGE_VALUE,
    WHOLE_SECONDS,
    QUOTED_VALUE,
    EXTRA_PROPERTY,
    ODD_ID,
    IN_ARRAY,
    EMPTY,
    TWICE,
    SINGLE_QUOTES,
) = range(16)


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _messages(events: DataFrame) -> DataFrame:
    """(key, value, arrival_time): late by 20 minutes or 3 hours now and then."""
    fault = F.col("event_id") % FAULT_CYCLE

    def unless(kinds: tuple[int, ...], col: Column) -> Column:
        return F.when(~fault.isin(*kinds), col)

    metric = F.coalesce(
        *[F.when(F.col("event_type") == k, F.lit(v)) for k, v in METRIC_OF.items()]
    )
    reading = F.when(
        F.col("event_type") == "signup", F.round(F.lit(-20) - F.col("value"), 2)
    ).otherwise(F.col("value"))
    taken = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    stamp = (
        F.when(fault == BAD_TIME, F.lit("not-a-timestamp"))
        .when(fault == WHOLE_SECONDS, F.concat(F.substring(taken, 1, 19), F.lit("Z")))
        .otherwise(taken)
    )
    user = F.col("user_id")
    lag = (
        F.when(F.col("event_id") % 25 == 0, interval("3 hours"))
        .when(F.col("event_id") % 10 == 0, interval("20 minutes"))
        .otherwise(interval("0 seconds"))
    )
    device = F.concat(F.lit("dev-"), F.lpad(F.lower(F.hex(user)), 8, "0"))
    fields = events.select(
        device.alias("sender"),
        unless((NO_DEVICE,), F.when(fault == ODD_ID, F.concat(F.lit("unit-"), user))
               .otherwise(device)).alias("device_id"),
        unless((NO_TIME,), stamp).alias("timestamp"),
        unless((NO_METRIC,), metric).alias("metric_type"),
        unless((NO_VALUE,), F.when(fault == HUGE_VALUE, F.lit(9000.0)).otherwise(reading))
        .alias("value"),
        F.concat(F.lit("site-0"), user % 10).alias("site_id"),
        F.concat(F.lit("1.4."), user % 5).alias("firmware_version"),
        unless(tuple(k for k in range(FAULT_CYCLE) if k != EXTRA_PROPERTY), F.lit("ok"))
        .alias("status"),
        fault.alias("fault"),
        (F.col("ts").cast("timestamp") + lag).alias("arrival_time"),
    )

    def text(value: Column) -> Column:
        parts = ("site_id", "firmware_version")
        return F.to_json(
            F.struct("device_id", "timestamp", "metric_type", value.alias("value"), *parts)
        )

    plain = F.col("value")
    payload = (
        F.when(F.col("fault") == TEXT_VALUE, text(F.lit("N/A")))
        .when(F.col("fault") == CUT_SHORT, F.substring(text(plain), 1, 20))
        .when(F.col("fault") == QUOTED_VALUE, text(plain.cast("string")))
        .when(F.col("fault") == IN_ARRAY, F.concat(F.lit("["), text(plain), F.lit("]")))
        .when(F.col("fault") == EMPTY, F.lit(""))
        .when(F.col("fault") == TWICE, F.concat(
            F.regexp_replace(text(plain), r"\}$", ""), F.lit(',"site_id":"'), "site_id", F.lit('"}')
        ))
        .when(F.col("fault") == SINGLE_QUOTES, F.replace(text(plain), F.lit('"'), F.lit("'")))
    )
    prepared = fields.withColumn("payload", payload).withColumnRenamed("sender", "key")
    sent = ("device_id", "timestamp", "metric_type", "value", "site_id", "firmware_version", "status")
    return sl.encode(
        prepared, key_col="key", payload_col="payload", keep=("arrival_time",), fields=sent
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(_read(spark, sf_dir))


def message_stream(session: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages, from a file stream over the table.

    A stream takes a single file only by a pattern; this one matches the table,
    be it a file or a folder.
    """
    reader = session.readStream.schema(EVENTS_SCHEMA)
    return _messages(reader.parquet(f"{sf_dir}/[e]vents.parquet"))


def _decoded(raw: DataFrame) -> DataFrame:
    return sl.decode(raw, arrival_col="arrival_time")


def _classified(raw: DataFrame, **options) -> DataFrame:
    return sl.classify(_decoded(raw), **options)


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sl.valid_rows(_classified(messages(spark, sf_dir)))


def _dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sl.dead_letters(_classified(messages(spark, sf_dir)))


def _with_copies(valid: DataFrame, relayed: bool = False) -> DataFrame:
    """Every reading one to three times, by device; ``relayed`` marks the site of each copy."""
    copies = F.pmod(F.crc32(F.col("device_id")), F.lit(3)) + 1
    copied = valid.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    if relayed:
        copied = copied.withColumn("site_id", F.concat_ws("/", "site_id", "copy"))
    return copied.drop("copy")


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as DuckDB has them; the session is in UTC."""
    return df.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Cut sums of floats to digits that do not depend on the order of addition."""
    return df.withColumns({name: F.round(name, 6) for name in names})


# --------------------------------------------------------------------------
# Queries over the table


def encode(spark, sf_dir):
    return messages(spark, sf_dir).select("key", "value")


def decode(spark, sf_dir):
    return _plain_times(_decoded(messages(spark, sf_dir)))


def classify_reasons(spark, sf_dir):
    kept = ("device_key", "raw_value", "error_reason", "is_valid")
    return _classified(messages(spark, sf_dir)).select(*kept)


def classify_strict(spark, sf_dir):
    strict = _classified(messages(spark, sf_dir), strict_null_metric=True)
    return strict.groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))


def foreign_text(spark, sf_dir):
    """Whole texts that are no readings, sent as messages: all refused, none changed."""
    texts = {"documents": "text", "conversations": "text", "pages": "html", "events": "props"}
    raw = None
    for table, column in texts.items():
        sent = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(
            F.lit(table).alias("key"), F.col(column).alias("value")
        )
        raw = sent if raw is None else raw.unionByName(sent)
    refused = sl.classify(sl.decode(raw)).where("NOT is_valid")
    return refused.select("device_key", "error_reason", F.md5("raw_value").alias("text_hash"))


def _clocks_ahead(raw: DataFrame) -> DataFrame:
    """Arrival is set back by two days for one device in ten, whose clocks then run ahead."""
    early = F.when(F.col("key").endswith("5"), F.col("arrival_time") - interval("2 days"))
    return raw.withColumn("arrival_time", F.coalesce(early, "arrival_time"))


def future_guard(spark, sf_dir):
    guarded = _classified(_clocks_ahead(messages(spark, sf_dir)), future_tolerance="1 hour")
    return guarded.groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))


def valid_rows(spark, sf_dir):
    return _plain_times(_valid(spark, sf_dir))


def dead_letters(spark, sf_dir):
    return _dead(spark, sf_dir).drop("quarantined_at")


def whole_chain(spark, sf_dir):
    """All three tables of the chain, as totals that have to add up."""
    raw = messages(spark, sf_dir)
    routes = reports.route_totals(sl.classify(sl.decode(raw)))
    aggregated = sl.telemetry_tables(raw, "1 hour")["aggregates"].agg(
        F.sum("event_count").alias("total")
    )
    return routes.unionByName(aggregated.select(F.lit("aggregated").alias("name"), "total"))


def guarded_chain(spark, sf_dir):
    """The chain with the future guard on, against clocks that run ahead by two days."""
    raw = _clocks_ahead(messages(spark, sf_dir))
    tables = sl.telemetry_tables(
        raw, "1 hour", arrival_col="arrival_time", future_tolerance="1 hour"
    )
    kept = tables["aggregates"].agg(F.sum("event_count").alias("n"))
    return kept.select(F.lit("aggregated").alias("name"), "n").unionByName(
        reports.reason_breakdown(tables["dead_letter"]).withColumnRenamed("error_reason", "name")
    )


def binary_envelope(spark, sf_dir):
    """Messages as a broker hands them over: bytes, and no key."""
    raw = messages(spark, sf_dir).select(F.encode("value", "UTF-8").alias("value"))
    return _plain_times(sl.decode(raw))


def _windows(duration: str, slide: str | None = None):
    def query(spark, sf_dir):
        valid = _valid(spark, sf_dir)
        return _plain_times(sl.windowed_aggregates(valid, duration, slide_duration=slide))

    return query


tumbling_minute = _windows("1 minute")
tumbling_hour_device = _windows("1 hour")
tumbling_day = _windows("1 day")
sliding = _windows("1 day", "6 hours")


def sliding_panes(spark, sf_dir):
    return _plain_times(sl.sliding_by_panes(_valid(spark, sf_dir), "1 day", "6 hours"))


def _day_aggregates(spark, sf_dir):
    return sl.windowed_aggregates(_valid(spark, sf_dir), "1 day")


def total_rows(spark, sf_dir):
    aggregates = reports.total_rows(_day_aggregates(spark, sf_dir))
    dead = reports.total_rows(_dead(spark, sf_dir))
    return aggregates.select(F.lit("aggregates").alias("name"), "total").unionByName(
        dead.select(F.lit("dead_letter").alias("name"), "total")
    )


def metric_rollup(spark, sf_dir):
    return _rounded(reports.metric_rollup(_day_aggregates(spark, sf_dir)), "overall_avg")


def weighted_rollup(spark, sf_dir):
    return _rounded(reports.weighted_rollup(_day_aggregates(spark, sf_dir)), "weighted_avg")


def recent_windows(spark, sf_dir):
    return _plain_times(reports.recent_windows(_day_aggregates(spark, sf_dir), 20))


def recent_dead_letters(spark, sf_dir):
    """The latest refused records, stamped with their arrival."""
    return _plain_times(reports.recent_dead_letters(_stamped(spark, sf_dir), 20))


def reason_breakdown(spark, sf_dir):
    return reports.reason_breakdown(_dead(spark, sf_dir))


def contract_audit(spark, sf_dir):
    audited = sl.audit_contract(messages(spark, sf_dir))
    return audited.select("key", "value", F.array_join("violations", ",").alias("violations"))


#: A document with an object and an array in it, for orders that are sent as messages.
ORDER_DOCUMENT = {
    "type": "object",
    "required": ["id", "status", "clerk"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 1},
        "status": {"type": "string", "enum": ["O", "F"]},
        "clerk": {"type": "string"},
        "order": {
            "type": "object",
            "required": ["total"],
            "additionalProperties": False,
            "properties": {
                "total": {"type": "number", "exclusiveMaximum": 200000},
                "on": {"type": "string", "format": "date"},
            },
        },
        "tags": {"type": "array", "maxItems": 2, "items": {"type": "string", "pattern": "^[1-4]"}},
    },
}


def document_audit(spark, sf_dir):
    """Orders as nested messages, against a document of their own."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key = F.col("o_orderkey")
    inner = F.struct(
        F.when(key % 7 != 0, F.col("o_totalprice").cast("double")).alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("on"),
        F.when(key % 11 == 0, key).alias("extra"),
    )
    tags = F.when(key % 5 == 0, F.array_repeat("o_orderpriority", 3)).otherwise(F.array("o_orderpriority"))
    message = F.to_json(
        F.struct(
            key.alias("id"),
            F.col("o_orderstatus").alias("status"),
            F.when(key % 13 != 0, F.lit("clerk")).alias("clerk"),
            F.when(key % 3 != 0, inner).alias("order"),
            tags.alias("tags"),
        )
    )
    audited = audit_by_document(orders.select(key, message.alias("value")), ORDER_DOCUMENT)
    return audited.select("o_orderkey", F.array_join("violations", ",").alias("violations"))


def dedup(spark, sf_dir):
    return _plain_times(sl.merge_copies(_with_copies(_valid(spark, sf_dir)), keys=None))


def dedup_by_key(spark, sf_dir):
    """Copies differ in the site that relayed them; the event key alone decides."""
    return _plain_times(sl.merge_copies(_with_copies(_valid(spark, sf_dir), relayed=True)))


def dedup_windows(spark, sf_dir):
    once = sl.merge_copies(_with_copies(_valid(spark, sf_dir)))
    return _plain_times(sl.windowed_aggregates(once, "1 hour"))


def quiet_devices(spark, sf_dir):
    return _plain_times(sl.quiet_periods(_valid(spark, sf_dir), "12 hours"))


def quiet_devices_now(spark, sf_dir):
    """Also those still silent at the last reading of the fleet."""
    return _plain_times(sl.quiet_periods(_valid(spark, sf_dir), "12 hours", at_end=True))


def _arrivals(spark, sf_dir):
    """Valid rows with their arrival time, stored once, so that the audit parses nothing."""
    path = new_folder(spark, "arrivals")
    valid = sl.valid_rows(_classified(messages(spark, sf_dir)), with_arrival=True)
    valid.write.parquet(path)
    columns = ("device_id", "metric_type", "value", "event_time", "arrival_time")
    return spark.read.schema(valid.schema).parquet(path).select(*columns)


def watermark_replay(spark, sf_dir):
    replayed = sl.replay_watermark(_arrivals(spark, sf_dir), "5 minutes", "30 minutes", "1 hour")
    return _plain_times(replayed)


def late_rows(spark, sf_dir):
    late = sl.late_rows(_arrivals(spark, sf_dir), "5 minutes", "30 minutes")
    return _plain_times(late)


def _stamped(spark, sf_dir):
    refused = _classified(messages(spark, sf_dir)).where("NOT is_valid")
    return refused.withColumnRenamed("arrival_time", "quarantined_at")


def dead_letter_volume(spark, sf_dir):
    return _plain_times(sl.dead_letter_volume(_stamped(spark, sf_dir), "6 hours"))


def _rates(spark, sf_dir):
    return sl.dead_letter_rate(_classified(messages(spark, sf_dir)), "6 hours", alert_rate=0.5)


def dead_letter_rate(spark, sf_dir):
    return _plain_times(_rounded(_rates(spark, sf_dir), "rate"))


def dead_letter_spikes(spark, sf_dir):
    spikes = sl.spikes_against_past(_rates(spark, sf_dir), "6 hours", lookback=4, factor=1.2)
    return _plain_times(_rounded(spikes, "rate", "past_rate"))


def _mended(letters: DataFrame) -> DataFrame:
    """The fix before the replay: fault codes are read as temperatures, arrays are opened."""
    renamed = F.replace("raw_value", F.lit('"fault_code"'), F.lit('"temperature"'))
    opened = F.regexp_extract(renamed, r"^\[(.*)\]$", 1)
    return letters.withColumn(
        "raw_value", F.when(renamed.startswith("["), opened).otherwise(renamed)
    )


def replay(spark, sf_dir):
    valid, _ = sl.replay(_dead(spark, sf_dir), _mended)
    return _plain_times(valid)


def replay_still_refused(spark, sf_dir):
    _, still = sl.replay(_dead(spark, sf_dir), _mended)
    return reports.reason_breakdown(still)


# --------------------------------------------------------------------------
# Queries that run a stream over the table to its end


def _closed(spark, sf_dir, build):
    """Run ``build`` on the stream, append to a new table, and read that."""
    session = stream_session(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    folder = new_folder(spark, "stream")
    stream = build(_classified(message_stream(session, sf_dir)))
    query = append_to_parquet(stream, f"{folder}/table", f"{folder}/checkpoint", None)
    query.awaitTermination()
    return _plain_times(read_results(spark, f"{folder}/table")), query


def stream_windows(spark, sf_dir):
    def build(classified):
        return sl.windowed_aggregates(sl.valid_rows(classified), "1 hour", "2 hours")

    return _closed(spark, sf_dir, build)[0]


def stream_sliding(spark, sf_dir):
    def build(classified):
        return sl.windowed_aggregates(sl.valid_rows(classified), "1 day", "2 hours", "6 hours")

    return _closed(spark, sf_dir, build)[0]


def stream_dead_letters(spark, sf_dir):
    return _closed(spark, sf_dir, sl.dead_letters)[0].drop("quarantined_at")


def stream_dedup(spark, sf_dir):
    def build(classified):
        copied = _with_copies(sl.valid_rows(classified))
        return sl.windowed_aggregates(copied, "1 hour", "2 hours", count_copies=False)

    return _closed(spark, sf_dir, build)[0]


MESSAGE_SCHEMA = "key STRING, value STRING, arrival_time TIMESTAMP"
#: Days of arrival at which the message stream is cut into parts that come one by one.
PART_DAYS = ("2024-01-06", "2024-01-11", "2024-01-16", "2024-01-21", "2024-01-26")


def _parts(raw, folder):
    """Put the messages into an inbox part by part; a stream over it sees one more each time."""
    spark = raw.sparkSession
    days = [F.lit(day).cast("timestamp") for day in PART_DAYS]
    part = sum((F.col("arrival_time") >= day).cast("int") for day in days)
    # Each task writes its own rows of every part; dealt by part, six tasks would write all.
    raw.withColumn("part", part).write.partitionBy("part").parquet(f"{folder}/sent")
    for number in range(len(PART_DAYS) + 1):
        whole = spark.read.schema(MESSAGE_SCHEMA).parquet(f"{folder}/sent").where(F.col("part") == number)
        whole.drop("part").write.mode("append").parquet(f"{folder}/inbox")
        yield number


def _in_parts(spark, sf_dir, build):
    """As ``_closed``, with messages that come in parts, over one checkpoint."""
    session = stream_session(spark)
    folder = new_folder(spark, "parts")
    for _ in _parts(messages(spark, sf_dir), folder):
        stream = envelope_stream(session, f"{folder}/inbox", MESSAGE_SCHEMA)
        append_to_parquet(
            build(_classified(stream)), f"{folder}/table", f"{folder}/checkpoint", None
        ).awaitTermination()
    return _plain_times(read_results(spark, f"{folder}/table", AGGREGATE_SCHEMA))


def stream_late_rows(spark, sf_dir):
    """Late rows within the delay count in their window; those of closed windows are dropped."""

    def build(classified):
        return sl.windowed_aggregates(sl.valid_rows(classified), "1 hour", "10 minutes")

    return _in_parts(spark, sf_dir, build)


def stream_dedup_late(spark, sf_dir):
    """Copies and late rows together: the same windows as those of distinct rows."""

    def build(classified):
        copied = _with_copies(sl.valid_rows(classified))
        return sl.windowed_aggregates(copied, "1 hour", "10 minutes", count_copies=False)

    return _in_parts(spark, sf_dir, build)


def stream_first_copies(spark, sf_dir):
    def build(classified):
        return sl.drop_copies_within_watermark(_with_copies(sl.valid_rows(classified)), "2 hours")

    return _closed(spark, sf_dir, build)[0]


def stream_quiet_devices(spark, sf_dir):
    def build(classified):
        return sl.quiet_signals(sl.valid_rows(classified), "12 hours", "2 hours")

    return _closed(spark, sf_dir, build)[0]


def stream_dead_letter_rate(spark, sf_dir):
    def build(classified):
        return sl.dead_letter_rate(classified, "6 hours", 0.5, "2 hours")

    return _rounded(_closed(spark, sf_dir, build)[0], "rate")


def stream_spikes(spark, sf_dir):
    def build(classified):
        return spikes_on_stream(classified, "6 hours", lookback=4, factor=1.2, watermark_delay="2 hours")

    return _rounded(_closed(spark, sf_dir, build)[0], "rate", "past_rate")


def stream_compacted(spark, sf_dir):
    """Valid rows appended part by part, compacted after each but the last."""
    session = stream_session(spark)
    folder = new_folder(spark, "compacted")
    table, kept, schema = f"{folder}/table", f"{folder}/compacted", f"{VALID_SCHEMA}, date DATE"
    for number in _parts(messages(spark, sf_dir), folder):
        valid = sl.valid_rows(_classified(envelope_stream(session, f"{folder}/inbox", MESSAGE_SCHEMA)))
        append_to_parquet(
            valid, table, f"{folder}/checkpoint", None, date_from="event_time"
        ).awaitTermination()
        if number < len(PART_DAYS):
            compact_table(spark, table, kept, schema, ["date"], fan=3)
    return _plain_times(read_compacted(spark, table, kept, schema).drop("date"))


def stream_metrics(spark, sf_dir):
    def build(classified):
        return sl.windowed_aggregates(sl.valid_rows(classified), "1 day", "2 hours")

    _, query = _closed(spark, sf_dir, build)
    return recent_progress(spark, query).agg(
        F.sum("input_rows").alias("input_rows"),
        F.max_by("state_rows", "batch_id").alias("open_groups"),
        F.sum("dropped_rows").alias("dropped_rows"),
    )


def _job(spark, folder):
    return JobSettings(
        output_path=f"{folder}/aggregates",
        dead_letter_path=f"{folder}/dead_letter",
        checkpoint_path=f"{folder}/checkpoint",
        stage_path=f"{folder}/staged",
        window_duration="1 day",
        watermark_delay="2 hours",
        tables_by_date=True,
        files_per_batch=2,
        future_tolerance="1 hour",
    )


def _job_totals(spark, settings):
    aggregates = read_results(spark, settings.output_path)
    dead = read_results(spark, settings.dead_letter_path)
    return (
        aggregates.groupBy(F.col("metric_type").alias("name"))
        .agg(F.count(F.lit(1)).alias("table_rows"), F.sum("event_count").alias("messages"))
        .unionByName(
            dead.groupBy(F.col("error_reason").alias("name")).agg(
                F.count(F.lit(1)).alias("table_rows"), F.count(F.lit(1)).alias("messages")
            )
        )
    )


def stream_two_queries(spark, sf_dir):
    """The job as it runs live: two queries, two tables, two checkpoints."""
    settings = _job(spark, new_folder(spark, "job"))
    raw = message_stream(stream_session(spark), sf_dir)
    for query in start_queries(raw, settings, until_done=True, arrival_col="arrival_time"):
        query.awaitTermination()
    return _job_totals(spark, settings)


def stream_staged_queries(spark, sf_dir):
    """The same tables with one read and one parse, over a staged table."""
    settings = _job(spark, new_folder(spark, "staged_job"))
    raw = message_stream(stream_session(spark), sf_dir)
    for query in start_staged_queries(raw, settings, until_done=True, arrival_col="arrival_time"):
        query.awaitTermination()
    return _job_totals(spark, settings)


def _slow_devices(raw: DataFrame) -> DataFrame:
    """Devices whose key ends with 5 send a day late."""
    late = F.when(F.col("key").endswith("5"), F.col("arrival_time") + interval("1 day"))
    return raw.withColumn("arrival_time", F.coalesce(late, "arrival_time"))


def stream_late_table(spark, sf_dir):
    """The rows that hour windows drop as late, written batch by batch."""
    session = stream_session(spark)
    folder = new_folder(spark, "late")
    for _ in _parts(_slow_devices(messages(spark, sf_dir)), folder):
        inbox = envelope_stream(session, f"{folder}/inbox", MESSAGE_SCHEMA)
        start_stage(
            inbox, f"{folder}/staged", f"{folder}/stage", None, arrival_col="arrival_time"
        ).awaitTermination()
        valid = staged_stream(session, f"{folder}/staged", VALID)
        windows = sl.windowed_aggregates(valid, "1 hour", "10 minutes")
        append_to_parquet(windows, f"{folder}/table", f"{folder}/checkpoint", None).awaitTermination()
        append_late_rows(spark, f"{folder}/staged", f"{folder}/checkpoint", f"{folder}/late", "1 hour")
    return _plain_times(read_late_rows(spark, f"{folder}/late").drop("batch_id"))


def stream_open_windows(spark, sf_dir):
    """Every window once: emitted ones from the table, open ones from the state."""
    session = stream_session(spark)
    folder = new_folder(spark, "open")
    valid = sl.valid_rows(_classified(message_stream(session, sf_dir)))
    windows = sl.windowed_aggregates(valid, "1 day", "2 hours")
    append_to_parquet(windows, f"{folder}/table", f"{folder}/checkpoint", None).awaitTermination()
    emitted = read_results(spark, f"{folder}/table").withColumn("is_open", F.lit(False))
    held = open_windows(spark, f"{folder}/checkpoint").withColumn("is_open", F.lit(True))
    return _plain_times(emitted.unionByName(held))


def stream_silent_fleet(spark, sf_dir):
    """All devices stop at the end of the table; hourly ticks go on for three days."""
    session = heartbeat_session(spark)
    folder = new_folder(spark, "silent")
    ends = _valid(spark, sf_dir).agg(F.min("event_time").alias("a"), F.max("event_time").alias("b"))
    ticks = ends.select(
        F.explode(F.sequence("a", F.col("b") + interval("3 days"), interval("1 hour"))).alias("timestamp")
    )
    ticks.write.parquet(f"{folder}/ticks")
    heartbeats = session.readStream.schema("timestamp TIMESTAMP").parquet(f"{folder}/ticks")
    valid = sl.valid_rows(_classified(message_stream(session, sf_dir)))
    signals = quiet_signals_with_heartbeat(valid, heartbeats, "12 hours", "2 hours", "1 day")
    append_to_parquet(signals, f"{folder}/table", f"{folder}/checkpoint", None).awaitTermination()
    return _plain_times(read_results(spark, f"{folder}/table"))


def replay_once(spark, sf_dir):
    """Letters replayed as they come in, and all of them twice more: each counts once."""
    folder = new_folder(spark, "replay")
    path = f"{folder}/letters"
    _stamped(spark, sf_dir).select("raw_value", "device_id", "error_reason", "quarantined_at").write.parquet(path)
    letters = spark.read.parquet(path)
    for until in ("2024-01-11", "2024-01-21", "2025-01-01", "2025-01-01"):
        replay_run(letters.where(F.col("quarantined_at") < F.lit(until).cast("timestamp")), folder, _mended)
    return _plain_times(replayed(spark, folder))


def late_copies(spark, sf_dir):
    """Copies of the first days come with the readings of the last ones, and then all once more."""
    folder = new_folder(spark, "event_store")
    copied = _with_copies(_valid(spark, sf_dir), relayed=True)
    early = F.col("event_time") < F.lit("2024-01-16").cast("timestamp")
    first = early & (F.substring_index("site_id", "/", -1) == "1")
    for batch in (copied.where(first), copied.where(~first), copied):
        append_new_events(batch, folder)
    return _plain_times(stored_events(spark, folder))


def stream_restart(spark, sf_dir):
    """JSON lines arrive in two parts; the second run goes on from the checkpoint."""
    session = stream_session(spark)
    folder = new_folder(spark, "restart")
    lines = _valid(spark, sf_dir).withColumn(
        "event_time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    )
    first = F.col("event_time") < "2024-01-16"
    for part in (first, ~first):
        lines.where(part).write.mode("append").json(f"{folder}/lines")
        stream = reading_lines_stream(session, f"{folder}/lines")
        aggregates = sl.windowed_aggregates(stream, "1 hour", "2 hours")
        append_to_parquet(
            aggregates, f"{folder}/table", f"{folder}/checkpoint", None
        ).awaitTermination()
    return _plain_times(read_results(spark, f"{folder}/table"))


def _stored_valid(spark, sf_dir, folder):
    """Valid rows, stored once, so that batches over them parse nothing."""
    _valid(spark, sf_dir).write.parquet(f"{folder}/valid")
    return spark.read.schema(VALID_SCHEMA).parquet(f"{folder}/valid")


def upserts(spark, sf_dir):
    """Day windows as an update-mode query hands them over: hour by hour, with one compaction.

    Batches 3 and 9 are written again, before and after the compaction.
    """
    folder = new_folder(spark, "upserts")
    valid = _stored_valid(spark, sf_dir, folder)
    write = upsert_writer(folder, files_per_batch=2, compact_every=6)
    for batch_id in (0, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9, 3, 9):
        seen = valid.where(F.hour("event_time") * 10 < 24 * (batch_id + 1))
        write(sl.windowed_aggregates(seen, "1 day"), batch_id)
    return _plain_times(read_upserts(spark, folder))


def _kept_windows(spark, sf_dir):
    """Reports over day windows, kept through ten batches; two batches are written again."""
    folder = new_folder(spark, "kept")
    valid = _stored_valid(spark, sf_dir, folder)
    for batch_id in (0, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9, 9):
        # Of the windows seen so far, those that the batch's hours have changed.
        seen = valid.where(F.hour("event_time") * 10 < 24 * (batch_id + 1))
        fresh = seen.where(F.hour("event_time") * 10 >= 24 * batch_id)
        changed = fresh.select(
            F.window("event_time", "1 day")["start"].alias("window_start"), "device_id", "metric_type"
        ).distinct()
        changes = sl.windowed_aggregates(seen, "1 day").join(
            changed, ["window_start", "device_id", "metric_type"], "left_semi"
        )
        kept_reports.keep_window_reports(changes, batch_id, folder, compact_every=4)
    return folder


def kept_rollup(spark, sf_dir):
    rollup = kept_reports.kept_rollup(spark, _kept_windows(spark, sf_dir))
    return _rounded(rollup, "overall_avg", "weighted_avg")


def kept_recent_windows(spark, sf_dir):
    return _plain_times(kept_reports.kept_recent_windows(spark, _kept_windows(spark, sf_dir)))


def _kept_letters(spark, sf_dir):
    folder = new_folder(spark, "kept")
    path = f"{folder}/letters"
    _stamped(spark, sf_dir).select("raw_value", "device_id", "error_reason", "quarantined_at").write.parquet(path)
    letters = spark.read.parquet(path)
    for batch_id in (0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9):
        batch = letters.where(F.floor(F.hour("quarantined_at") * 10 / 24) == batch_id)
        kept_reports.keep_letter_reports(batch, batch_id, folder)
    return folder


def kept_breakdown(spark, sf_dir):
    return kept_reports.kept_breakdown(spark, _kept_letters(spark, sf_dir))


def kept_recent_letters(spark, sf_dir):
    return _plain_times(kept_reports.kept_recent_letters(spark, _kept_letters(spark, sf_dir)))


_QUERIES = (
    encode,
    decode,
    classify_reasons,
    classify_strict,
    foreign_text,
    future_guard,
    valid_rows,
    dead_letters,
    whole_chain,
    guarded_chain,
    binary_envelope,
    total_rows,
    metric_rollup,
    weighted_rollup,
    recent_windows,
    recent_dead_letters,
    reason_breakdown,
    contract_audit,
    document_audit,
    dedup,
    dedup_by_key,
    dedup_windows,
    quiet_devices,
    quiet_devices_now,
    watermark_replay,
    late_rows,
    dead_letter_volume,
    dead_letter_rate,
    dead_letter_spikes,
    replay,
    replay_still_refused,
    replay_once,
    late_copies,
    stream_windows,
    stream_sliding,
    stream_dead_letters,
    stream_dedup,
    stream_late_rows,
    stream_dedup_late,
    stream_first_copies,
    stream_quiet_devices,
    stream_dead_letter_rate,
    stream_spikes,
    stream_compacted,
    stream_metrics,
    stream_two_queries,
    stream_staged_queries,
    stream_late_table,
    stream_open_windows,
    stream_silent_fleet,
    stream_restart,
    upserts,
    kept_rollup,
    kept_recent_windows,
    kept_breakdown,
    kept_recent_letters,
)


def entry(spark: SparkSession) -> DataFrame:
    """Messages of the smallest scale, decoded, classified and aggregated per day."""
    return tumbling_day(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {query.__name__: query for query in _QUERIES}
    named.update(
        tumbling_minute=tumbling_minute,
        tumbling_hour_device=tumbling_hour_device,
        tumbling_day=tumbling_day,
        sliding=sliding,
        sliding_panes=sliding_panes,
    )
    for module in _training_data():
        named.update(module.queries())
    return named


def _training_data() -> list:
    """The modules with further queries, or none where that subpackage is left out."""
    try:
        import corpus_pipeline
        from sensorloom.llm import queries as operators
    except ModuleNotFoundError as error:
        if error.name not in ("corpus_pipeline", "sensorloom.llm", "sensorloom.llm.queries"):
            raise
        return []
    return [operators, corpus_pipeline]


# --------------------------------------------------------------------------
# The same as SQL.  Nothing below reads JSON: faults come from the event id.

_TELEMETRY = f"""
WITH mapped AS (
  SELECT event_id, user_id, event_id % {FAULT_CYCLE} AS fault, ts,
         printf('dev-%08x', user_id) AS sender,
         CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'humidity'
              WHEN 'purchase' THEN 'battery' WHEN 'signup' THEN 'signal_strength'
              ELSE 'fault_code' END AS metric,
         CASE WHEN event_id % {FAULT_CYCLE} = {HUGE_VALUE} THEN 9000.0::DOUBLE
              WHEN event_type = 'signup' THEN round(-20 - value, 2)
              ELSE value END AS reading,
         ts + CASE WHEN event_id % 25 = 0 THEN INTERVAL 3 HOUR
                   WHEN event_id % 10 = 0 THEN INTERVAL 20 MINUTE
                   ELSE INTERVAL 0 SECOND END AS arrival_time,
         date_trunc(CASE WHEN event_id % {FAULT_CYCLE} = {WHOLE_SECONDS} THEN 'second'
                         ELSE 'millisecond' END, ts) AS taken
  FROM events
), fields AS (
  SELECT *,
         CASE fault WHEN {NO_DEVICE} THEN NULL WHEN {ODD_ID} THEN 'unit-' || user_id
              ELSE sender END AS sent_id,
         CASE fault WHEN {NO_TIME} THEN NULL WHEN {BAD_TIME} THEN 'not-a-timestamp'
              WHEN {WHOLE_SECONDS} THEN strftime(taken, '%Y-%m-%dT%H:%M:%SZ')
              ELSE strftime(taken, '%Y-%m-%dT%H:%M:%S.') || printf('%03d', millisecond(taken) % 1000)
                   || 'Z' END AS sent_time,
         CASE fault WHEN {NO_METRIC} THEN NULL ELSE metric END AS sent_metric,
         CASE fault WHEN {NO_VALUE} THEN NULL WHEN {TEXT_VALUE} THEN '"N/A"'
              WHEN {QUOTED_VALUE} THEN '"' || reading || '"'
              ELSE reading::VARCHAR END AS sent_value,
         printf('site-%02d', user_id % 10) AS site,
         '1.4.' || (user_id % 5) AS firmware,
         fault IN ({CUT_SHORT}, {IN_ARRAY}, {EMPTY}) AS unreadable
  FROM mapped
), texts AS (
  SELECT *,
         '{{' || concat_ws(',',
             '"device_id":"' || sent_id || '"', '"timestamp":"' || sent_time || '"',
             '"metric_type":"' || sent_metric || '"', '"value":' || sent_value,
             '"site_id":"' || site || '"', '"firmware_version":"' || firmware || '"',
             CASE fault WHEN {EXTRA_PROPERTY} THEN '"status":"ok"' END) || '}}' AS body
  FROM fields
), telemetry AS (
  SELECT event_id, fault, metric, sender AS device_key, arrival_time,
         CASE fault WHEN {CUT_SHORT} THEN substr(body, 1, 20) WHEN {EMPTY} THEN ''
              WHEN {IN_ARRAY} THEN '[' || body || ']'
              WHEN {TWICE} THEN rtrim(body, '}}') || ',"site_id":"' || site || '"}}'
              WHEN {SINGLE_QUOTES} THEN replace(body, '"', chr(39)) ELSE body END AS raw_value,
         CASE WHEN NOT unreadable THEN sent_id END AS device_id,
         CASE WHEN NOT unreadable THEN sent_time END AS raw_timestamp,
         CASE WHEN NOT unreadable THEN sent_metric END AS metric_type,
         CASE WHEN NOT unreadable AND fault NOT IN ({NO_VALUE}, {TEXT_VALUE})
              THEN reading END AS value,
         CASE WHEN NOT unreadable THEN site END AS site_id,
         CASE WHEN NOT unreadable THEN firmware END AS firmware_version,
         CASE WHEN NOT unreadable AND fault NOT IN ({NO_TIME}, {BAD_TIME}) THEN taken END
           AS event_time,
         reading,
         CASE metric WHEN 'temperature' THEN reading BETWEEN -40 AND 85
              WHEN 'signal_strength' THEN reading BETWEEN -130 AND -20
              ELSE reading BETWEEN 0 AND 100 END AS plausible
  FROM texts
), classified AS (
  SELECT *,
         CASE WHEN fault IN ({CUT_SHORT}, {IN_ARRAY}) THEN 'invalid_json'
              WHEN fault IN ({NO_DEVICE}, {EMPTY}) THEN 'missing_device_id'
              WHEN fault IN ({BAD_TIME}, {NO_TIME}) THEN 'invalid_timestamp'
              WHEN fault <> {NO_METRIC} AND metric = 'fault_code' THEN 'invalid_metric_type'
              WHEN fault IN ({NO_VALUE}, {TEXT_VALUE}) THEN 'missing_or_non_numeric_value'
              WHEN fault = {NO_METRIC} OR NOT plausible THEN 'value_out_of_range'
         END AS error_reason
  FROM telemetry
), valid AS (
  SELECT device_id, event_time, metric_type, value, site_id, firmware_version, arrival_time
  FROM classified WHERE error_reason IS NULL
), dead AS (
  SELECT * FROM classified WHERE error_reason IS NOT NULL
)
"""


def _bucket(col: str, seconds: int) -> str:
    """Start of the epoch-aligned bucket that holds a timestamp."""
    return f"make_timestamp((floor(epoch_us({col}) / {seconds}e6) * {seconds} * 1000000)::BIGINT)"


# The mean at three places from whole millionths, half away from zero.
_TOTAL = "sum(round(value * 1000000)::BIGINT)::BIGINT"
_STEP = "(count(value) * 1000)"
_MEAN = f"""(CASE WHEN {_TOTAL} < 0 THEN -1 ELSE 1 END * (abs({_TOTAL}) // {_STEP}
               + CASE WHEN 2 * (abs({_TOTAL}) % {_STEP}) >= {_STEP} THEN 1 ELSE 0 END) / 1000.0)::DOUBLE"""


def _window_sql(seconds: int, slide: int | None = None, source: str = "valid") -> str:
    step = slide or seconds
    starts = f"""
      SELECT v.*, {_bucket("event_time", step)}
               - to_seconds(CAST(k.generate_series * {step} AS BIGINT)) AS window_start
      FROM {source} v, generate_series(0, {seconds // step - 1}) k"""
    return f"""
      SELECT window_start, window_start + to_seconds({seconds}) AS window_end, device_id,
             metric_type, {_MEAN} AS avg_value, count(*) AS event_count,
             min(value) AS min_value, max(value) AS max_value
      FROM ({starts}) GROUP BY ALL"""


_HOUR, _DAY = 3600, 86400
_MARK = "(SELECT max(event_time) - INTERVAL 2 HOUR FROM valid)"
_DAYS = f", days AS ({_window_sql(_DAY)})"


def _reasons(case: str) -> str:
    return f"SELECT {case} AS error_reason, count(*) AS n FROM classified GROUP BY ALL"


def _closed_sql(seconds: int, slide: int | None = None) -> str:
    return f"SELECT * FROM ({_window_sql(seconds, slide)}) WHERE window_end <= {_MARK}"


_REPLAYED = f"""
, arrivals AS (
  SELECT device_id, metric_type, value, event_time, arrival_time,
         {_bucket("arrival_time", 300)} AS batch_start FROM valid
), marks AS (
  SELECT batch_start, max(max(event_time)) OVER (
           ORDER BY batch_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         - INTERVAL 30 MINUTE AS watermark
  FROM arrivals GROUP BY batch_start
), replayed AS (
  SELECT a.*, watermark, coalesce(event_time < watermark, false) AS is_late,
         coalesce({_bucket("event_time", _HOUR)} + INTERVAL 1 HOUR <= watermark, false)
           AS is_dropped
  FROM arrivals a JOIN marks USING (batch_start)
)"""

_GAPS = """
, gaps AS (
  SELECT device_id, event_time AS quiet_from,
         lead(event_time) OVER (PARTITION BY device_id ORDER BY event_time) AS quiet_until
  FROM valid
)"""

_SESSIONS = """, starts AS (
              SELECT device_id, event_time,
                     coalesce(event_time - lag(event_time) OVER d > INTERVAL 12 HOUR, true)
                       AS fresh
              FROM valid WINDOW d AS (PARTITION BY device_id ORDER BY event_time)
            ), sessions AS (
              SELECT *, sum(fresh::INT) OVER (PARTITION BY device_id ORDER BY event_time) AS session
              FROM starts)
            SELECT device_id, min(event_time) AS active_from, max(event_time) AS quiet_from,
                   count(*) AS event_count
            FROM sessions GROUP BY device_id, session"""

_RATES = f"""
, rates AS (
  SELECT {_bucket("arrival_time", 6 * _HOUR)} AS window_start, count(*) AS records,
         count(error_reason) AS dead_letters, count(error_reason) / count(*) AS rate
  FROM classified GROUP BY ALL
)"""

_MENDED = f"""
, mended AS (
  SELECT device_id, sent_id, taken, reading, site, firmware, t.fault, t.metric, error_reason,
         CASE WHEN t.metric = 'fault_code' AND t.fault <> {SINGLE_QUOTES} THEN 'temperature'
              ELSE t.metric END AS new_metric
  FROM dead t JOIN texts USING (event_id, reading)
), again AS (
  SELECT *,
         CASE WHEN fault = {CUT_SHORT} THEN 'invalid_json'
              WHEN fault IN ({NO_DEVICE}, {EMPTY}) THEN 'missing_device_id'
              WHEN fault IN ({BAD_TIME}, {NO_TIME}) THEN 'invalid_timestamp'
              WHEN fault <> {NO_METRIC} AND new_metric = 'fault_code' THEN 'invalid_metric_type'
              WHEN fault IN ({NO_VALUE}, {TEXT_VALUE}) THEN 'missing_or_non_numeric_value'
              WHEN fault = {NO_METRIC} THEN 'value_out_of_range'
              WHEN new_metric = 'temperature' AND reading BETWEEN -40 AND 85 THEN NULL
              WHEN new_metric = 'signal_strength' AND reading BETWEEN -130 AND -20 THEN NULL
              WHEN new_metric IN ('humidity', 'battery') AND reading BETWEEN 0 AND 100 THEN NULL
              ELSE 'value_out_of_range' END AS new_reason
  FROM mended
)"""


_REPLAY = f"""{_MENDED}
            SELECT sent_id AS device_id, taken AS event_time, new_metric AS metric_type,
                   reading AS value, site AS site_id, firmware AS firmware_version
            FROM again WHERE new_reason IS NULL"""


def _rate_select(past: str = "") -> str:
    return f"""SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, records,
        dead_letters, round(rate, 6) AS rate {past}"""


_FUTURE = """CASE WHEN error_reason IS NULL AND device_key LIKE '%5'
  AND event_time > arrival_time - INTERVAL 47 HOUR THEN 'future_timestamp' ELSE error_reason END"""


# Parts by arrival; a part meets the watermark that the parts before it have left.
def _parts_with(arrival: str) -> str:
    return f"""
, parts AS (
  SELECT *, {" + ".join(f"({arrival} >= TIMESTAMP '{day}')::INT" for day in PART_DAYS)} AS part
  FROM valid
), part_marks AS (
  SELECT p.n AS part, max(date_trunc('millisecond', event_time)) - INTERVAL 10 MINUTE AS mark
  FROM generate_series(0, {len(PART_DAYS) + 1}) AS p(n) LEFT JOIN parts ON parts.part < p.n
  GROUP BY p.n
)"""


_PARTS = f"""{_parts_with("arrival_time")}, in_time AS (
  SELECT parts.* FROM parts JOIN part_marks USING (part)
  WHERE mark IS NULL OR {_bucket("event_time", _HOUR)} + INTERVAL 1 HOUR > mark
)"""
# The senders of late messages have a key that ends with 5; an odd id holds its number in decimal.
_SLOW = """arrival_time + CASE WHEN CASE WHEN device_id LIKE 'unit-%'
    THEN to_hex(try_cast(substr(device_id, 6) AS BIGINT)) ELSE device_id END LIKE '%5'
  THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END"""

_JOB = f"""{_DAYS}
            SELECT metric_type AS name, count(*) AS table_rows,
                   sum(event_count)::BIGINT AS messages
            FROM days WHERE window_end <= {_MARK} GROUP BY metric_type
            UNION ALL SELECT error_reason, count(*), count(*) FROM dead GROUP BY error_reason"""


def _parts_sql(source: str) -> str:
    return f"""{_PARTS} SELECT * FROM ({_window_sql(_HOUR, None, source)})
        WHERE window_end <= (SELECT max(mark) FROM part_marks)"""


_ONE_PER_EVENT = """
    SELECT device_id, metric_type, event_time, value, min(site_id) || '/1' AS site_id,
           min(firmware_version) AS firmware_version
    FROM valid GROUP BY device_id, metric_type, event_time, value"""


_SPIKES = f"""{_RATES}, past AS (
  SELECT r.window_start, sum(p.dead_letters) / sum(p.records) AS past_rate
  FROM rates r JOIN rates p ON p.window_start < r.window_start
    AND p.window_start >= r.window_start - INTERVAL 24 HOUR
  GROUP BY r.window_start)
{_rate_select(''', round(past_rate, 6) AS past_rate,
  coalesce(rate >= past_rate * 1.2, false) AS is_spike''')}
FROM rates LEFT JOIN past USING (window_start)"""


def oracle_sql() -> dict[str, str]:
    bodies = {
        "encode": "SELECT device_key AS key, raw_value AS value FROM telemetry",
        "decode": f"""
            SELECT device_key, raw_value, device_id, raw_timestamp, metric_type, value, site_id,
                   firmware_version,
                   CASE WHEN fault IN ({CUT_SHORT}, {IN_ARRAY}) THEN raw_value END
                     AS corrupt_record,
                   event_time, arrival_time
            FROM telemetry""",
        "classify_reasons": """
            SELECT device_key, raw_value, error_reason, error_reason IS NULL AS is_valid
            FROM classified""",
        "classify_strict": _reasons(
            f"CASE fault WHEN {NO_METRIC} THEN 'invalid_metric_type' ELSE error_reason END"
        ),
        "foreign_text": """
            SELECT device_key, md5(body) AS text_hash,
                   CASE WHEN starts_with(body, '{') OR trim(body) = ''
                        THEN 'missing_device_id' ELSE 'invalid_json' END AS error_reason
            FROM (SELECT 'documents' AS device_key, text AS body FROM documents
                  UNION ALL SELECT 'conversations', text FROM conversations
                  UNION ALL SELECT 'pages', html FROM pages
                  UNION ALL SELECT 'events', props FROM events)""",
        "future_guard": _reasons(_FUTURE),
        "valid_rows": "SELECT * EXCLUDE (arrival_time) FROM valid",
        "dead_letters": "SELECT raw_value, device_id, error_reason FROM dead",
        "whole_chain": """
            SELECT 'valid' AS name, count(*) AS total FROM valid
            UNION ALL SELECT 'dead_letter', count(*) FROM dead
            UNION ALL SELECT 'aggregated', count(*) FROM valid""",
        "tumbling_minute": _window_sql(60),
        "tumbling_hour_device": _window_sql(_HOUR),
        "tumbling_day": _window_sql(_DAY),
        "sliding": _window_sql(_DAY, 6 * _HOUR),
        "sliding_panes": _window_sql(_DAY, 6 * _HOUR),
        "total_rows": f"""{_DAYS}
            SELECT 'aggregates' AS name, count(*) AS total FROM days
            UNION ALL SELECT 'dead_letter', count(*) FROM dead""",
        "metric_rollup": f"""{_DAYS}
            SELECT metric_type, count(*) AS windows, sum(event_count)::BIGINT AS total_events,
                   round(avg(avg_value), 6) AS overall_avg FROM days GROUP BY metric_type""",
        "weighted_rollup": f"""{_DAYS}
            SELECT metric_type, count(*) AS windows, sum(event_count)::BIGINT AS total_events,
                   round(sum(avg_value * event_count) / sum(event_count), 6) AS weighted_avg
            FROM days GROUP BY metric_type""",
        "recent_windows": f"""{_DAYS}
            SELECT * FROM days
            ORDER BY window_end DESC, device_id, metric_type, window_start DESC LIMIT 20""",
        "recent_dead_letters": """
            SELECT arrival_time AS quarantined_at, device_id, error_reason, raw_value FROM dead
            ORDER BY arrival_time DESC, raw_value, device_id NULLS FIRST, error_reason LIMIT 20""",
        "guarded_chain": f"""
            SELECT coalesce(reason, 'aggregated') AS name, count(*)::BIGINT AS n
            FROM (SELECT {_FUTURE} AS reason FROM classified) GROUP BY ALL""",
        "binary_envelope": f"""
            SELECT NULL::VARCHAR AS device_key, raw_value, device_id, raw_timestamp, metric_type,
                   value, site_id, firmware_version,
                   CASE WHEN fault IN ({CUT_SHORT}, {IN_ARRAY}) THEN raw_value END
                     AS corrupt_record, event_time
            FROM telemetry""",
        "reason_breakdown": "SELECT error_reason, count(*) AS n FROM dead GROUP BY error_reason",
        "contract_audit": f"""
            SELECT device_key AS key, raw_value AS value,
                   CASE WHEN fault IN ({CUT_SHORT}, {IN_ARRAY}, {EMPTY}) THEN 'not_an_object'
                   WHEN fault = {TWICE} THEN 'duplicate:site_id'
                   WHEN fault = {SINGLE_QUOTES} THEN 'syntax'
                   ELSE concat_ws(',',
                     CASE fault WHEN {NO_DEVICE} THEN 'missing:device_id'
                                WHEN {NO_TIME} THEN 'missing:timestamp'
                                WHEN {NO_METRIC} THEN 'missing:metric_type'
                                WHEN {NO_VALUE} THEN 'missing:value'
                                WHEN {TEXT_VALUE} THEN 'type:value'
                                WHEN {QUOTED_VALUE} THEN 'type:value'
                                WHEN {ODD_ID} THEN 'pattern:device_id'
                                WHEN {BAD_TIME} THEN 'format:timestamp' END,
                     CASE WHEN metric = 'fault_code' AND fault <> {NO_METRIC}
                          THEN 'enum:metric_type' END,
                     CASE fault WHEN {EXTRA_PROPERTY} THEN 'unknown:status' END) END
                   AS violations
            FROM telemetry""",
        "document_audit": """
            SELECT o_orderkey, concat_ws(',',
                     CASE WHEN o_orderkey % 13 = 0 THEN 'missing:clerk' END,
                     CASE WHEN o_orderkey < 1 THEN 'minimum:id' END,
                     CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'enum:status' END,
                     CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 7 = 0 THEN 'missing:order.total' END,
                     CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 0 AND o_totalprice >= 200000
                          THEN 'exclusiveMaximum:order.total' END,
                     CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 11 = 0 THEN 'unknown:order.extra' END,
                     CASE WHEN o_orderkey % 5 = 0 THEN 'maxItems:tags' END,
                     CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-4]') THEN 'pattern:tags[]' END)
                   AS violations
            FROM orders""",
        "dedup": "SELECT DISTINCT * EXCLUDE (arrival_time) FROM valid",
        "dedup_by_key": _ONE_PER_EVENT,
        "late_copies": _ONE_PER_EVENT,
        "dedup_windows": _window_sql(_HOUR),
        "quiet_devices": f"""{_GAPS}
            SELECT * FROM gaps WHERE quiet_until - quiet_from > INTERVAL 12 HOUR""",
        "quiet_devices_now": f"""{_GAPS}
            SELECT * FROM gaps
            WHERE coalesce(quiet_until, (SELECT max(event_time) FROM valid)) - quiet_from
                  > INTERVAL 12 HOUR""",
        "watermark_replay": f"{_REPLAYED} SELECT * FROM replayed",
        "late_rows": f"""{_REPLAYED}
            SELECT * EXCLUDE (is_late, is_dropped) FROM replayed WHERE is_late""",
        "dead_letter_volume": f"""
            SELECT {_bucket("arrival_time", 6 * _HOUR)} AS window_start,
                   {_bucket("arrival_time", 6 * _HOUR)} + INTERVAL 6 HOUR AS window_end,
                   error_reason, count(*) AS dead_letters
            FROM dead GROUP BY ALL""",
        "dead_letter_rate": f"{_RATES} {_rate_select(', rate >= 0.5 AS is_spike')} FROM rates",
        "dead_letter_spikes": _SPIKES,
        "replay": _REPLAY,
        "replay_once": _REPLAY,
        "replay_still_refused": f"""{_MENDED}
            SELECT new_reason AS error_reason, count(*) AS n FROM again
            WHERE new_reason IS NOT NULL GROUP BY ALL""",
        "stream_windows": _closed_sql(_HOUR),
        "stream_sliding": _closed_sql(_DAY, 6 * _HOUR),
        "stream_dead_letters": "SELECT raw_value, device_id, error_reason FROM dead",
        "stream_dedup": _closed_sql(_HOUR),
        "stream_late_rows": _parts_sql("in_time"),
        "stream_dedup_late": _parts_sql(
            "(SELECT DISTINCT device_id, metric_type, event_time, value FROM in_time)"
        ),
        "stream_first_copies": "SELECT DISTINCT * EXCLUDE (arrival_time) FROM valid",
        "stream_quiet_devices": f"""{_SESSIONS}
            HAVING max(event_time) + INTERVAL 12 HOUR <= {_MARK}""",
        "stream_silent_fleet": _SESSIONS,
        "stream_dead_letter_rate": f"""{_RATES}
            {_rate_select(', rate >= 0.5 AS is_spike')} FROM rates
            WHERE window_start + INTERVAL 6 HOUR
                  <= (SELECT date_trunc('millisecond', max(arrival_time)) - INTERVAL 2 HOUR
                      FROM classified)""",
        "stream_spikes": f"""{_SPIKES}
            WHERE window_start + INTERVAL 6 HOUR
                  <= (SELECT date_trunc('millisecond', max(arrival_time)) - INTERVAL 2 HOUR
                      FROM classified)""",
        "stream_compacted": "SELECT * EXCLUDE (arrival_time) FROM valid",
        "stream_metrics": f"""{_DAYS}
            SELECT (SELECT count(*) FROM classified) AS input_rows,
                   count(*) FILTER (window_end > {_MARK}) AS open_groups,
                   0::BIGINT AS dropped_rows FROM days""",
        "stream_two_queries": _JOB,
        "stream_staged_queries": _JOB,
        "stream_late_table": f"""{_parts_with(_SLOW)}
            SELECT device_id, event_time, metric_type, value, site_id, firmware_version, mark AS watermark
            FROM parts JOIN part_marks USING (part)
            WHERE {_bucket("event_time", _HOUR)} + INTERVAL 1 HOUR <= mark""",
        "stream_open_windows": f"""SELECT *, window_end > {_MARK} AS is_open FROM ({_window_sql(_DAY)})""",
        "stream_restart": _closed_sql(_HOUR),
        "upserts": _window_sql(_DAY),
        "kept_rollup": f"""{_DAYS}
            SELECT metric_type, count(*) AS windows, sum(event_count)::BIGINT AS total_events,
                   round(avg(avg_value), 6) AS overall_avg,
                   round(sum(avg_value * event_count) / sum(event_count), 6) AS weighted_avg
            FROM days GROUP BY metric_type""",
    }
    bodies["kept_recent_windows"] = bodies["recent_windows"]
    bodies["kept_recent_letters"] = bodies["recent_dead_letters"]
    bodies["kept_breakdown"] = bodies["reason_breakdown"]
    plain = {"foreign_text", "document_audit"}
    sql = {name: ("" if name in plain else _TELEMETRY) + body for name, body in bodies.items()}
    for module in _training_data():
        sql.update(module.oracle_sql())
    return sql
