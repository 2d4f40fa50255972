"""Scans, schema inference, envelopes, bronze writes and streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pactline as p
from pactline.sources import envelope
from workload.contract_queries import ORACLE as CONTRACT_ORACLE
from workload.feeds import (
    BOUNDARY_TS,
    CONTRACTS,
    DELAY_MS,
    KIND,
    LINES_SQL,
    MIXED_LINE,
    OPS,
    TIMED_SQL,
    WEB,
    dirty_lines,
    event_batches,
    mixed_lines,
    table,
)
from workload.sla_queries import _summary

BRONZE_SCHEMA = "event_id string, source string, user_id bigint, event_type string, value double"


def json_scan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.scan_counts(mixed_lines(spark, sf_dir))


def publish_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.publish_stats(mixed_lines(spark, sf_dir))


def envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published as envelopes, read back and unwrapped."""
    folder = p.shared_folder(spark, "topic")
    envelope.publish(dirty_lines(spark, sf_dir).select("value"), folder, "events", "loader")
    events = envelope.unwrap(spark.read.text(folder))
    key, seen = (F.get_json_object("value", f"$.{f}") for f in ("event_id", "props.k"))
    return events.select("topic", "client_id", key.alias("event_id"), seen.cast("bigint").alias("k"))


def envelope_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows as envelopes; nulls survive as nulls."""
    events = table(spark, sf_dir, "events").withColumn(
        "value", F.when(F.col("event_id") % 9 > 0, F.col("value"))
    )
    lines = envelope.unwrap(envelope.wrap_rows(events))
    profile = p.type_profile(p.raw_records(lines), EVENT_ROWS)
    return profile.where("field = 'value'").select(
        F.col("observed_type").alias("value_type"), "records"
    )


EVENT_ROWS = p.Contract(
    "rows", "v1", "rows", (p.Field("event_id", "integer"), p.Field("value", "float"))
)


def _props_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = p.shared_folder(spark, "props")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    events.write.json(folder)
    return folder


def infer_first_record_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    ddl = p.infer_schema(spark, _props_folder(spark, sf_dir))
    return spark.createDataFrame([(ddl,)], "ddl string")


def read_with_inferred_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.read_with_schema(spark, _props_folder(spark, sf_dir))


def infer_merged_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type, presence and conflicts of every field of the dirty feed, and reading with it.

    ``read`` counts the rows whose field is not null when the feed is read with
    the merged schema: those that hold a value, so no type loses one.
    """
    folder = p.shared_folder(spark, "feed")
    dirty_lines(spark, sf_dir).select("value").write.text(folder)
    fields = p.field_schema(p.read_jsonl(spark, folder))
    rows = p.read_with_schema(spark, folder, p.merged_schema(fields))
    # A null inside a VARIANT column is a value of its own.
    held = {
        c: F.col(c).isNotNull() & ~F.is_variant_null(c) if t == "variant" else F.col(c).isNotNull()
        for c, t in rows.dtypes
    }
    counts = rows.agg(*(F.count_if(x).alias(c) for c, x in held.items()))
    read = counts.unpivot([], counts.columns, "field", "read")
    return fields.join(F.broadcast(read), "field").select(  # one row per field
        "field", "type", F.array_join("kinds", ",").alias("kinds"), "present", "nulls", "records",
        "read",
    )


def bronze_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p.enrich(table(spark, sf_dir, "events").select("event_id", "event_type"))
    stamped = F.col("_bronze_ingestion_ts").isNotNull().alias("stamped")
    return rows.select("event_id", "event_type", "_data_source", stamped)


def bronze_write_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = p.enrich(table(spark, sf_dir, "events"))
    done = p.write_bronze(rows, p.BronzeSink(p.shared_folder(spark, "bronze")))
    written = spark.read.json(done["output_path"]).agg(F.count(F.lit(1)).alias("rows_found"))
    told = {name: F.lit(done[name]) for name in ("rows_written", "status", "writer_type")}
    return written.withColumns(told)


def bronze_ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, one of them from a path that does not exist, and their summary."""
    folder = _props_folder(spark, sf_dir)
    target = p.shared_folder(spark, "bronze")
    log = [
        p.ingest_batch(spark, folder, target, 0),
        p.ingest_batch(spark, folder + "-missing", target, 1),
    ]
    return p.run_summary(p.ingest_log(spark, log))


def _line_stream(spark: SparkSession, sf_dir: str, files: int = 8) -> DataFrame:
    """The dirty feed as a stream of JSON lines in eight files, or more."""
    folder = p.shared_folder(spark, "feed")
    dirty_lines(spark, sf_dir).repartition(files, "n").select("value").write.text(folder)
    return spark.readStream.option("maxFilesPerTrigger", 4).text(folder)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because a stream takes a plain path for a folder.
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def stream_bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = p.shared_folder(spark, "bronze")
    p.bronze_stream(_line_stream(spark, sf_dir), BRONZE_SCHEMA, folder).awaitTermination()
    rows = spark.read.parquet(f"{folder}/rows")
    return rows.select("event_id", "source", "user_id", "event_type", "_data_source")


def stream_ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = p.shared_folder(spark, "bronze")
    p.bronze_stream(_line_stream(spark, sf_dir), BRONZE_SCHEMA, folder).awaitTermination()
    return p.run_summary(spark.read.parquet(f"{folder}/log"))


def stream_contract_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = p.shared_folder(spark, "split")
    p.contract_stream(_line_stream(spark, sf_dir), [WEB, OPS], folder).awaitTermination()
    rows = spark.read.parquet(f"{folder}/rows")
    return rows.groupBy("status", "dataset").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.coalesce(F.size("violations"), F.lit(0))).cast("bigint").alias("violations"),
    )


def stream_sla_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per hour of the windows that the watermark has closed."""
    folder = p.shared_folder(spark, "sla")
    events = _event_stream(spark, sf_dir).select(
        F.expr("cast(case when event_id % 97 = 0 then date_trunc('hour', ts) else ts end "
               "as timestamp)").alias("event_timestamp"),
        F.expr("((event_id * 7919) % 9973) * 1000").alias("lag_us"),
    )
    p.sla_stream(events, folder, width=timedelta(hours=1)).awaitTermination()
    metrics = spark.read.parquet(f"{folder}/metrics")
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return metrics.withColumns(times).drop("batch_id")


SKETCH = 64


def stream_sla_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per day from sketches, and whether their ranks are within the bound.

    The bound holds with 99 % confidence per number; three times as much is
    asked for here, which no run exceeds.
    """
    folder, day = p.shared_folder(spark, "sketch"), timedelta(days=1)
    lag = F.expr(f"({DELAY_MS}) * 1000").alias("lag_us")
    ts = F.expr(f"cast({BOUNDARY_TS} as timestamp)").alias("event_timestamp")
    events = _event_stream(spark, sf_dir).select(ts, lag)
    p.sla_sketch_stream(events, folder, width=day, k=SKETCH).awaitTermination()
    metrics = spark.read.parquet(f"{folder}/metrics")
    timed = p.closed_window_times(
        table(spark, sf_dir, "events").select(ts, lag), "event_timestamp", day
    )
    met = metrics.join(timed.select("window_end", "lag_us"), "window_end")
    ms = F.col("lag_us") / 1000.0
    ranks = met.groupBy("window_end").agg(
        *(
            F.struct(
                F.count_if(ms < F.col(f"{p_}_lag_ms")).alias("below"),
                F.count_if(ms <= F.col(f"{p_}_lag_ms")).alias("upto"),
            ).alias(p_)
            for p_ in ("p50", "p99")
        )
    )
    room = F.col("total_events") * 3 * p.rank_error(SKETCH) + 1
    near = [
        (
            (F.col(f"{name}.below") <= F.col("total_events") * part + room)
            & (F.col(f"{name}.upto") >= F.col("total_events") * part - room)
        ).alias(f"{name}_near")
        for name, part in (("p50", 0.5), ("p99", 0.99))
    ]
    return metrics.join(ranks, "window_end").select(
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "total_events", "avg_lag_ms", "max_lag_ms", "sla_violations", *near,
    )


def stream_window_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per hour from two streams, events and ingest batches, with batches per second."""
    folder = p.shared_folder(spark, "sla")
    events = _event_stream(spark, sf_dir).select(
        F.expr(f"cast({BOUNDARY_TS} as timestamp)").alias("event_timestamp"),
        F.expr(f"({DELAY_MS}) * 1000").alias("lag_us"),
    )
    started = event_batches(spark, sf_dir).select(
        F.col("batch_start").cast("timestamp").alias("batch_start")
    )
    started.write.parquet(f"{folder}/batches")
    batches = spark.readStream.schema(started.schema).parquet(f"{folder}/batches")
    p.sla_stream(events, folder, width=timedelta(hours=1), batches=batches).awaitTermination()
    metrics = spark.read.parquet(f"{folder}/metrics")
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return metrics.withColumns(times).drop("batch_id")


MICRO_BATCHES = 104
# Rows of a file from which on a micro-batch of the late rows has more files than one.
FILE_ROWS = 50_000


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour that a stream of 104 micro-batches emits, holds or keeps as late.

    Files come roughly in order of time, so some rows of each are behind the
    watermark of the files before. Which rows those are depends on the order of
    the files; that none is lost does not.
    """
    folder = p.shared_folder(spark, "late")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(f"cast({BOUNDARY_TS} as timestamp)").alias("event_timestamp"),
        F.expr(f"({DELAY_MS}) * 1000").alias("lag_us"),
    )
    # A file is read by one task, so a large micro-batch has several.
    each = max(1, -(-events.count() // (MICRO_BATCHES * FILE_ROWS)))
    order = ["event_timestamp", "event_id"]
    events.repartitionByRange(MICRO_BATCHES * each, *order).write.parquet(f"{folder}/events")
    hour = timedelta(hours=1)
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", each)
    stream = source.parquet(f"{folder}/events")
    p.sla_stream(stream, folder, width=hour, keep_late=True).awaitTermination()
    timed = p.closed_window_times(stream, "event_timestamp", hour)
    hour = [F.col("window_end").cast("timestamp_ntz").alias("window_end")]
    late = p.late_side(spark, timed, folder).groupBy(*hour).agg(F.count(F.lit(1)).alias("late"))
    held = p.on_time_side(spark, timed, folder).groupBy(*hour).agg(F.count(F.lit(1)).alias("held"))
    emitted = spark.read.parquet(f"{folder}/metrics").select(*hour, "total_events")
    found = late.join(held, "window_end", "full").join(emitted, "window_end", "full")
    batches = p.split_log(spark, folder).agg(F.count(F.lit(1)).alias("batches"))
    zero = F.lit(0)
    return found.crossJoin(F.broadcast(batches)).select(  # one row
        "window_end",
        (F.coalesce("total_events", "held", zero) + F.coalesce("late", zero)).alias("events"),
        (F.col("batches") > 100).alias("many_batches"),
    )


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 40th event is delivered twice."""
    folder = p.shared_folder(spark, "dedupe")
    copies = F.expr("explode(case when event_id % 40 = 0 then array(0, 1) else array(0) end)")
    events = _event_stream(spark, sf_dir).select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), copies.alias("copy")
    )
    p.dedupe_stream(events, ["event_id"], "ts", timedelta(days=60), folder).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select("event_id", "event_type")


def stream_dedupe_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once, though copies, and some first deliveries, come days late.

    Of the events every 40th comes a second time at once, every 25th a second
    time ten days later, and every 30th comes two days late only.
    """
    folder = p.shared_folder(spark, "dedupe")
    arrival = F.expr(
        "explode(case when event_id % 30 = 0 then array(2) when event_id % 40 = 0 then array(0, 0) "
        "when event_id % 25 = 0 then array(0, 10) else array(0) end)"
    )
    sent = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), arrival.alias("days")
    )
    arrived = F.col("ts") + F.make_dt_interval(days=F.col("days"))
    files = sent.repartitionByRange(12, arrived, "event_id").sortWithinPartitions(arrived)
    files.drop("days").write.parquet(f"{folder}/in")
    schema = "event_id bigint, event_type string, ts timestamp"
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    p.dedupe_all(events, ["event_id"], "ts", timedelta(hours=1), folder).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select("event_id", "event_type")


# Lines of a file from which on the cumulative stream has more files than eight.
FILE_LINES = 1_000_000


def stream_contract_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after the last micro-batch of a stream, over all it has brought.

    Files, and so micro-batches, stay of one size however large the feed is.
    """
    folder = p.shared_folder(spark, "watch")
    files = max(8, -(-table(spark, sf_dir, "events").count() // FILE_LINES))
    p.contract_watch(_line_stream(spark, sf_dir, files), CONTRACTS, folder).awaitTermination()
    reports = spark.read.parquet(f"{folder}/report")
    last = reports.agg(F.max("batch_id").alias("batch_id"))
    return reports.join(F.broadcast(last), "batch_id").drop("batch_id")  # one row


QUERIES = {
    "json_scan_counts": json_scan_counts,
    "publish_stats": publish_stats,
    "envelope_roundtrip": envelope_roundtrip,
    "envelope_rows": envelope_rows,
    "infer_first_record_schema": infer_first_record_schema,
    "read_with_inferred_schema": read_with_inferred_schema,
    "infer_merged_schema": infer_merged_schema,
    "bronze_enrich": bronze_enrich,
    "bronze_write_stats": bronze_write_stats,
    "bronze_ingest_batch": bronze_ingest_batch,
    "stream_bronze_ingest": stream_bronze_ingest,
    "stream_ingest_log": stream_ingest_log,
    "stream_contract_split": stream_contract_split,
    "stream_sla_windows": stream_sla_windows,
    "stream_sla_sketch": stream_sla_sketch,
    "stream_window_batches": stream_window_batches,
    "stream_late_rows": stream_late_rows,
    "stream_dedupe": stream_dedupe,
    "stream_dedupe_late": stream_dedupe_late,
    "stream_contract_cumulative": stream_contract_cumulative,
}

_MIXED = f"mixed as (select trim({MIXED_LINE}) as j from events)"

ORACLE = {
    "json_scan_counts": f"""with {_MIXED}
select count(*) as lines, count(*) filter (j = '') as blank,
  count(*) filter (j <> '' and not json_valid(j)) as invalid,
  count(*) filter (json_valid(j) and j[1] = '{{') as objects,
  count(*) filter (json_valid(j) and j[1] <> '{{') as other_json
from mixed""",
    "publish_stats": f"""with {_MIXED}
select count(*) as attempted, count(*) filter (json_valid(j)) as published,
  count(*) filter (not json_valid(j)) as failed
from mixed where j <> ''""",
    "envelope_roundtrip": f"""with {LINES_SQL}
select 'events' as topic, 'loader' as client_id, json_extract_string(j, '$.event_id') as event_id,
  cast(json_extract_string(j, '$.props.k') as bigint) as k from lines""",
    "envelope_rows": """select case when event_id % 9 > 0 then 'float' else 'null' end as value_type,
  count(*) as records from events group by 1""",
    "infer_first_record_schema": """with names(duck, spark) as (
  values ('BIGINT', 'BIGINT'), ('VARCHAR', 'STRING'), ('DOUBLE', 'DOUBLE')),
typed as (select typeof(event_id) as a, typeof(event_type) as b, typeof(value) as c
  from events limit 1)
select concat('STRUCT<event_id: ', a.spark, ', event_type: ', b.spark, ', value: ', c.spark, '>')
  as ddl
from typed join names a on a.duck = typed.a join names b on b.duck = typed.b
  join names c on c.duck = typed.c""",
    "read_with_inferred_schema": "select event_id, event_type, value from events",
    "infer_merged_schema": f"""with {LINES_SQL},
named as (select unnest(json_keys(j)) as field, j from lines),
kinds as (select field, {KIND} as kind, n from (select field, j, count(*) as n
  from named group by all)),
sums as (select field, cast(sum(n) as bigint) as present,
    cast(coalesce(sum(n) filter (kind = 'null'), 0) as bigint) as nulls,
    list_sort(list(distinct kind)) as seen,
    count(distinct case when kind in ('int', 'float') then 'number' when kind <> 'null' then kind end)
      as families
  from kinds group by field)
select field, case when families > 1 then 'VARIANT' when list_contains(seen, 'bool') then 'BOOLEAN'
    else 'STRING' end as type, array_to_string(seen, ',') as kinds, present, nulls,
  (select count(*) from lines) as records, present - nulls as read from sums""",
    "bronze_enrich": """select event_id, event_type, 'kafka-mock' as _data_source,
  true as stamped from events""",
    "bronze_write_stats": """select count(*) as rows_found, count(*) as rows_written,
  'success' as status, 'jsonl' as writer_type from events""",
    "bronze_ingest_batch": """select cast(2 as bigint) as total_batches,
  count(*) as total_rows_read, count(*) as total_rows_written,
  cast(1 as bigint) as successful_batches, cast(1 as bigint) as failed_batches,
  count(*) / 2 as avg_rows_per_batch from events""",
    "stream_bronze_ingest": f"""with {LINES_SQL}
select json_extract_string(j, '$.event_id') as event_id,
  json_extract_string(j, '$.source') as source,
  case when json_type(j, '$.user_id') in ('BIGINT', 'UBIGINT')
       then cast(json_extract_string(j, '$.user_id') as bigint) end as user_id,
  json_extract_string(j, '$.event_type') as event_type, 'kafka-mock' as _data_source
from lines""",
    "stream_ingest_log": """select cast(2 as bigint) as total_batches,
  count(*) as total_rows_read, count(*) as total_rows_written,
  cast(2 as bigint) as successful_batches, cast(0 as bigint) as failed_batches,
  count(*) / 2 as avg_rows_per_batch from events""",
    "stream_contract_split": f"""with {LINES_SQL}, held as (
  select l.n, m.dataset, (select count(*) from broken b
      where b.n = m.n and b.dataset = m.dataset) as violations
  from lines l left join members m on m.n = l.n and m.dataset <> 'all_events')
select case when dataset is null then 'unmatched' when violations > 0 then 'quarantine'
    else 'valid' end as status, dataset, count(*) as records,
  cast(sum(case when dataset is null then 0 else violations end) as bigint) as violations
from held group by all""",
    "stream_sla_windows": f"""with {TIMED_SQL}, starts as (
  select lag_us, time_bucket(interval 1 hour, event_timestamp) as window_start from timed
  union all
  select lag_us, event_timestamp - interval 1 hour from timed
  where event_timestamp = time_bucket(interval 1 hour, event_timestamp)),
{_summary("window_start", 5000000, "starts")}
select window_start, window_start + interval 1 hour as window_end, total_events, avg_lag_ms,
  max_lag_ms, p50_lag_ms, p99_lag_ms, sla_violations, sla_violation_rate,
  total_events / 3600 as throughput_events_per_sec
from summary where window_start + interval 1 hour
  <= (select max(event_timestamp) from timed) - interval 10 minutes""",
    "stream_sla_sketch": f"""with {TIMED_SQL}, starts as (
  select lag_us, time_bucket(interval 1 day, event_timestamp) as s from timed
  union all
  select lag_us, event_timestamp - interval 1 day from timed
  where event_timestamp = time_bucket(interval 1 day, event_timestamp))
select s + interval 1 day as window_end, count(*) as total_events,
  cast(sum(lag_us) as double) / count(*) / 1000 as avg_lag_ms, max(lag_us) / 1000 as max_lag_ms,
  count(*) filter (lag_us > 5000000) as sla_violations, true as p50_near, true as p99_near
from starts where s + interval 1 day
  <= (select max(event_timestamp) from timed) - interval 10 minutes
group by s""",
    "stream_window_batches": f"""with {TIMED_SQL}, starts as (
  select lag_us, time_bucket(interval 1 hour, event_timestamp) as s from timed
  union all
  select lag_us, event_timestamp - interval 1 hour from timed
  where event_timestamp = time_bucket(interval 1 hour, event_timestamp)),
{_summary("s", 5000000, "starts")},
begun as (select s, count(*) as total_batches from (
    select time_bucket(interval 1 hour, batch_start) as s from batches
    union all
    select batch_start - interval 1 hour from batches
    where batch_start = time_bucket(interval 1 hour, batch_start))
  group by s)
select s as window_start, s + interval 1 hour as window_end, total_events,
  coalesce(total_batches, 0) as total_batches, avg_lag_ms, max_lag_ms, p50_lag_ms, p99_lag_ms,
  total_events / 3600 as throughput_events_per_sec,
  coalesce(total_batches, 0) / 3600 as throughput_batches_per_sec,
  sla_violations, sla_violation_rate
from summary left join begun using (s)
where s + interval 1 hour <= least((select max(event_timestamp) from timed),
  (select max(batch_start) from batches)) - interval 10 minutes""",
    "stream_late_rows": f"""with {TIMED_SQL}, ends as (
  select time_bucket(interval 1 hour, event_timestamp) + interval 1 hour as window_end from timed
  union all
  select event_timestamp from timed
  where event_timestamp = time_bucket(interval 1 hour, event_timestamp))
select window_end, count(*) as events, true as many_batches from ends group by all""",
    "stream_dedupe": "select event_id, event_type from events",
    "stream_dedupe_late": "select event_id, event_type from events",
    "stream_contract_cumulative": CONTRACT_ORACLE["contract_report_all"],
}
