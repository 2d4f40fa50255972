"""Nothing is lost: lines, events, groups and digits that a shortcut would drop."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pactline as p
from pactline.sources import envelope
from workload.feeds import (
    DELAY_MS,
    LINES_SQL,
    MIXED_LINE,
    TIMED_SQL,
    dirty_lines,
    dirty_records,
    event_batches,
    mixed_lines,
    table,
    timed_events,
)
from workload.sla_queries import _summary
from workload.source_queries import _event_stream


def bronze_keeps_every_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch whose lines fit no one schema, and what its log counts."""
    folder, target = p.shared_folder(spark, "mixed"), p.shared_folder(spark, "bronze")
    mixed_lines(spark, sf_dir).write.text(folder)
    done = p.ingest_batch(spark, folder, target, 1, schema="k bigint")
    rows = spark.read.schema("_raw_line string").json(f"{target}_bronze_batch_1")
    told = {name: F.lit(done[name]) for name in ("rows_read", "rows_bad")}
    return rows.withColumnRenamed("_raw_line", "line").withColumns(told)


def publish_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit counts published events; broken lines on the way are counted and kept."""
    folder = p.shared_folder(spark, "topic")
    lines = table(spark, sf_dir, "events").orderBy("event_id").select(
        F.expr(MIXED_LINE).alias("value")
    )
    done = envelope.publish(lines, folder, max_records=100)
    written = spark.read.text(folder).agg(F.count(F.lit(1)).alias("envelopes"))
    rejected = spark.read.text(f"{folder}_rejected").agg(F.count(F.lit(1)).alias("rejected"))
    counted = written.crossJoin(F.broadcast(rejected))  # one row each
    return counted.withColumns({k: F.lit(v) for k, v in done.items()})


def publish_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the write itself; broken lines are beside the topic."""
    folder = p.shared_folder(spark, "topic")
    done = envelope.publish(mixed_lines(spark, sf_dir), folder)
    events = envelope.unwrap(spark.read.text(folder)).select("value", F.lit(True).alias("good"))
    rejected = spark.read.text(f"{folder}_rejected").select("value", F.lit(False).alias("good"))
    return events.union(rejected).withColumns({k: F.lit(v) for k, v in done.items()})


LONG_TOPIC = 'odd "topic" ' + "\\x" * 20_000


def envelope_text_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole event texts survive: trailing zeros, large numbers, quotes, line separators.

    The topic is 40,000 characters long, half of them to be escaped.
    """
    folder = p.shared_folder(spark, "topic")
    # 60 KB a line from a few bytes, so these are shared out however the table is split.
    tasks = 2 * spark.sparkContext.defaultParallelism
    lines = table(spark, sf_dir, "events").repartition(tasks).select(
        F.concat(
            F.lit('{"id": '), "event_id", F.lit(', "price": '), "event_id",
            F.lit('.10, "big": 12345678901234567890.'), "event_id",
            F.lit(', "far": 1e400, "text": "a \\"}, b'), F.expr("'\\u2028 \\u0085'"), F.lit('"}'),
        ).alias("value")
    )
    envelope.publish(lines, folder, LONG_TOPIC, "loader")
    envelopes = spark.read.text(folder)
    first = envelopes.first()
    events = envelope.unwrap(envelopes, sample=first and first["value"])
    return events.withColumn("topic", F.md5("topic"))


def dedupe_null_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 7th row has no place in the order, and places repeat."""
    documents = table(spark, sf_dir, "documents").withColumn(
        "place", F.expr("case when doc_id % 7 > 0 then doc_id div 3 end")
    )
    return p.keep_first(documents, ["text", "lang"], "place").select("doc_id", "place")


EXACT = p.Contract(
    "amounts", "v1", "amounts", (p.Field("amount", "float"),),
    (p.Rule("amount", allow_duplicates=False),),
)


def quality_duplicates_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals that are one DOUBLE but differ in the 18th digit."""
    amounts = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "cast(event_id div 3 as decimal(10,0)) + cast(event_id % 3 div 2 as decimal(1,0)) * "
        "cast('0.000000000000000001' as decimal(18,18)) as amount",
    )
    found = p.duplicate_keys(p.typed_records(amounts, order_by="event_id"), EXACT)
    return found.select("first_seen", "copies")


def contract_report_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without an order column, and with a column named as a search export has it."""
    amounts = table(spark, sf_dir, "events").selectExpr(
        "cast(event_id div 3 as decimal(10,0)) as amount", "event_type as _source"
    )
    contract = p.Contract(
        "amounts", "v1", "amounts", (p.Field("amount", "float"), p.Field("_source", "string")),
        (p.Rule("amount", allow_duplicates=False), p.Rule("_source", required=True)),
    )
    records = p.typed_records(amounts)
    found = p.contract_findings(records, contract).select("field", "rule", "observed")
    report = p.contract_report(records, contract).select("records", "total_violations")
    return found.crossJoin(F.broadcast(report))  # one row


def bronze_lag_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over the lag to the ingestion time, which is the time of the reading."""
    events = p.enrich(timed_events(spark, sf_dir)).drop("ingestion_timestamp")
    lagged = p.with_lag(events, "event_timestamp", "_bronze_ingestion_ts")
    metrics = p.tumbling_metrics(lagged, event_batches(spark, sf_dir), timedelta(hours=1))
    return metrics.select("window_start", "total_events")


def lag_of_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zeros, not a missing row, where there is no event."""
    lagged = p.with_lag(timed_events(spark, sf_dir))
    return p.lag_summary(lagged.where("event_id < 0")).select("total_events", "p99_lag_ms")


# Texts that look like a time but have no whole date, or name a zone.
NO_TIMES = ["12:30:00", "T10:00", "2026", "2026-01", "2026-01-01T10:00:00 America/New_York"]


def raw_event_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of raw records, whose event time is ISO text or broken."""
    odd = F.get(F.array(*map(F.lit, NO_TIMES)), (F.col("n") % 41).cast("int"))
    time = F.concat(F.lit('"event_time": "'), odd, F.lit('"'))
    broken = F.regexp_replace("value", F.lit('"event_time": "[^"]*"'), time)
    lines = dirty_lines(spark, sf_dir).withColumn("value", F.coalesce(broken, "value"))
    records = p.raw_records(lines, order_by="n")
    events = p.materialize(p.with_event_time(records), "timed").df
    late_by = F.expr(f"make_dt_interval(0, 0, 0, ({DELAY_MS.replace('event_id', 'n')}) / 1000)")
    arrived = F.coalesce("event_timestamp", F.lit("2000-01-01").cast("timestamp")) + late_by
    lagged = p.with_lag(events.withColumn("ingestion_timestamp", arrived))
    measured = p.lag_summary(lagged)
    return measured.crossJoin(F.broadcast(p.unmeasured_events(lagged)))  # one row each


def raw_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late raw records: every 37th is two days behind, a day is allowed."""
    events = p.with_event_time(dirty_records(spark, sf_dir)).selectExpr(
        "n",
        "case when n % 37 = 0 then event_timestamp - interval 2 days else event_timestamp end "
        "as event_timestamp",
        "n div 500 as batch",
    )
    marked = p.with_late_flag(events, "event_timestamp", "batch", [], timedelta(days=1))
    return marked.where("is_late").select("n")


FRACTION_US = 2_700_500_000


def stream_sla_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a width that is no whole number of seconds."""
    folder = p.shared_folder(spark, "sla")
    events = _event_stream(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.expr("((event_id * 7919) % 9973) * 1000").alias("lag_us"),
    )
    width = timedelta(microseconds=FRACTION_US)
    p.sla_stream(events, folder, width=width).awaitTermination()
    metrics = spark.read.parquet(f"{folder}/metrics")
    start = F.unix_micros("window_start").alias("start_us")
    return metrics.select(start, "total_events", "p99_lag_ms", "throughput_events_per_sec")


def stream_contract_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose first batch holds blank lines only."""
    folder = p.shared_folder(spark, "feed")
    blank = table(spark, sf_dir, "region").select(F.lit("  ").alias("value")).coalesce(1)
    blank.write.text(f"{folder}/in/a")
    contract = p.Contract("any", "v1", "any", (p.Field("event_id", "string", False),))
    for _ in range(2):
        lines = spark.readStream.text(f"{folder}/in/*")
        p.contract_stream(lines, contract, f"{folder}/out").awaitTermination()
        dirty_lines(spark, sf_dir).select("value").write.mode("overwrite").text(f"{folder}/in/b")
    rows = spark.read.parquet(f"{folder}/out/rows")
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("records"))


QUERIES = {
    "bronze_keeps_every_line": bronze_keeps_every_line,
    "publish_limited": publish_limited,
    "publish_rejects": publish_rejects,
    "envelope_text_kept": envelope_text_kept,
    "dedupe_null_order": dedupe_null_order,
    "quality_duplicates_decimal": quality_duplicates_decimal,
    "contract_report_unordered": contract_report_unordered,
    "bronze_lag_windows": bronze_lag_windows,
    "lag_of_nothing": lag_of_nothing,
    "raw_event_lag": raw_event_lag,
    "raw_late_events": raw_late_events,
    "stream_sla_fraction": stream_sla_fraction,
    "stream_contract_blank": stream_contract_blank,
}

_MIXED = f"mixed as (select {MIXED_LINE} as line, trim({MIXED_LINE}) as j from events)"
_RAW = f"""{LINES_SQL},
raw as (select n, case when json_type(j, '$.event_time') = 'VARCHAR'
  then cast(replace(replace(json_extract_string(j, '$.event_time'), 'T', ' '), 'Z', '')
       as timestamp) end as t from lines)"""
_LAG = f"(({DELAY_MS.replace('event_id', 'n')}) * 1000)"

ORACLE = {
    "bronze_keeps_every_line": f"""with {_MIXED}
select line, count(*) over () as rows_read,
  count(*) filter (not json_valid(j) or j[1] <> '{{') over () as rows_bad
from mixed where j <> ''""",
    "publish_limited": f"""with judged as (
  select event_id, trim({MIXED_LINE}) as j from events where trim({MIXED_LINE}) <> ''),
ranked as (select *, count(*) filter (json_valid(j)) over (order by event_id) as good from judged),
sent as (select * from ranked where good < 100 or (good = 100 and json_valid(j)))
select count(*) filter (json_valid(j)) as envelopes,
  count(*) filter (not json_valid(j)) as rejected, count(*) as attempted,
  count(*) filter (json_valid(j)) as published, count(*) filter (not json_valid(j)) as failed
from sent""",
    "publish_rejects": f"""with {_MIXED}
select j as value, json_valid(j) as good, count(*) over () as attempted,
  count(*) filter (json_valid(j)) over () as published,
  count(*) filter (not json_valid(j)) over () as failed
from mixed where j <> ''""",
    "envelope_text_kept": """select md5(concat('odd "topic" ', repeat(concat(chr(92), 'x'), 20000)))
    as topic, 'loader' as client_id,
  concat('{"id": ', event_id, ', "price": ', event_id, '.10, "big": 12345678901234567890.',
    event_id, ', "far": 1e400, "text": "a \\"}, b', chr(8232), ' ', chr(133), '"}') as value
from events""",
    "dedupe_null_order": """with placed as (
  select *, case when doc_id % 7 > 0 then doc_id // 3 end as place from documents),
seen as (select *, count(*) over (partition by text, lang) as n,
  min(place) over (partition by text, lang) as first from placed)
select doc_id, place from seen where n = 1 or place is not distinct from first""",
    "quality_duplicates_decimal": """select min(event_id) as first_seen, count(*) as copies
from events where event_id % 3 < 2 group by event_id // 3 having count(*) > 1""",
    "contract_report_unordered": """with repeated as (
  select event_id // 3 as amount from events group by 1 having count(*) > 1)
select 'amount' as field, 'duplicates' as rule,
  concat((select count(*) from repeated), ' values') as observed,
  (select count(*) from events) as records, 1 as total_violations""",
    "bronze_lag_windows": f"""with {TIMED_SQL}, starts as (
  select time_bucket(interval 1 hour, event_timestamp) as s from timed
  union all
  select event_timestamp - interval 1 hour from timed
  where event_timestamp = time_bucket(interval 1 hour, event_timestamp))
select s as window_start, count(*) as total_events from starts group by s""",
    "lag_of_nothing": """select cast(0 as bigint) as total_events,
  cast(0 as double) as p99_lag_ms""",
    "raw_event_lag": f"""with {_RAW},
measured as (select {_LAG} as lag_us from raw where t is not null and n % 41 >= {len(NO_TIMES)}),
{_summary("", 5000000, "measured")}
select s.*, e.* from summary s, (select count(*) as events,
  count(*) filter (t is null or n % 41 < {len(NO_TIMES)}) as unmeasured_events from raw) e""",
    "raw_late_events": f"""with {_RAW}, shifted as (
  select n, n // 500 as b, case when n % 37 = 0 then t - interval 2 days else t end as t from raw),
latest as (select b, max(t) as m from shifted group by b),
seen as (select b, max(m) over (order by b
    rows between unbounded preceding and 1 preceding) as s from latest)
select n from shifted join seen using (b) where t < s - interval 1 day""",
    "stream_sla_fraction": f"""with dated as (
  select epoch_us(ts) as t, ((event_id * 7919) % 9973) * 1000 as lag_us from events),
starts as (select lag_us, t // {FRACTION_US} * {FRACTION_US} as start_us from dated
  union all select lag_us, t - {FRACTION_US} from dated where t % {FRACTION_US} = 0),
{_summary("start_us", 5000000, "starts")}
select start_us, total_events, p99_lag_ms,
  total_events / {FRACTION_US / 1e6} as throughput_events_per_sec
from summary where start_us + {FRACTION_US} <= (select max(t) from dated) - 600000000""",
    "stream_contract_blank": f"""with {LINES_SQL}
select case when json_type(j, '$.event_id') = 'VARCHAR' then 'valid' else 'quarantine' end
  as status, count(*) as records from lines group by all""",
}
