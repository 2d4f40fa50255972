"""Lag, percentiles, throughput and SLA metrics over events and orders."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pactline as p
from workload.feeds import TIMED_SQL, event_batches, table, timed_events

# Overlapping windows, one of one hour whose ends carry events, one empty.
WINDOWS = [
    (datetime(2024, 1, 1), datetime(2024, 1, 2)),
    (datetime(2024, 1, 1, 12), datetime(2024, 1, 3)),
    (datetime(2024, 1, 5, 10), datetime(2024, 1, 5, 11)),
    (datetime(2024, 1, 10, 0), datetime(2024, 1, 10, 0, 5)),
    (datetime(2024, 1, 1), datetime(2024, 2, 1)),
    (datetime(2025, 1, 1), datetime(2025, 1, 2)),
]
# Ten thousand windows over one day, each overlapping thousands of others.
MANY = [
    (
        datetime(2024, 1, 3) + timedelta(seconds=n * 7919 % 43_200),
        datetime(2024, 1, 3) + timedelta(seconds=n * 7919 % 43_200 + n * 104_729 % 43_200),
    )
    for n in range(10_000)
]
EDGES_MS = [0, 100, 1000, 2500, 5000, 9000]
DAY_MS = 86_400_000.0


def lagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.with_lag(timed_events(spark, sf_dir))


def ship_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time from order to shipment per line item; many are negative.

    The percentiles look at their input twice, so the join is written once.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    joined = items.join(orders, items.l_orderkey == orders.o_orderkey)
    lags = p.with_lag(joined, "o_orderdate", "l_shipdate").select("o_orderpriority", "lag_us")
    return p.materialize(lags, "ship-lags", measure=False).df


def event_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lagged(spark, sf_dir).select("event_id", "lag_us", "lag_ms")


def sla_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.sla_violations(lagged(spark, sf_dir), ["event_type"])


def lag_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.lag_percentiles(lagged(spark, sf_dir), ["event_type"])


def lag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.lag_summary(lagged(spark, sf_dir))


def sla_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.window_metrics(lagged(spark, sf_dir), event_batches(spark, sf_dir), WINDOWS)


def sla_overlapping_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that overlap by the thousand; an event is counted once for all of them."""
    return p.window_metrics(lagged(spark, sf_dir), event_batches(spark, sf_dir), MANY)


def sla_tumbling_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.tumbling_metrics(lagged(spark, sf_dir), event_batches(spark, sf_dir))


def sla_reported_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = timedelta(minutes=10)
    metrics = p.tumbling_metrics(lagged(spark, sf_dir), event_batches(spark, sf_dir), width, 2000)
    return p.rounded(metrics).select("window_start", "total_events", "p50_lag_ms", "p99_lag_ms")


def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.latency_histogram(lagged(spark, sf_dir), EDGES_MS, ["event_type"])


def batch_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.batch_throughput(event_batches(spark, sf_dir))


def ship_lag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.lag_summary(ship_lags(spark, sf_dir), ["o_orderpriority"], sla_ms=30 * DAY_MS)


def ingest_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch a log row; every seventh one failed and read nothing."""
    failed = F.col("batch_id") % 7 == 3
    rows = F.when(failed, 0).otherwise(F.col("event_count"))
    log = event_batches(spark, sf_dir).select(
        rows.alias("rows_read"),
        rows.alias("rows_written"),
        F.when(failed, "failed").otherwise("success").alias("status"),
    )
    return p.run_summary(log)


def metrics_emission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window metrics written as JSON events and read back."""
    folder = p.shared_folder(spark, "metrics")
    metrics = p.tumbling_metrics(lagged(spark, sf_dir), event_batches(spark, sf_dir))
    p.emit_metrics(metrics, folder)
    said = spark.read.schema(
        "event string, timestamp timestamp, metrics struct<window_start: timestamp_ntz, "
        "total_events: bigint, max_lag_ms: double, sla_violations: bigint>"
    ).json(folder)
    return said.select("event", F.col("timestamp").isNotNull().alias("stamped"), "metrics.*")


QUERIES = {
    "metrics_emission": metrics_emission,
    "event_lag": event_lag,
    "sla_violations": sla_violations,
    "lag_percentiles": lag_percentiles,
    "lag_summary": lag_summary,
    "sla_window_metrics": sla_window_metrics,
    "sla_overlapping_windows": sla_overlapping_windows,
    "sla_tumbling_metrics": sla_tumbling_metrics,
    "sla_reported_metrics": sla_reported_metrics,
    "latency_histogram": latency_histogram,
    "batch_throughput": batch_throughput,
    "ship_lag_summary": ship_lag_summary,
    "ingest_run_summary": ingest_run_summary,
}

_D = "cast({} as double)"


def _summary(by: str, sla_us: int, source: str) -> str:
    """Summary of ``lag_us`` per group; p50 and p99 by their place in the order."""
    keys = f"{by}, " if by else ""
    over = f"partition by {by}" if by else ""
    group = f"group by {by}" if by else ""
    return f"""ranked as (select *, row_number() over ({over} order by lag_us) - 1 as idx,
    count(*) over ({over}) as n from {source}),
summary as (select {keys}count(*) as total_events,
    cast(sum(lag_us) as double) / count(*) / 1000 as avg_lag_ms,
    max(lag_us) / 1000 as max_lag_ms,
    max(lag_us) filter (idx = n // 2) / 1000 as p50_lag_ms,
    max(lag_us) filter (idx = n * 99 // 100) / 1000 as p99_lag_ms,
    count(*) filter (lag_us > {sla_us}) as sla_violations,
    count(*) filter (lag_us > {sla_us}) / count(*) as sla_violation_rate
  from ranked {group})"""


def _tumbling(minutes: int, sla_us: int) -> str:
    us = minutes * 60_000_000
    return f"""starts as (
  select lag_us, epoch_us(event_timestamp) // {us} * {us} as s from timed
  union all
  select lag_us, epoch_us(event_timestamp) - {us} from timed
  where epoch_us(event_timestamp) % {us} = 0),
{_summary("s", sla_us, "starts")},
begun as (select s, count(*) as total_batches from (
    select epoch_us(batch_start) // {us} * {us} as s from batches
    union all
    select epoch_us(batch_start) - {us} from batches where epoch_us(batch_start) % {us} = 0)
  group by s),
metrics as (select make_timestamp(s) as window_start, make_timestamp(s + {us}) as window_end,
    total_events, coalesce(total_batches, 0) as total_batches, avg_lag_ms, max_lag_ms,
    p50_lag_ms, p99_lag_ms, total_events / {minutes * 60} as throughput_events_per_sec,
    coalesce(total_batches, 0) / {minutes * 60} as throughput_batches_per_sec,
    sla_violations, sla_violation_rate
  from summary left join begun using (s))"""


def _listed(windows: str) -> str:
    """Metrics of the windows that a query lists."""
    return f"""with {TIMED_SQL},
windows(window_start, window_end) as ({windows}),
hits as (select window_start, window_end, lag_us from windows join timed
  on event_timestamp between window_start and window_end),
{_summary("window_start, window_end", 5000000, "hits")},
begun as (select window_start, window_end, count(*) as total_batches from windows join batches
  on batch_start between window_start and window_end group by all),
timed_windows as (select *, greatest(epoch_us(window_end) - epoch_us(window_start), 1000000)
  / 1000000 as seconds from windows)
select window_start, window_end, coalesce(total_events, 0) as total_events,
  case when total_events > 0 then coalesce(total_batches, 0) else 0 end as total_batches,
  coalesce(avg_lag_ms, 0) as avg_lag_ms, coalesce(max_lag_ms, 0) as max_lag_ms,
  coalesce(p50_lag_ms, 0) as p50_lag_ms, coalesce(p99_lag_ms, 0) as p99_lag_ms,
  coalesce(total_events, 0) / seconds as throughput_events_per_sec,
  case when total_events > 0 then coalesce(total_batches, 0) else 0 end / seconds
    as throughput_batches_per_sec,
  coalesce(sla_violations, 0) as sla_violations,
  coalesce(sla_violation_rate, 0) as sla_violation_rate
from timed_windows left join summary using (window_start, window_end)
  left join begun using (window_start, window_end)"""


_WINDOW_ROWS = ", ".join(f"(timestamp '{a}', timestamp '{b}')" for a, b in WINDOWS)
_EDGE_ROWS = ", ".join(
    f"({'null' if a is None else a}, {'null' if b is None else b})"
    for a, b in zip([None, *EDGES_MS], [*EDGES_MS, None])
)

ORACLE = {
    "metrics_emission": f"""with {TIMED_SQL}, {_tumbling(5, 5000000)}
select 'ingestion_metrics_window_complete' as event, true as stamped, window_start, total_events,
  round_even(max_lag_ms, 2) as max_lag_ms, sla_violations from metrics""",
    "event_lag": f"""with {TIMED_SQL}
select event_id, lag_us, lag_us / 1000 as lag_ms from timed""",
    "sla_violations": f"""with {TIMED_SQL}
select event_type, count(*) as total_events,
  count(*) filter (lag_us > 5000000) as sla_violations,
  count(*) filter (lag_us > 5000000) / count(*) as sla_violation_rate
from timed group by event_type""",
    "lag_percentiles": f"""with {TIMED_SQL}, {_summary("event_type", 5000000, "timed")}
select event_type, total_events, p50_lag_ms, p99_lag_ms from summary""",
    "lag_summary": f"""with {TIMED_SQL}, {_summary("", 5000000, "timed")}
select * from summary""",
    "sla_window_metrics": _listed(f"values {_WINDOW_ROWS}"),
    "sla_overlapping_windows": _listed(
        """select timestamp '2024-01-03' + (n * 7919 % 43200) * interval 1 second,
  timestamp '2024-01-03' + (n * 7919 % 43200 + n * 104729 % 43200) * interval 1 second
  from range(10000) t(n)"""
    ),
    "sla_tumbling_metrics": f"with {TIMED_SQL}, {_tumbling(5, 5000000)} select * from metrics",
    "sla_reported_metrics": f"""with {TIMED_SQL}, {_tumbling(10, 2000000)}
select window_start, total_events, round_even(p50_lag_ms, 2) as p50_lag_ms,
  round_even(p99_lag_ms, 2) as p99_lag_ms from metrics""",
    "latency_histogram": f"""with {TIMED_SQL},
edges(min_ms, max_ms) as (values {_EDGE_ROWS})
select event_type, cast(min_ms as double) as min_ms, cast(max_ms as double) as max_ms,
  count(*) as events
from timed join edges on (min_ms is null or lag_us >= min_ms * 1000)
  and (max_ms is null or lag_us < max_ms * 1000) group by all""",
    "batch_throughput": f"""with {TIMED_SQL}, took as (
  select *, (epoch_us(batch_end) - epoch_us(batch_start)) / 1000000 as duration_sec from batches)
select *, case when duration_sec > 0 then event_count / duration_sec else 0 end
  as throughput_events_per_sec from took""",
    "ship_lag_summary": f"""with shipped as (select o_orderpriority,
    epoch_us(l_shipdate) - epoch_us(o_orderdate) as lag_us
  from lineitem join orders on l_orderkey = o_orderkey),
{_summary("o_orderpriority", 30 * 86_400_000_000, "shipped")}
select * from summary""",
    "ingest_run_summary": f"""with {TIMED_SQL}, log as (
  select case when batch_id % 7 = 3 then 0 else event_count end as rows,
    batch_id % 7 <> 3 as ok from batches)
select count(*) as total_batches, cast(sum(rows) as bigint) as total_rows_read,
  cast(sum(rows) as bigint) as total_rows_written, count(*) filter (ok) as successful_batches,
  count(*) filter (not ok) as failed_batches,
  cast(sum(rows) as double) / count(*) as avg_rows_per_batch
from log""",
}
