"""Ingestion lag, percentiles, throughput and SLA violations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactline.functions.clock import from_micros, micros, to_micros
from pactline.operators.ranks import with_ranks
from pactline.operators.sweep import sweep
from pactline.session import BROADCAST_ROWS, broadcast_if

# Default SLA limit, reported percentiles, default window.
SLA_MS = 5000.0
PERCENTILES = {"p50": 0.5, "p99": 0.99}
WINDOW = timedelta(minutes=5)

EVENT_TS, INGEST_TS = "event_timestamp", "ingestion_timestamp"


def with_lag(df: DataFrame, event_ts: str = EVENT_TS, ingest_ts: str = INGEST_TS) -> DataFrame:
    """Add ``lag_us`` (whole microseconds) and ``lag_ms``; both may be negative."""
    ends = (micros(F.col(c), df.schema[c].dataType) for c in (ingest_ts, event_ts))
    lag = next(ends) - next(ends)
    return df.withColumn("lag_us", lag).withColumn("lag_ms", _ms(F.col("lag_us")))


def breaks_sla(sla_ms: float = SLA_MS) -> Column:
    """Strictly above the limit, compared in microseconds."""
    return F.col("lag_us") > F.lit(sla_ms * 1000.0)


def sla_violations(df: DataFrame, by: Sequence[str] = (), sla_ms: float = SLA_MS) -> DataFrame:
    """Events, violations and violation rate per group."""
    counted = df.groupBy(*by).agg(
        F.count("lag_us").alias("total_events"),
        F.count_if(breaks_sla(sla_ms)).alias("sla_violations"),
    )
    return counted.withColumn("sla_violation_rate", _share("sla_violations", "total_events"))


def lag_percentiles(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact p50 and p99: the lag at index ``int(n * p)`` of the sorted lags."""
    ranked = with_ranks(df.where("lag_us is not null"), by, "lag_us", PERCENTILES)
    found = ranked.select(
        *by,
        F.col("n").alias("total_events"),
        *(_ms(F.col(p)).alias(f"{p}_lag_ms") for p in PERCENTILES),
    )
    return found if by else _one_row(found)


def _one_row(metrics: DataFrame) -> DataFrame:
    """Metrics without groups: zeros where there was no event."""
    zeros = [F.coalesce(F.max(c), F.lit(0).cast(t)).alias(c) for c, t in metrics.dtypes]
    return metrics.agg(*zeros)


def unmeasured_events(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Events per group that the lag metrics leave out, as one of their times is missing."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("lag_us").isNull()).alias("unmeasured_events"),
    )


def approx_lag_percentiles(
    df: DataFrame, by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """p50 and p99 from a sketch, in one pass; rank error at most n / accuracy."""
    return df.groupBy(*by).agg(
        F.count("lag_us").alias("total_events"),
        *(
            _ms(F.percentile_approx("lag_us", p, accuracy)).alias(f"{name}_lag_ms")
            for name, p in PERCENTILES.items()
        ),
    )


def lag_summary(
    df: DataFrame, by: Sequence[str] = (), sla_ms: float = SLA_MS, weight: str | None = None
) -> DataFrame:
    """Events, average, maximum, p50, p99, violations and rate per group.

    The lags are summed as integers, of any size, and divided once, so the result
    does not depend on the order of the rows.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    lags = F.col("lag_us") if weight is None else F.col("lag_us").cast("decimal(20,0)") * times
    late = F.when(breaks_sla(sla_ms), times).otherwise(F.lit(0))
    totals = [
        ("lag_sum", "wide_sum", lags),
        ("lag_max", "max", F.col("lag_us")),
        ("sla_violations", "sum", late.cast("bigint")),
    ]
    ranked = with_ranks(
        df.where("lag_us is not null"), by, "lag_us", PERCENTILES, totals, weight
    )
    found = ranked.select(
        *by,
        F.col("n").alias("total_events"),
        (F.col("lag_sum").cast("double") / F.col("n") / 1000.0).alias("avg_lag_ms"),
        _ms(F.col("lag_max")).alias("max_lag_ms"),
        *(_ms(F.col(p)).alias(f"{p}_lag_ms") for p in PERCENTILES),
        "sla_violations",
        _share("sla_violations", "n").alias("sla_violation_rate"),
    )
    return found if by else _one_row(found)


def latency_histogram(df: DataFrame, edges_ms: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Events per half-open interval [min_ms, max_ms), open-ended at both sides."""
    bounds = [None, *edges_ms, None]
    lag = F.col("lag_us")
    buckets = []
    for low, high in zip(bounds, bounds[1:]):
        above = F.lit(True) if low is None else lag >= low * 1000.0
        below = F.lit(True) if high is None else lag < high * 1000.0
        limits = (F.lit(low).cast("double").alias("min_ms"), F.lit(high).cast("double").alias("max_ms"))
        buckets.append(F.when(above & below, F.struct(*limits)))
    return (
        df.where("lag_us is not null")
        .groupBy(*by, F.coalesce(*buckets).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(*by, "bucket.*", "events")
    )


def batch_throughput(
    batches: DataFrame, start: str = "batch_start", end: str = "batch_end", count: str = "event_count"
) -> DataFrame:
    """Add the duration of each batch in seconds and its events per second."""
    took = micros(F.col(end), batches.schema[end].dataType) - micros(
        F.col(start), batches.schema[start].dataType
    )
    rate = F.when(F.col("duration_sec") > 0, F.col(count) / F.col("duration_sec"))
    return batches.withColumn("duration_sec", took / 1e6).withColumn(
        "throughput_events_per_sec", F.coalesce(rate, F.lit(0.0))
    )


def tumbling_metrics(
    events: DataFrame,
    batches: DataFrame,
    width: timedelta = WINDOW,
    sla_ms: float = SLA_MS,
    event_ts: str = EVENT_TS,
    batch_start: str = "batch_start",
) -> DataFrame:
    """All metrics per tumbling window, both ends of a window included.

    An event exactly on a boundary belongs to both its neighbours. Windows
    without events do not appear.
    """
    step = to_micros(width)
    dtype = events.schema[event_ts].dataType
    inside = events.select("lag_us", F.explode(closed_starts(events, event_ts, step)).alias("_start"))
    begun = (
        batches.select(F.explode(closed_starts(batches, batch_start, step)).alias("_start"))
        .groupBy("_start")
        .agg(F.count(F.lit(1)).alias("total_batches"))
    )
    lags = lag_summary(inside, ["_start"], sla_ms)
    metrics = lags.join(begun, "_start", "left").withColumns(
        {
            "window_start": from_micros(F.col("_start"), dtype),
            "window_end": from_micros(F.col("_start") + step, dtype),
            "_seconds": F.lit(max(step / 1e6, 1.0)),
        }
    )
    return window_rows(metrics)


def window_metrics(
    events: DataFrame,
    batches: DataFrame,
    windows: Sequence[tuple[datetime, datetime]],
    sla_ms: float = SLA_MS,
    event_ts: str = EVENT_TS,
    batch_start: str = "batch_start",
) -> DataFrame:
    """All metrics for each listed window, both ends included.

    Windows may overlap and differ in length. A window without events has 0
    everywhere, its batches included. An event is counted once, whatever the
    number of windows it is in (see ``sweep``).
    """
    spark, dtype = events.sparkSession, events.schema[event_ts].dataType
    listed = spark.createDataFrame(list(windows), T.StructType(
        [T.StructField("window_start", dtype), T.StructField("window_end", dtype)]
    )).withColumns(
        {
            "_from": micros(F.col("window_start"), dtype),
            "_to": micros(F.col("window_end"), dtype),
        }
    )
    spans = sorted({(r["_from"], r["_to"]) for r in listed.select("_from", "_to").collect()})
    lags = events.where("lag_us is not null").select(
        micros(F.col(event_ts), dtype).alias("_at"), "lag_us"
    )
    began = micros(F.col(batch_start), batches.schema[batch_start].dataType)
    found = sweep(lags, batches.select(began.alias("_at")), spans, PERCENTILES, sla_ms)
    few = len(spans) <= BROADCAST_ROWS
    metrics = listed.join(broadcast_if(few, found), ["_from", "_to"], "left").select(
        "window_start",
        "window_end",
        "total_events",
        "total_batches",
        (F.col("lag_sum").cast("double") / F.col("total_events") / 1000.0).alias("avg_lag_ms"),
        _ms(F.col("lag_max")).alias("max_lag_ms"),
        *(_ms(F.col(p)).alias(f"{p}_lag_ms") for p in PERCENTILES),
        "sla_violations",
        _share("sla_violations", "total_events").alias("sla_violation_rate"),
        F.greatest((F.col("_to") - F.col("_from")) / 1e6, F.lit(1.0)).alias("_seconds"),
    )
    return window_rows(metrics)


def run_summary(log: DataFrame) -> DataFrame:
    """Totals over an ingest log; every status but ``success`` is a failure."""
    count = F.count(F.lit(1))
    return log.agg(
        count.alias("total_batches"),
        F.coalesce(F.sum("rows_read"), F.lit(0)).alias("total_rows_read"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("total_rows_written"),
        F.count_if(F.col("status") == "success").alias("successful_batches"),
        F.count_if(F.coalesce(F.col("status") != "success", F.lit(True))).alias("failed_batches"),
        F.coalesce(F.try_divide(F.sum("rows_read"), count), F.lit(0.0)).alias("avg_rows_per_batch"),
    )


def rounded(metrics: DataFrame) -> DataFrame:
    """Metrics as they are reported: 2 digits, the violation rate 4."""
    digits = {c: 4 if c.endswith("_rate") else 2 for c, t in metrics.dtypes if t == "double"}
    return metrics.withColumns({c: F.bround(c, d) for c, d in digits.items()})


def closed_starts(df: DataFrame, ts: str, step: int) -> Column:
    """Starts of the closed tumbling windows a timestamp falls into: one or two."""
    at = micros(F.col(ts), df.schema[ts].dataType)
    start = at - F.pmod(at, F.lit(step))
    return F.when(at == start, F.array(start, start - step)).otherwise(F.array(start))


def window_rows(metrics: DataFrame) -> DataFrame:
    events = F.coalesce("total_events", F.lit(0))
    batches = F.when(events > 0, F.coalesce("total_batches", F.lit(0))).otherwise(F.lit(0))
    numbers = ("avg_lag_ms", "max_lag_ms", "p50_lag_ms", "p99_lag_ms")
    return metrics.select(
        "window_start",
        "window_end",
        events.cast("bigint").alias("total_events"),
        batches.cast("bigint").alias("total_batches"),
        *(F.coalesce(c, F.lit(0.0)).alias(c) for c in numbers),
        (events / F.col("_seconds")).alias("throughput_events_per_sec"),
        (batches / F.col("_seconds")).alias("throughput_batches_per_sec"),
        F.coalesce("sla_violations", F.lit(0)).cast("bigint").alias("sla_violations"),
        F.coalesce("sla_violation_rate", F.lit(0.0)).alias("sla_violation_rate"),
    )


def _ms(us: Column) -> Column:
    return us / F.lit(1000.0)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))
