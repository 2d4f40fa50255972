"""Lag and throughput metrics per event-time window on a stream."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactline.functions.clock import from_micros, to_micros
from pactline.operators.ranks import wide_sum
from pactline.operators.sla import (
    EVENT_TS,
    PERCENTILES,
    SLA_MS,
    WINDOW,
    closed_starts,
    lag_summary,
    window_rows,
)
from pactline.streaming.late import on_time_stream, split_late


def closed_window_times(events: DataFrame, event_ts: str, width: timedelta) -> DataFrame:
    """Add ``window_time`` and ``window_end``; an event on a boundary also appears a tick earlier.

    Half-open windows over ``window_time`` then hold what closed windows over
    the event time hold.
    """
    step = to_micros(width)
    dtype = events.schema[event_ts].dataType
    starts = closed_starts(events, event_ts, step)
    tick = from_micros(F.col("_start") + step - 1, dtype)
    exploded = events.withColumn("_start", F.explode(starts))
    # Within its own window an event keeps its time; only the copy moves.
    times = {
        "window_time": F.least(F.col(event_ts), tick),
        "window_end": from_micros(F.col("_start") + step, dtype),
    }
    return exploded.withColumns(times).drop("_start")


def sla_stream(
    events: DataFrame,
    folder: str,
    width: timedelta = WINDOW,
    delay: timedelta = timedelta(minutes=10),
    sla_ms: float = SLA_MS,
    event_ts: str = EVENT_TS,
    batches: DataFrame | None = None,
    batch_start: str = "batch_start",
    keep_late: bool = False,
) -> StreamingQuery:
    """Exact metrics of every window the watermark closes, in ``<folder>/metrics``.

    State is one count per window and lag value, spread over all tasks, and is
    dropped when its window closes; no window is ever gathered in one place.
    A closed window's counts go to ``<folder>/lags`` and its percentiles are
    taken from there.

    ``batches`` is a stream with the start of every ingest batch. Its rows are
    counted in the same state, tagged, and a window closes when both streams
    have passed its end by ``delay``: metrics then are those of
    ``tumbling_metrics``, ``total_batches`` and batches per second included.
    Windows without events do not appear.

    Rows whose window is closed are dropped by the state. With ``keep_late``
    they are split off before it (``split_late``, once per window they belong
    to) and stay in ``<folder>/split``; this drains the stream twice, so the
    call returns when the split is done.
    """
    step, spark = to_micros(width), events.sparkSession
    late = f"{to_micros(delay) // 1000} milliseconds"
    timed = closed_window_times(events, event_ts, width)
    if keep_late:
        if batches is not None:
            raise ValueError("late rows are split off a single stream, without batches")
        split_late(timed, folder, "window_time", delay, "window_end").awaitTermination()
        timed = on_time_stream(spark, timed, folder)
    tagged = timed.withWatermark("window_time", late).select(
        "window_time", "lag_us", F.lit(False).alias("is_batch")
    )
    if batches is not None:
        # The watermark of a query is the least of its streams' watermarks.
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
        begun = closed_window_times(batches.select(batch_start), batch_start, width)
        nothing = F.lit(None).cast("bigint")
        tagged = tagged.union(
            begun.withWatermark("window_time", late).select("window_time", nothing, F.lit(True))
        )
    counts = (
        tagged.groupBy(F.window("window_time", f"{step} microseconds"), "is_batch", "lag_us")
        .agg(F.count(F.lit(1)).alias("times"))
        .select("window.*", "is_batch", "lag_us", "times")
    )

    def close(batch: DataFrame, batch_id: int) -> None:
        lags = f"{folder}/lags/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(lags)
        closed = batch.sparkSession.read.schema(batch.schema).parquet(lags)
        by = ["start", "end"]
        metrics = lag_summary(closed.where("not is_batch"), by, sla_ms, weight="times")
        if batches is None:
            per_second = F.col("total_events") / F.lit(max(step / 1e6, 1.0))
            metrics = metrics.withColumn("throughput_events_per_sec", per_second)
            metrics = metrics.withColumnsRenamed({"start": "window_start", "end": "window_end"})
        else:
            begun = closed.where("is_batch").groupBy(*by).agg(F.sum("times").alias("total_batches"))
            metrics = window_rows(
                metrics.join(begun, by, "left")
                .withColumnsRenamed({"start": "window_start", "end": "window_end"})
                .withColumn("_seconds", F.lit(max(step / 1e6, 1.0)))
            )
        metrics.write.mode("overwrite").parquet(f"{folder}/metrics/batch_id={batch_id}")

    return (
        counts.writeStream.outputMode("append")
        .foreachBatch(close)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def rank_error(k: int) -> float:
    """Share of ranks by which a sketch of size ``k`` may be off, at 99 % confidence."""
    # The published error of KLL sketches.
    return 2.296 / k**0.9021


def sla_sketch_stream(
    events: DataFrame,
    folder: str,
    width: timedelta = WINDOW,
    delay: timedelta = timedelta(minutes=10),
    sla_ms: float = SLA_MS,
    event_ts: str = EVENT_TS,
    k: int = 1000,
) -> StreamingQuery:
    """Metrics per window in bounded state: one row per window, however many events it has.

    Counts, average, maximum and violations are exact. ``p50_lag_ms`` and
    ``p99_lag_ms`` come from a mergeable KLL sketch of the lags, some 14 bytes
    times ``k`` large: a lag of the window whose rank is off by ``rank_error(k)``
    of the events at most. A window of fewer than ``k`` events is exact. Use
    ``sla_stream`` where percentiles must be exact.
    """
    step = to_micros(width)
    late = F.col("lag_us") > F.lit(sla_ms * 1000.0)
    windows = (
        closed_window_times(events.where("lag_us is not null"), event_ts, width)
        .withWatermark("window_time", f"{to_micros(delay) // 1000} milliseconds")
        .groupBy(F.window("window_time", f"{step} microseconds"))
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            wide_sum("lag_us").alias("_sum"),
            F.max("lag_us").alias("_max"),
            F.count_if(late).alias("sla_violations"),
            F.kll_sketch_agg_bigint("lag_us", F.lit(k)).alias("_sketch"),
        )
    )
    share = {f"p{int(part * 100)}_lag_ms": part for part in PERCENTILES.values()}
    metrics = windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total_events",
        (F.col("_sum").cast("double") / F.col("total_events") / 1000.0).alias("avg_lag_ms"),
        (F.col("_max") / 1000.0).alias("max_lag_ms"),
        *(
            (F.kll_sketch_get_quantile_bigint("_sketch", F.lit(part)) / 1000.0).alias(name)
            for name, part in share.items()
        ),
        "sla_violations",
        (F.col("sla_violations") / F.col("total_events")).alias("sla_violation_rate"),
        (F.col("total_events") / F.lit(max(step / 1e6, 1.0))).alias("throughput_events_per_sec"),
    )
    return (
        metrics.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{folder}/metrics")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
