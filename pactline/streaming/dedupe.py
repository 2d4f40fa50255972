"""Duplicate deliveries on a stream."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactline.functions.clock import to_micros
from pactline.operators.duplicates import row_digest
from pactline.streaming.late import late_stream, on_time_stream, split_late

_KEYS = "_key binary, kind string, batch bigint, _day date"


def first_deliveries(
    events: DataFrame, keys: Sequence[str], event_ts: str, delay: timedelta
) -> DataFrame:
    """Keep one event per key; keys are forgotten when the watermark passes.

    ``delay`` must cover the real disorder of the stream: events older than the
    watermark are dropped along with repeated ones.
    """
    late = f"{to_micros(delay) // 1000} milliseconds"
    return events.withWatermark(event_ts, late).dropDuplicatesWithinWatermark(list(keys))


def dedupe_stream(
    events: DataFrame, keys: Sequence[str], event_ts: str, delay: timedelta, folder: str
) -> StreamingQuery:
    """Write the first delivery of each key to ``<folder>/rows``; late ones are lost."""
    return (
        first_deliveries(events, keys, event_ts, delay)
        .writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def dedupe_all(
    events: DataFrame, keys: Sequence[str], event_ts: str, delay: timedelta, folder: str
) -> StreamingQuery:
    """Write the first delivery of each key to ``<folder>/rows``, however late it is.

    Copies of a key are one event, so they have one event time. Rows are split
    by a durable watermark. Those in time go through the state, which forgets a
    key once copies of it can only be late. What is delivered is logged, 16
    bytes a key, by day of its event. A late row is delivered if it is the first
    of its batch and the log of its days does not have its key, so only late
    rows read the log, and only some days of it. Rows without a time count as
    one of the first day there is.

    Everything that a micro-batch writes is overwritten when it is retried, and
    a late batch does not read its own log. The call returns with the last of
    its three queries, as each needs what the one before has written.
    """
    spark = events.sparkSession
    split_late(events, folder, event_ts, delay).awaitTermination()
    day = F.to_date(F.coalesce(F.col(event_ts).cast("timestamp"), F.timestamp_seconds(F.lit(0))))

    def named(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"_key": short_digest(rows, keys), "_day": day})

    def deliver(rows: DataFrame, kind: str, batch_id: int) -> None:
        place = f"kind={kind}/batch={batch_id}"
        rows.drop("_key", "_day").write.mode("overwrite").parquet(f"{folder}/rows/{place}")
        # From the rows that were written, so that both tell of the same ones.
        written = spark.read.schema(events.schema).parquet(f"{folder}/rows/{place}")
        log = named(written).select("_key", "_day").repartition("_day")
        log.write.mode("overwrite").partitionBy("_day").parquet(f"{folder}/keys/{place}")

    def in_time(batch: DataFrame, batch_id: int) -> None:
        deliver(batch, "on-time", batch_id)

    def behind(batch: DataFrame, batch_id: int) -> None:
        rows = named(batch).dropDuplicates(["_key"])
        days = rows.agg(F.min("_day"), F.max("_day")).first()
        log = spark.read.schema(_KEYS).parquet(f"{folder}/keys")
        log = log.where((F.col("kind") == "on-time") | (F.col("batch") < batch_id))
        if days[0] is not None:
            log = log.where(F.col("_day").between(*map(F.lit, days)))
        deliver(rows.join(log.select("_key"), "_key", "left_anti"), "late", batch_id)

    def run(stream: DataFrame, write, name: str) -> StreamingQuery:
        return (
            stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{folder}/checkpoint-{name}")
            .trigger(availableNow=True)
            .start()
        )

    fresh = first_deliveries(on_time_stream(spark, events, folder), keys, event_ts, delay)
    run(fresh, in_time, "on-time").awaitTermination()
    return run(late_stream(spark, events, folder), behind, "late")


def short_digest(rows: DataFrame, keys: Sequence[str]) -> Column:
    """Sixteen bytes of a digest over the named columns; nulls are values."""
    return F.substring(row_digest(rows, keys), 1, 16)
