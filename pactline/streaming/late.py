"""Rows that come behind the watermark: kept in a side table, and counted."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pactline.functions.clock import micros, to_micros

LOG = "batch_id bigint, watermark_us bigint, latest_us bigint, rows bigint, late_rows bigint"


def split_late(
    rows: DataFrame,
    folder: str,
    event_ts: str,
    delay: timedelta,
    until: str | None = None,
) -> StreamingQuery:
    """Split a stream into ``<folder>/on_time`` and ``<folder>/late``, losing no row.

    The watermark of a micro-batch is the latest event time of all earlier ones
    less ``delay``, as Spark's own; it is kept per batch in ``<folder>/log``. A
    row is late if its ``until`` (the end of its window, say; its event time if
    not given) is not after the watermark, and then no state could still take
    it. Rows without a time are on time. Both sides and the log of a batch are
    overwritten by a batch that is retried, and the watermark comes from the
    log, so a retry splits alike.

    A stateful query over ``<folder>/on_time`` with the same ``delay`` drops
    nothing, as it cannot have seen a later time than the split had.
    """
    kind = rows.schema[event_ts].dataType
    until_kind = rows.schema[until or event_ts].dataType

    def split(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        before = _log_row(spark, folder, batch_id - 1)
        latest = None if before is None else before["latest_us"]
        watermark = None if latest is None else latest - to_micros(delay)
        limit = F.lit(watermark).cast("bigint")
        ends = micros(F.col(until or event_ts), until_kind)
        marked = batch.withColumns(
            {
                "_at": micros(F.col(event_ts), kind),
                "is_late": F.coalesce(ends <= limit, F.lit(False)),
            }
        )
        counted = marked.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if("is_late").alias("late"),
            F.max("_at").alias("latest"),
        ).drop("_at")
        path = f"{folder}/split/batch_id={batch_id}"
        counted.write.mode("overwrite").partitionBy("is_late").parquet(path)
        found = seen.get
        known = [t for t in (latest, found.get("latest")) if t is not None]
        entry = (
            batch_id, watermark, max(known, default=None), found.get("rows", 0), found.get("late", 0),
        )
        # Literals, as a row from Python would cost a worker and half a second per batch.
        kept = zip(T.StructType.fromDDL(LOG).fieldNames(), entry, strict=True)
        log = spark.range(1, numPartitions=1).select(
            *(F.lit(n).cast("bigint").alias(name) for name, n in kept)
        )
        log.write.mode("overwrite").parquet(f"{folder}/log/{batch_id}")

    return (
        rows.writeStream.foreachBatch(split)
        .option("checkpointLocation", f"{folder}/split-checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _log_row(spark: SparkSession, folder: str, batch_id: int):
    if batch_id < 0:
        return None
    return spark.read.schema(LOG).parquet(f"{folder}/log/{batch_id}").head()


def split_log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per micro-batch: its watermark, its rows and how many of them were late."""
    return spark.read.schema(LOG).parquet(f"{folder}/log/*")


def late_side(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """The late rows of ``split_late``, with the columns of its input and ``batch_id``."""
    return _side(spark, rows, folder).where("is_late").drop("is_late")


def on_time_side(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """All other rows, as a table."""
    return _side(spark, rows, folder).where("not is_late").drop("is_late")


def late_stream(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """The late rows as a stream that takes up whatever batches are there at once."""
    stream = spark.readStream.schema(_split_schema(rows)).parquet(f"{folder}/split")
    return stream.where("is_late").drop("is_late", "batch_id")


def on_time_stream(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """All other rows as such a stream."""
    stream = spark.readStream.schema(_split_schema(rows)).parquet(f"{folder}/split")
    return stream.where("not is_late").drop("is_late", "batch_id")


def _side(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    return spark.read.schema(_split_schema(rows)).parquet(f"{folder}/split")


def _split_schema(rows: DataFrame) -> T.StructType:
    places = [T.StructField("batch_id", T.LongType()), T.StructField("is_late", T.BooleanType())]
    return T.StructType([*rows.schema.fields, *places])


def late_rows(query: StreamingQuery) -> int:
    """Rows that a run of a query dropped as late, over all its micro-batches.

    For window aggregates Spark counts after its partial aggregation, so late
    rows of one window, value and task count once there. Spark keeps the
    progress of a run's last micro-batches only; where earlier ones may be gone,
    the count could be incomplete, and this fails. ``split_late`` counts every
    row of any number of micro-batches.
    """
    progress = query.recentProgress
    kept = int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(progress) >= kept:
        raise RuntimeError(f"only the last {kept} micro-batches are known")
    return sum(
        state["numRowsDroppedByWatermark"] for p in progress for state in p["stateOperators"]
    )
