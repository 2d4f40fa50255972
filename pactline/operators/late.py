"""Late events: older than what their source had already shown, less a delay."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactline.functions.clock import micros, to_micros
from pactline.session import broadcast_if, materialize

# Batches per block of the two-level running maximum.
BLOCK = 4096


def with_late_flag(
    df: DataFrame, event_ts: str, batch: str, by: Sequence[str], allowed: timedelta
) -> DataFrame:
    """Add ``is_late``: before the latest event of all earlier batches, less ``allowed``.

    This is what a stream with that watermark would see, for batches numbered
    in a BIGINT column. The running maximum is taken over one row per batch,
    first within blocks of batches and then over the blocks, so no task sorts
    all batches of a source.
    """
    at = micros(F.col(event_ts), df.schema[event_ts].dataType)
    # A struct as key keeps sources whose name is null.
    source = F.struct(*by, F.lit(0).alias("_any")).alias("_late_source")
    latest = (
        df.select(source, F.col(batch).cast("bigint").alias("_late_batch"), at.alias("_at"))
        .groupBy("_late_source", "_late_batch")
        .agg(F.max("_at").alias("_latest"))
        .withColumn("_block", F.floor(F.col("_late_batch") / BLOCK))
    )
    blocks = latest.groupBy("_late_source", "_block").agg(F.max("_latest").alias("_latest"))
    earlier_blocks = blocks.select(
        "_late_source", "_block", _max_before("_late_source", order="_block").alias("_old")
    )
    seen = materialize(
        latest.withColumn("_new", _max_before("_late_source", "_block", order="_late_batch"))
        .join(earlier_blocks, ["_late_source", "_block"])
        .select("_late_source", "_late_batch", F.greatest("_old", "_new").alias("_late_seen")),
        "seen-before",
    )
    marked = df.withColumns({"_late_source": source, "_late_batch": F.col(batch).cast("bigint")}).join(
        broadcast_if(seen.small(), seen.df), ["_late_source", "_late_batch"], "left"
    )
    late = F.coalesce(at < F.col("_late_seen") - to_micros(allowed), F.lit(False))
    columns = [F.col(f"`{c}`") for c in df.columns]
    return marked.select(*columns, late.alias("is_late"))


def _max_before(*partition: str, order: str) -> Column:
    window = Window.partitionBy(*partition).orderBy(order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.max("_latest").over(before)
