"""Batch ingestion into the bronze layer, with an ingest log."""

from __future__ import annotations

import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactline.functions.values import is_well_formed, parse_document, strip
from pactline.sinks.bronze import BronzeSink, enrich, write_bronze
from pactline.sources.inferred import read_with_schema

# What batches and micro-batches both log.
COMMON_LOG = (
    "batch_id string, rows_read bigint, rows_written bigint, batch_duration_sec double, "
    "schema_fields int, status string, error_message string"
)
LOG_SCHEMA = f"{COMMON_LOG}, rows_bad bigint, batch_start timestamp, batch_end timestamp"
# The line as it came, beside its fields.
RAW_LINE = "_raw_line"


def batch_label(batch_id: int | None) -> str:
    """``batch_<id>``, or ``ad_hoc`` without an id. Batch 0 has a label too."""
    return "ad_hoc" if batch_id is None else f"batch_{batch_id}"


def ingest_batch(
    spark: SparkSession,
    source: str,
    target: str,
    batch_id: int | None = None,
    schema: str | None = None,
    mode: str = "jsonl",
) -> Row:
    """Read a source, enrich it, write ``<target>_bronze_<label>``; a log row.

    The source is scanned once. Every line stays as it came in ``_raw_line``, so
    nothing is lost where the schema does not fit; ``rows_bad`` counts the lines
    that are not one JSON object. ``schema_fields`` does not count the raw line.
    Any failure ends in a ``failed`` log row. ``batch_start`` and ``batch_end``
    let the log serve as the batches of ``window_metrics``.
    """
    label = batch_label(batch_id)
    began, start = time.monotonic(), datetime.now(UTC)
    read = bad = 0
    try:
        rows = read_with_schema(spark, source, schema, raw=RAW_LINE)
        line = strip(F.col(RAW_LINE))
        sound = is_well_formed(parse_document(line), line) & line.startswith("{")
        seen = Observation()
        counted = rows.observe(
            seen, F.count(F.lit(1)).alias("read"), F.count_if(~sound).alias("bad")
        )
        rows = enrich(counted)
        done = write_bronze(rows, BronzeSink(f"{target}_bronze_{label}", mode, "overwrite"))
        error, width = done.get("error"), len(rows.schema) - 1
        written, status = done["rows_written"], done["status"]
        if status == "success":
            read, bad = seen.get.get("read") or 0, seen.get.get("bad") or 0
    except Exception as problem:  # noqa: BLE001 - becomes a log row
        error, width, written, status = str(problem), 0, 0, "failed"
    took = time.monotonic() - began if status == "success" else 0.0
    return Row(
        batch_id=label,
        rows_read=read,
        rows_written=written,
        batch_duration_sec=took,
        schema_fields=width,
        status=status,
        error_message=error,
        rows_bad=bad,
        batch_start=start,
        batch_end=datetime.now(UTC),
    )


def ingest_log(spark: SparkSession, rows: list[Row]) -> DataFrame:
    """Log rows as a DataFrame for ``run_summary``; what a row lacks is null."""
    names = T.StructType.fromDDL(LOG_SCHEMA).fieldNames()
    return spark.createDataFrame([[r.asDict().get(n) for n in names] for r in rows], LOG_SCHEMA)
