"""Bronze layer: metadata columns and writers that count what they write."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

INGEST_TS, DATA_SOURCE = "_bronze_ingestion_ts", "_data_source"

# Name of the default source, and writer mode -> Spark format.
SOURCE_NAME = "kafka-mock"
FORMATS = {
    "jsonl": "json",
    "json": "json",
    "parquet": "parquet",
    "delta": "delta",
    "iceberg": "iceberg",
}


@dataclass(frozen=True)
class BronzeSink:
    """Where and how bronze rows are written."""

    path: str
    mode: str = "jsonl"
    save_mode: str = "append"
    checkpoint: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.mode not in FORMATS:
            raise ValueError(f"unknown bronze mode {self.mode!r}; known: {sorted(FORMATS)}")


def enrich(df: DataFrame, source_name: str = SOURCE_NAME) -> DataFrame:
    """Add the ingestion time (one per query or micro-batch) and the source."""
    return df.withColumns(
        {INGEST_TS: F.current_timestamp(), DATA_SOURCE: F.lit(source_name)}
    )


def write_bronze(df: DataFrame, sink: BronzeSink) -> dict:
    """Write in one pass; rows are counted while they are written.

    A failed write is reported, not raised, with status ``failed``.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(FORMATS[sink.mode]).mode(sink.save_mode).options(**sink.options)
    if FORMATS[sink.mode] == "json":
        # A null that is not written would read back as an absent field.
        writer = writer.option("ignoreNullFields", "false")
    result = {"output_path": sink.path, "writer_type": sink.mode}
    try:
        writer.save(sink.path)
    except Exception as error:  # noqa: BLE001 - reported to the caller
        return result | {"rows_written": 0, "status": "failed", "error": str(error)}
    return result | {"rows_written": seen.get.get("rows", 0), "status": "success"}
