"""Reports as JSON events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.operators.sla import rounded

# Names of the events.
WINDOW_COMPLETE = "ingestion_metrics_window_complete"
REPORT_COMPLETE = "contract_validation_complete"


def emit_metrics(metrics: DataFrame, path: str) -> None:
    """Append one JSON event per window, with the metrics rounded for reading."""
    _emit(rounded(metrics), WINDOW_COMPLETE, "metrics", path)


def emit_report(report: DataFrame, path: str) -> None:
    """Append one JSON event per contract of a report."""
    _emit(report, REPORT_COMPLETE, "report", path)


def _emit(df: DataFrame, event: str, name: str, path: str) -> None:
    said = df.select(
        F.lit(event).alias("event"),
        F.current_timestamp().alias("timestamp"),
        F.struct(*df.columns).alias(name),
    )
    said.write.mode("append").option("ignoreNullFields", "false").json(path)
