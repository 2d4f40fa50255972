"""Micro-batch ingestion into the bronze layer with Structured Streaming."""

from __future__ import annotations

import time
from datetime import timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactline.functions.clock import micros, to_micros
from pactline.plans.ingest import COMMON_LOG, batch_label
from pactline.sinks.bronze import enrich
from pactline.sources.envelope import unwrap
from pactline.sources.inferred import parse_lines

STREAM_LOG = COMMON_LOG + ", late_rows bigint, latest_event_us bigint"


def bronze_stream(
    lines: DataFrame,
    schema: str,
    folder: str,
    event_ts: str | None = None,
    allowed: timedelta = timedelta(days=1),
    enveloped: bool = False,
) -> StreamingQuery:
    """Drain a stream of JSON lines into ``<folder>/rows`` and ``<folder>/log``.

    Each micro-batch is one job: parse, enrich, write, and count what is
    written. Rows and log row of a batch go to a folder of their own that is
    overwritten, so a batch that is retried after a failure leaves no copies.
    With ``event_ts``, rows older than everything earlier batches had shown,
    less ``allowed``, are marked ``is_late`` before any watermark drops them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        seen = Observation()
        events = unwrap(batch).select("value") if enveloped else batch
        rows = enrich(parse_lines(events, schema, raw="_raw"))
        latest = _latest_before(batch, folder, batch_id)
        at = F.lit(None).cast("bigint")
        if event_ts is not None:
            at = micros(F.col(event_ts), rows.schema[event_ts].dataType)
            limit = F.lit(None if latest is None else latest - to_micros(allowed))
            rows = rows.withColumn("is_late", F.coalesce(at < limit.cast("bigint"), F.lit(False)))
        late = F.col("is_late") if event_ts is not None else F.lit(False)
        counted = rows.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(late).alias("late"),
            F.max(at).alias("latest"),
        )
        entry = [batch_label(batch_id), 0, 0, 0.0, len(rows.schema), "success", None, 0, latest]
        try:
            counted.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")
            found = seen.get
            n, known = found.get("rows", 0), [latest, found.get("latest")]
            entry[1:4] = [n, n, time.monotonic() - began]
            entry[7:] = [found.get("late", 0), max((k for k in known if k is not None), default=None)]
        except Exception as problem:
            entry[5:7] = ["failed", str(problem)]
            raise
        finally:
            log = batch.sparkSession.createDataFrame([tuple(entry)], STREAM_LOG).coalesce(1)
            log.write.mode("overwrite").parquet(f"{folder}/log/batch_id={batch_id}")

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _latest_before(batch: DataFrame, folder: str, batch_id: int) -> int | None:
    """Latest event time of all earlier batches, as the last log row says."""
    if batch_id == 0:
        return None
    log = batch.sparkSession.read.schema(STREAM_LOG)
    return log.parquet(f"{folder}/log/batch_id={batch_id - 1}").head()["latest_event_us"]
