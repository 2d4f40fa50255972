"""Contract checks on a stream: sound records, quarantine, report per batch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactline.contracts import Contract, as_contracts
from pactline.operators.schema_rules import with_rules
from pactline.plans.report import contract_report, enforce
from pactline.records import LINE, STATE, raw_records

SEQUENCE = "_sequence"


def contract_stream(
    lines: DataFrame,
    contracts: Contract | Iterable[Contract],
    folder: str,
    fail_on_violation: bool = False,
) -> StreamingQuery:
    """Split a stream of JSON lines by contract into ``<folder>/rows``.

    Rows land under ``status=valid``, ``status=quarantine`` (with their
    violations) or ``status=unmatched`` (of no contract's source). Quality
    rules look at one micro-batch; their verdicts go to ``<folder>/report``.
    The report reads the lines back from what was written, so a batch is
    pulled from its source once.
    """
    chosen = as_contracts(contracts)

    def check(batch: DataFrame, batch_id: int) -> None:
        path = f"{folder}/rows/batch_id={batch_id}"
        numbered = batch.select("value", F.monotonically_increasing_id().alias(SEQUENCE))
        rows = split_records(numbered, chosen)
        rows.write.mode("overwrite").partitionBy("status").parquet(path)
        # With the schema, as a batch of blank lines leaves no file to take it from.
        written = batch.sparkSession.read.schema(rows.schema).parquet(path).where("first_row")
        records = raw_records(written.select("value", SEQUENCE), order_by=SEQUENCE)
        report = contract_report(records, chosen)
        report.coalesce(1).write.mode("overwrite").parquet(f"{folder}/report/batch_id={batch_id}")
        if fail_on_violation:
            saved = batch.sparkSession.read.parquet(f"{folder}/report/batch_id={batch_id}")
            enforce(saved.where("records > 0 or bad_lines > 0 or other_lines > 0"))

    return (
        lines.writeStream.foreachBatch(check)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def split_records(df: DataFrame, contracts: list[Contract]) -> DataFrame:
    """Each line with its dataset, violations and status, in one projection.

    A line under several contracts gives one row for each; ``first_row`` marks
    one of them.
    """
    records = raw_records(df, order_by=SEQUENCE)
    parsed, found = records.with_kinds([n for c in contracts for n in c.field_names], contracts)
    parsed, violations = with_rules(parsed, contracts, found)
    held = [
        F.when(
            F.col(f"_in_{i}"),
            F.struct(
                F.lit(c.dataset).alias("dataset"),
                F.array_compact(F.array(*violations[i])).alias("violations"),
            ),
        )
        for i, c in enumerate(contracts)
    ]
    # posexplode_outer keeps lines that no contract holds, as one row of nulls.
    rows = parsed.where(F.col(LINE) != "").select(
        F.col(LINE).alias("value"),
        SEQUENCE,
        STATE,
        F.posexplode_outer(F.array_compact(F.array(*held))).alias("place", "held"),
    )
    status = (
        F.when(F.col(STATE) != "object", "quarantine")
        .when(F.col("held").isNull(), "unmatched")
        .when(F.size("held.violations") > 0, "quarantine")
        .otherwise("valid")
    )
    return rows.select(
        "value",
        SEQUENCE,
        (F.coalesce("place", F.lit(0)) == 0).alias("first_row"),
        "held.dataset",
        "held.violations",
        status.alias("status"),
    )
