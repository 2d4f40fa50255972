"""Contract verdicts over everything a stream has brought so far."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactline.contracts import Contract, as_contracts
from pactline.operators.duplicates import rule_keys, unique_rules
from pactline.operators.quality_rules import Lag, totals_of
from pactline.operators.schema_rules import checked_names, kind_columns, kind_text
from pactline.plans.report import report_of
from pactline.records import SOURCE, STATE, raw_records, unfold

# What is known after a batch: shapes of records with their number (rule -1),
# and the no-duplicates rules that a repeated value has broken.
_KNOWN = "rule_id int, key string, state string, source string, records bigint"
_SHAPE = -1


def contract_watch(
    lines: DataFrame,
    contracts: Contract | Iterable[Contract],
    folder: str,
    observed_max_lag_ms: Lag = None,
    route: bool = True,
) -> StreamingQuery:
    """The report of all micro-batches up to each one, in ``<folder>/report``.

    The state of the stream is one count per shape of a record and one per key
    of a no-duplicates rule, in the state store and spread over all tasks: a
    value that comes back after any number of micro-batches is a duplicate. Of
    the counts that a batch changes, only shapes and the rules that have a
    repeated key are carried on, a few rows in ``<folder>/known``, from which
    the report follows as that of a whole table does.

    A batch that is retried gives the same report: counts only grow, so the
    larger of the old and the new one is the true one.
    """
    chosen = as_contracts(contracts)
    rules = unique_rules(chosen)
    names = checked_names(chosen)
    records = raw_records(lines)
    df, found = records.with_kinds([*names, *(f for *_, f in rules)], chosen)
    shape = F.struct(
        F.lit(_SHAPE).alias("rule_id"),
        kind_text(names, found).alias("key"),
        F.col(STATE).alias("state"),
        F.col(SOURCE).alias("source"),
    )
    none = F.lit(None).cast("string")
    keys = [
        F.when(
            k["key"].isNotNull(),
            F.struct(k["rule_id"], k["key"], none.alias("state"), none.alias("source")),
        )
        for k in rule_keys(records, rules, found, route)
    ]
    counts = (
        unfold(df, [shape, *keys])
        .groupBy("rule_id", "key", "state", "source")
        .agg(F.count(F.lit(1)).alias("records"))
    )

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark, by = batch.sparkSession, ["rule_id", "key", "state", "source"]
        broken = (F.col("rule_id") == _SHAPE) | (F.col("records") > 1)
        # A repeated key stands for its rule; the keys themselves stay in the state.
        key = F.when(F.col("rule_id") == _SHAPE, F.col("key")).alias("key")
        news = batch.where(broken).select("rule_id", key, "state", "source", "records")
        if batch_id > 0:
            news = news.union(_known(spark, folder, batch_id - 1))
        news = news.groupBy(*by).agg(F.max("records").alias("records"))
        # Not coalesce: one task would then hold the counts of all shuffle partitions at once.
        news.repartition(1).write.mode("overwrite").parquet(f"{folder}/known/{batch_id}")
        known = _known(spark, folder, batch_id)
        shapes = known.where(F.col("rule_id") == _SHAPE)
        shapes = shapes.select(
            F.col("state").alias(STATE), F.col("source").alias(SOURCE), "records",
            F.col("key").alias("_kinds"),
        )
        shapes, columns = kind_columns(shapes, names)
        totals = totals_of(shapes, columns, chosen, route)
        repeated = known.where(F.col("rule_id") != _SHAPE).select("rule_id")
        report = report_of(totals, repeated, chosen, observed_max_lag_ms)
        report.coalesce(1).write.mode("overwrite").parquet(f"{folder}/report/batch_id={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(judge)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _known(spark, folder: str, batch_id: int) -> DataFrame:
    return spark.read.schema(_KNOWN).parquet(f"{folder}/known/{batch_id}")
