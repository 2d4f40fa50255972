"""Contract reports: every finding, the verdict per dataset, and the gate."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.contracts import Contract, as_contracts
from pactline.errors import EnforcementError, InputError
from pactline.operators.duplicates import duplicate_keys, unique_rules
from pactline.operators.quality_rules import (
    Lag,
    contract_totals,
    duplicate_findings,
    freshness_broken,
    freshness_finding,
    lag_of,
    null_findings,
    null_rules_broken,
)
from pactline.operators.schema_rules import schema_summary
from pactline.records import Records
from pactline.sources.lines import first_bad_line

FINDING = (
    "dataset string, position int, step int, field string, rule string, expected string, "
    "observed string, message string, check string, violations bigint"
)


def contract_findings(
    records: Records,
    contracts: Contract | Iterable[Contract],
    observed_max_lag_ms: Lag = None,
    route: bool = True,
) -> DataFrame:
    """All broken rules of all contracts.

    Schema rules come as one row per field, rule and observed type with the
    number of violations; quality rules as one row each.
    """
    chosen = as_contracts(contracts)
    schema = schema_summary(records, chosen, route).select(
        "dataset",
        "position",
        F.lit(0).alias("step"),
        "field",
        "rule",
        "expected",
        "observed",
        F.format_string("%d records break %s on field %s", "violations", "rule", "field").alias(
            "message"
        ),
        F.lit("schema").alias("check"),
        "violations",
    )
    late = [
        freshness_finding(c, F.lit(str(lag_of(c, observed_max_lag_ms))))
        for c in chosen
        if freshness_broken(c, observed_max_lag_ms)
    ]
    quality = [null_findings(records, chosen, route)]
    if unique_rules(chosen):
        quality.append(duplicate_findings(records, chosen, route))
    if late:
        spark = records.df.sparkSession
        quality.append(spark.range(1).select(F.inline(F.array(*late))))
    marked = [q.withColumns({"check": F.lit("quality"), "violations": F.lit(1)}) for q in quality]
    return reduce(DataFrame.unionByName, marked, schema.to(_finding_type(schema)))


def contract_report(
    records: Records,
    contracts: Contract | Iterable[Contract],
    observed_max_lag_ms: Lag = None,
    route: bool = True,
) -> DataFrame:
    """One row per contract: records, violations and the verdict.

    Two passes over the data at most: one that counts types, one that counts
    the keys of no-duplicates rules.
    """
    chosen = as_contracts(contracts)
    totals = contract_totals(records, chosen, route)
    repeated = duplicate_keys(records, chosen, route) if unique_rules(chosen) else None
    return report_of(totals, repeated, chosen, observed_max_lag_ms)


def report_of(
    totals: DataFrame, repeated: DataFrame | None, chosen: list[Contract], lag: Lag = None
) -> DataFrame:
    """The report from one row of totals and the ``rule_id`` of rules with repeated keys."""
    rows = [
        F.struct(
            F.lit(c.dataset).alias("dataset"),
            F.lit(c.name).alias("contract"),
            F.lit(c.version).alias("version"),
            F.col(f"records_{i}").alias("records"),
            F.col(f"broken_{i}").alias("schema_violations"),
            (
                null_rules_broken(i, c) + F.lit(int(freshness_broken(c, lag)))
            ).alias("quality_violations"),
            F.col("bad_lines"),
            F.col("other_lines"),
        )
        for i, c in enumerate(chosen)
    ]
    report = totals.select(F.inline(F.array(*rows)))
    rules = unique_rules(chosen)
    if rules:
        dataset = F.coalesce(*(F.when(F.col("rule_id") == n, c.dataset) for n, c, *_ in rules))
        per_dataset = (
            repeated.select("rule_id")
            .distinct()
            .groupBy(dataset.alias("dataset"))
            .agg(F.count(F.lit(1)).alias("repeated"))
        )
        # One row per contract on either side.
        report = report.join(F.broadcast(per_dataset), "dataset", "left").withColumn(
            "quality_violations",
            F.col("quality_violations") + F.coalesce("repeated", F.lit(0)),
        )
    total = F.col("schema_violations") + F.col("quality_violations")
    return report.select(
        "dataset",
        "contract",
        "version",
        "records",
        "schema_violations",
        "quality_violations",
        total.alias("total_violations"),
        (total == 0).alias("is_valid"),
        "bad_lines",
        "other_lines",
    )


def enforce(report: DataFrame, records: Records | None = None) -> list:
    """Raise unless every dataset of a report has records and is valid.

    The report holds one row per contract, so collecting it is cheap.
    """
    rows = report.collect()
    for row in rows:
        if row["bad_lines"] or row["other_lines"]:
            where = "" if records is None else f", first at {first_bad_line(records)}"
            raise InputError(
                f"{row['bad_lines']} lines are not JSON and {row['other_lines']} "
                f"are no JSON objects{where}"
            )
    for row in rows:
        if row["records"] == 0:
            raise EnforcementError(f"no records matched dataset {row['dataset']}")
    failed = {r["dataset"]: r["total_violations"] for r in rows if not r["is_valid"]}
    if failed:
        listed = ", ".join(f"{name} with {n} violations" for name, n in failed.items())
        raise EnforcementError(f"contract not met by {listed}")
    return rows


def _finding_type(df: DataFrame):
    return df.sparkSession.createDataFrame([], FINDING).schema
