"""Dataset-level contract rules: required, null ratio, duplicates, freshness."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactline.contracts import Contract, Rule, as_contracts
from pactline.functions.kinds import NULL
from pactline.operators.duplicates import duplicate_samples
from pactline.operators.schema_rules import kind_counts, with_rules
from pactline.records import STATE, Records

# The largest lag seen, in milliseconds: one number, or one per dataset.
Lag = float | int | Mapping[str, float | int] | None

FINDING_FIELDS = (
    "dataset", "position", "step", "field", "rule", "expected", "observed", "message",
)


def contract_totals(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """One row with everything the contracts count, from one pass over the data.

    Per contract ``i``: ``records_i``, ``broken_i`` (schema violations) and
    ``nulls_i_j`` (null or absent values) per quality rule ``j``; for raw lines
    also ``bad_lines`` and ``other_lines`` (JSON, but no object).
    """
    chosen = as_contracts(contracts)
    counts, found = kind_counts(records, chosen)
    return totals_of(counts, found, chosen, route)


def totals_of(
    counts: DataFrame, found: dict[str, str], chosen: list[Contract], route: bool = True
) -> DataFrame:
    """The totals from counts per combination of kinds."""
    counts, _ = with_rules(counts, chosen, found, route)

    def total(condition: str, name: str) -> Column:
        return F.expr(f"coalesce(sum(if({condition}, records, 0)), 0) as {name}")

    sums = [total(f"{STATE} = 'bad'", "bad_lines"), total(f"{STATE} = 'other'", "other_lines")]
    for i, c in enumerate(chosen):
        rules = " + ".join(f"int(_rule_{i}_{j} is not null)" for j in range(len(c.fields)))
        sums.append(total(f"_in_{i}", f"records_{i}"))
        sums.append(F.expr(f"coalesce(sum(records * ({rules})), 0) as broken_{i}"))
        for j, rule in enumerate(c.rules):
            kind = found[rule.field]
            empty = f"({kind} is null or {kind} = '{NULL}')"
            sums.append(total(f"_in_{i} and {empty}", f"nulls_{i}_{j}"))
    return counts.agg(*sums)


def null_counts(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """Records, null or absent values and their ratio per quality rule."""
    chosen = as_contracts(contracts)
    rows = [
        F.struct(
            F.lit(c.dataset).alias("dataset"),
            F.lit(j).alias("position"),
            F.lit(rule.field).alias("field"),
            F.col(f"records_{i}").alias("records"),
            F.col(f"nulls_{i}_{j}").alias("nulls"),
            _ratio(i, j).alias("null_ratio"),
        )
        for i, c in enumerate(chosen)
        for j, rule in enumerate(c.rules)
    ]
    return contract_totals(records, chosen, route).select(F.inline(F.array(*rows)))


def null_findings(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """Broken ``required`` and ``max_null_ratio`` rules."""
    chosen = as_contracts(contracts)
    rows = [f for i, c in enumerate(chosen) for f in null_rule_findings(i, c)]
    empty = F.filter(F.array(_finding("", 0, 0, "", "", "", F.lit(""), F.lit(""))), lambda _: F.lit(False))
    found = F.array_compact(F.array(*rows)) if rows else empty
    return contract_totals(records, chosen, route).select(F.inline(found))


def null_rule_findings(i: int, contract: Contract) -> list[Column]:
    """Per null rule a finding struct, NULL where the rule holds."""
    found = []
    for j, rule in enumerate(contract.rules):
        nulls = F.col(f"nulls_{i}_{j}")
        for step, name, broken, expected, observed, message in _null_rules(i, j, rule, nulls):
            row = _finding(contract.dataset, j, step, rule.field, name, expected, observed, message)
            found.append(F.when(broken, row))
    return found


def null_rules_broken(i: int, contract: Contract) -> Column:
    """Number of broken null rules of a contract."""
    broken = [
        F.when(condition, 1).otherwise(0)
        for j, rule in enumerate(contract.rules)
        for _, _, condition, *_ in _null_rules(i, j, rule, F.col(f"nulls_{i}_{j}"))
    ]
    return sum(broken, F.lit(0)).cast("bigint")


def duplicate_findings(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """Broken no-duplicates rules, with the first three duplicate values."""
    samples = duplicate_samples(records, as_contracts(contracts), route)
    # The name, expectation and message of the reports.
    return samples.select(
        "dataset",
        F.col("place").alias("position"),
        F.lit(2).alias("step"),
        "field",
        F.lit("duplicates").alias("rule"),
        F.lit("unique values").alias("expected"),
        "observed",
        F.format_string("Field %s contains duplicate values", "field").alias("message"),
    )


def freshness_broken(contract: Contract, lag: Lag) -> bool:
    limit, seen = contract.max_lag_ms, lag_of(contract, lag)
    return limit is not None and seen is not None and seen > limit


def lag_of(contract: Contract, lag: Lag) -> float | int | None:
    return lag.get(contract.dataset) if isinstance(lag, Mapping) else lag


def freshness_findings(df: DataFrame, contract: Contract, lag_ms: str = "lag_ms") -> DataFrame:
    """The freshness rule against the largest lag of a DataFrame; 0 or 1 row."""
    limit = contract.max_lag_ms
    seen = df.agg(F.max(lag_ms).alias("seen")).where(
        F.lit(False) if limit is None else F.col("seen") > limit
    )
    row = freshness_finding(contract, F.col("seen").cast("string"))
    return seen.select(row.alias("found")).select("found.*")


def freshness_finding(contract: Contract, observed: Column) -> Column:
    # Fixed value: the message of the reports.
    message = F.lit("Observed ingestion lag exceeded freshness threshold")
    return _finding(
        contract.dataset,
        len(contract.rules),
        3,
        "freshness",
        "max_lag_ms",
        str(contract.max_lag_ms),
        observed,
        message,
    )


def _null_rules(i: int, j: int, rule: Rule, nulls: Column) -> list[tuple]:
    """(step, rule, broken, expected, observed, message) of a rule's null checks."""
    # The names, expectations and messages of the reports.
    checks: list[tuple] = []
    if rule.required:
        message = F.format_string(
            f"Field {rule.field.replace('%', '%%')} is required but %d records are null or missing",
            nulls,
        )
        checks.append(
            (0, "required", nulls > 0, "0 null or missing values", nulls.cast("string"), message)
        )
    if rule.max_null_ratio is not None:
        ratio = _ratio(i, j)
        shown = F.format_string("%.4f", F.bround(ratio, 4))
        checks.append(
            (
                1,
                "max_null_ratio",
                F.coalesce(ratio > rule.max_null_ratio, F.lit(False)),
                str(rule.max_null_ratio),
                shown,
                F.lit(f"Field {rule.field} exceeded null ratio threshold"),
            )
        )
    return checks


def _ratio(i: int, j: int) -> Column:
    """Share of null or absent values; NULL for a dataset without records."""
    return F.try_divide(F.col(f"nulls_{i}_{j}"), F.col(f"records_{i}"))


def _finding(
    dataset: str,
    position: int,
    step: int,
    field: str,
    rule: str,
    expected: str,
    observed: Column,
    message: Column,
) -> Column:
    parts = (dataset, position, step, field, rule, expected)
    values = [*map(F.lit, parts), observed, message]
    return F.struct(*(v.alias(n) for n, v in zip(FINDING_FIELDS, values)))
