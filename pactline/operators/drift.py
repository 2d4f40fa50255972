"""Drift and bad-value detectors: what changed against the contract.

These findings stand beside the contract report and never count in it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactline.contracts import Contract, Field, as_contracts
from pactline.functions import kinds
from pactline.operators.schema_rules import kind_counts
from pactline.records import DOCUMENT, Records, falls_under, unfold

NUMERIC = ("integer", "float")


def unexpected_fields(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """Keys that records carry beyond their contract, with record counts."""
    chosen = as_contracts(contracts)
    if records.typed:
        return _unexpected_columns(records, chosen, route)
    df, _ = records.with_kinds([], chosen)
    # From the document that is parsed already; its keys are in order.
    df = df.withColumn("_keys", F.map_keys(_members()))
    rows = []
    for c in chosen:
        unknown = F.array_except("_keys", _texts(c.field_names))
        found = F.struct(F.lit(c.dataset).alias("dataset"), unknown.alias("unknown"))
        rows.append(F.when(falls_under(c, route), found))
    # Records fold into one row per set of unknown keys before these unfold.
    return (
        unfold(df, rows)
        .where(F.size("unknown") > 0)
        .groupBy("dataset", "unknown")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("dataset", F.explode("unknown").alias("field"), "n")
        .groupBy("dataset", "field")
        .agg(F.sum("n").alias("records"))
    )


def _members() -> Column:
    """The record's members by key."""
    return F.try_variant_get(F.col(DOCUMENT), "$[0]", "map<string,variant>")


def rename_candidates(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """Pairs of a missing field and an unknown key of a type the field accepts.

    Records fold into distinct (missing fields, unknown keys with types) first;
    pairs are formed once per such combination, not once per record.
    """
    if records.typed:
        raise ValueError("rename candidates need raw records, whose keys can vary")
    chosen = as_contracts(contracts)
    df, seen = records.with_kinds([n for c in chosen for n in c.field_names], chosen)
    whole = _members()
    rows = []
    for i, c in enumerate(chosen):
        gone = F.array_compact(
            F.array(*(F.when(F.col(seen[f.name]).isNull(), f.name) for f in c.fields))
        )
        unknown = F.map_filter(whole, _not_in(c.field_names))
        entries = F.transform(
            F.map_entries(unknown),
            lambda e: F.struct(
                e["key"].alias("key"), F.schema_of_variant(e["value"]).alias("schema")
            ),
        )
        # Only records that miss a field pay for looking at their unknown keys.
        found = F.struct(
            F.lit(i).alias("contract"), gone.alias("gone"), F.array_sort(entries).alias("unknown")
        )
        rows.append(F.when(falls_under(c, route) & (F.size(gone) > 0), found))
    drifted = (
        unfold(df, rows)
        .where(F.size("unknown") > 0)
        .groupBy("contract", "gone", "unknown")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    accepts = F.create_map(
        *(
            part
            for i, c in enumerate(chosen)
            for f in c.fields
            for part in (F.lit(f"{i}.{f.name}"), _texts(list(kinds.ACCEPTED.get(f.type, ()))))
        )
    )
    dataset = F.element_at(_texts([c.dataset for c in chosen]), F.col("contract") + 1)
    pairs = (
        drifted.select("contract", "unknown", "n", F.explode("gone").alias("missing_field"))
        .select("contract", "missing_field", "n", F.inline("unknown"))
        .withColumn("kind", F.expr(kinds.kind_sql("schema")))
        .withColumn(
            "fits", accepts[F.concat(F.col("contract").cast("string"), F.lit("."), "missing_field")]
        )
        .where((F.size("fits") == 0) | F.array_contains("fits", F.col("kind")))
    )
    return pairs.groupBy(
        dataset.alias("dataset"), "missing_field", F.col("key").alias("candidate")
    ).agg(F.sum("n").alias("records"))


def type_profile(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """Records per dataset, field and observed type (``absent`` and ``null`` too)."""
    chosen = as_contracts(contracts)
    counts, seen = kind_counts(records, chosen)
    rows = [
        F.when(
            falls_under(c, route),
            F.struct(
                F.lit(c.dataset).alias("dataset"),
                F.lit(f.name).alias("field"),
                F.expr(f"coalesce({kinds.name_sql(seen[f.name])}, 'absent')").alias("observed_type"),
            ),
        )
        for c in chosen
        for f in c.fields
    ]
    return (
        unfold(counts, rows, "records")
        .groupBy("dataset", "field", "observed_type")
        .agg(F.sum("records").alias("records"))
    )


def field_profile(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """Presence and null share of every contract field."""
    kind, n = F.col("observed_type"), F.col("records")
    counted = (
        type_profile(records, contracts, route)
        .groupBy("dataset", "field")
        .agg(
            F.sum("records").alias("records"),
            F.sum(F.when(kind != "absent", n).otherwise(F.lit(0))).alias("present"),
            F.sum(F.when(kind == "null", n).otherwise(F.lit(0))).alias("nulls"),
        )
    )
    return counted.withColumn("presence_ratio", F.try_divide("present", "records"))


def bad_values(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """Negative numbers per numeric field and blank texts per string field.

    One aggregate over one pass, without a group key: the shuffle holds one row
    per task.
    """
    chosen = as_contracts(contracts)
    fields = [(c, f) for c in chosen for f in c.fields if _bad_name(f)]
    if not fields:
        raise ValueError("no contract field is a number or a text")
    df, seen = records.with_kinds([f.name for _, f in fields], chosen)
    totals = [
        F.count_if(falls_under(c, route) & _is_bad(records, f, F.col(seen[f.name]))).alias(f"_bad_{n}")
        for n, (c, f) in enumerate(fields)
    ]
    rows = [
        F.struct(
            F.lit(c.dataset).alias("dataset"),
            F.lit(f.name).alias("field"),
            F.lit(_bad_name(f)).alias("check"),
            F.col(f"_bad_{n}").alias("records"),
        )
        for n, (c, f) in enumerate(fields)
    ]
    return df.agg(*totals).select(F.inline(F.array(*rows)))


def _not_in(names: list[str]) -> Callable[[Column, Column], Column]:
    return lambda key, _: ~key.isin(names)


def _bad_name(f: Field) -> str | None:
    if f.type in NUMERIC:
        return "negative"
    return "blank" if f.type == "string" else None


def _is_bad(records: Records, f: Field, kind: Column) -> Column:
    if f.type in NUMERIC:
        bad = kind.isin(*kinds.NUMBERS) & (records.number(f.name) < 0)
    else:
        bad = (kind == kinds.TEXT) & (F.btrim(records.text(f.name)) == "")
    return F.coalesce(bad, F.lit(False))


def _unexpected_columns(records: Records, chosen: list[Contract], route: bool) -> DataFrame:
    df, _ = records.with_kinds([], chosen)
    counted = df.agg(
        *(F.count_if(falls_under(c, route)).alias(f"_in_{i}") for i, c in enumerate(chosen))
    )
    rows = [
        F.struct(
            F.lit(c.dataset).alias("dataset"),
            F.lit(name).alias("field"),
            F.col(f"_in_{i}").alias("records"),
        )
        for i, c in enumerate(chosen)
        for name in records.passthrough
        if name not in c.field_names
    ]
    none = "dataset string, field string, records bigint"
    if not rows:
        return df.sparkSession.createDataFrame([], none)
    return counted.select(F.inline(F.array(*rows))).where("records > 0")


def _texts(names: list[str]) -> Column:
    return F.array(*map(F.lit, names)).cast("array<string>")
