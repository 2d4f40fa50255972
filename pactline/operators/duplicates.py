"""Duplicate values of a field, and duplicate rows of a table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactline.contracts import Contract, as_contracts
from pactline.functions.values import short_key
from pactline.records import Records, column, falls_under, unfold
from pactline.session import broadcast_if, materialize


def unique_rules(contracts: Sequence[Contract]) -> list[tuple[int, Contract, int, str]]:
    """(number, contract, place of the rule, field) of every no-duplicates rule."""
    rules = [
        (c, place, r.field)
        for c in contracts
        for place, r in enumerate(c.rules)
        if not r.allow_duplicates
    ]
    return [(n, *rule) for n, rule in enumerate(rules)]


def duplicate_keys(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """Values that occur more than once under a no-duplicates rule.

    One scan feeds the rules of all contracts. Keys have a bounded length and
    are counted in the map tasks first, so one value held by a third of all
    rows reaches the shuffle as one row per task. Columns: ``rule_id``,
    ``key``, ``copies``, ``first_seen`` (null for records without ``order_by``).
    """
    chosen = as_contracts(contracts)
    rules = unique_rules(chosen)
    df, found = records.with_kinds([field for *_, field in rules], chosen)
    unordered = records.order_by is None
    seen = F.lit(None).cast("bigint") if unordered else column(records.order_by)
    keyed = rule_keys(records, rules, found, route)
    # Blank the rules that do not apply before they become rows.
    kept = [F.when(k["key"].isNotNull(), k) for k in keyed]
    return (
        unfold(df, kept, seen.alias("first_seen"))
        .groupBy("rule_id", "key")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("first_seen").alias("first_seen"))
        .where("copies > 1")
    )


def rule_keys(
    records: Records, rules: list[tuple[int, Contract, int, str]], found: dict[str, str], route: bool
) -> list[Column]:
    """Per no-duplicates rule its number and the record's key, NULL where it does not apply."""
    return [
        F.struct(
            F.lit(n).alias("rule_id"),
            F.when(falls_under(c, route), records.key(field, found[field])).alias("key"),
        )
        for n, c, _, field in rules
    ]


def duplicate_samples(
    records: Records,
    contracts: Contract | Iterable[Contract],
    route: bool = True,
    size: int = 3,
) -> DataFrame:
    """The first-seen duplicate values of each no-duplicates rule, as one text.

    Only rows with at least one duplicate value come out: ``dataset``,
    ``place`` (of the rule), ``field``, ``observed``.
    """
    chosen = as_contracts(contracts)
    rules = unique_rules(chosen)
    if not rules:
        none = "dataset string, place int, field string, observed string"
        return records.df.sparkSession.createDataFrame([], none)
    if records.order_by is None:
        # Without an order no value is the first: their number stands for them.
        counted = duplicate_keys(records, chosen, route).groupBy("rule_id")
        number = F.concat(F.count(F.lit(1)).cast("string"), F.lit(" values")).alias("observed")
        return _about(counted.agg(number), rules)
    order = Window.partitionBy("rule_id").orderBy("first_seen")
    first = (
        duplicate_keys(records, chosen, route)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= size)
        .select("rule_id", "rank", "first_seen")
    )
    # At most `size` rows per rule of the contracts, so a broadcast is safe;
    # the values are looked up again by place, which keeps them out of the shuffle.
    hits = records.df.join(F.broadcast(first), column(records.order_by) == F.col("first_seen"))
    named = records.over(hits, "rule_id", "rank")
    df, found = named.with_kinds([field for *_, field in rules], [])
    shown = F.coalesce(
        *(F.when(F.col("rule_id") == n, named.shown(f, found[f])) for n, _, _, f in rules)
    )
    listed = F.array_sort(F.collect_list(F.struct("rank", shown.alias("shown"))))
    text = F.concat(F.lit("["), F.array_join(listed["shown"], ", "), F.lit("]"))
    return _about(df.groupBy("rule_id").agg(text.alias("observed")), rules)


def _about(observed: DataFrame, rules: list[tuple[int, Contract, int, str]]) -> DataFrame:
    """Name the dataset, place and field of each rule."""
    about = [
        F.when(
            F.col("rule_id") == n,
            F.struct(
                F.lit(c.dataset).alias("dataset"),
                F.lit(place).alias("place"),
                F.lit(field).alias("field"),
            ),
        )
        for n, c, place, field in rules
    ]
    return observed.select(F.coalesce(*about).alias("about"), "observed").select(
        "about.*", "observed"
    )


def duplicate_values(df: DataFrame, column: str, order_by: str) -> DataFrame:
    """Values of one column that occur more than once, named by their first row.

    Grouping by a bounded key keeps long texts out of the shuffle.
    """
    text = F.col(column).cast("string")
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(short_key(text).alias("key"))
        .agg(F.count(F.lit(1)).alias("copies"), F.min(order_by).alias("first_seen"))
        .where("copies > 1")
        .select("first_seen", "copies")
    )


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 over the named columns, with a length before each value."""
    parts = []
    for name in columns:
        value = column(name)
        plain = isinstance(df.schema[name].dataType, T.AtomicType)
        text = value.cast("string") if plain else F.to_json(F.struct(value))
        parts += [F.coalesce(F.length(text).cast("string"), F.lit("-")), F.lit(":")]
        parts.append(F.coalesce(text, F.lit("")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def exact_duplicates(df: DataFrame, columns: Sequence[str], order_by: str) -> DataFrame:
    """Groups of rows equal in all named columns: first row and copies."""
    return (
        df.groupBy(row_digest(df, columns).alias("digest"))
        .agg(F.count(F.lit(1)).alias("copies"), F.min(order_by).alias("first_seen"))
        .where("copies > 1")
        .select("first_seen", "copies")
    )


def keep_first(df: DataFrame, columns: Sequence[str], order_by: str) -> DataFrame:
    """Drop every copy of a row that comes later by ``order_by``.

    Nulls come last. Rows that share the first place of their group all stay,
    as nothing tells which of them is the first. Rows meet their group's first
    place by digest: few repeated rows are broadcast, many are joined, and a row
    copied very often is split by size there. Both ways give the same rows.
    """
    digest, first = "_pactline_digest", "_pactline_first"
    rows_by_digest = df.select(
        row_digest(df, columns).alias(digest), column(order_by).alias(first)
    ).groupBy(digest)
    repeated = materialize(
        rows_by_digest.agg(F.count(F.lit(1)).alias("copies"), F.min(first).alias(first))
        .where("copies > 1")
        .select(digest, first, F.lit(True).alias("_pactline_repeated")),
        "repeated-rows",
    )
    marked = df.withColumn(digest, row_digest(df, columns)).join(
        broadcast_if(repeated.small(), repeated.df), digest, "left"
    )
    kept = F.col("_pactline_repeated").isNull() | column(order_by).eqNullSafe(F.col(first))
    return marked.where(kept).select(*map(column, df.columns))
