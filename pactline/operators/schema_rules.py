"""Record-level contract rules: presence, nullability and type of each field.

A record breaks at most one rule per field, in the order missing_field,
nullability, type_mismatch. All of it is projection: no shuffle, no join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactline.contracts import Contract, Field, as_contracts
from pactline.functions.kinds import ACCEPTED, NULL, name_sql
from pactline.functions.values import literal
from pactline.records import SOURCE, STATE, Records, column, falls_under, unfold

ABSENT = "---"


def rule_sql(f: Field, kind: str) -> str:
    """SQL for the name of the rule a field breaks, NULL where it breaks none."""
    cases = f"when {kind} is null then 'missing_field'"
    if not f.nullable:
        cases += f" when {kind} = '{NULL}' then 'nullability'"
    if f.type in ACCEPTED:
        accepted = ", ".join(f"'{k}'" for k in (NULL, *ACCEPTED[f.type]))
        cases += f" when {kind} not in ({accepted}) then 'type_mismatch'"
    return f"case {cases} end"


def violation_sql(dataset: str, position: int, f: Field, rule: str, kind: str) -> str:
    """SQL for a broken rule as a struct, NULL where ``rule`` is NULL."""
    kind_of_field = literal(f.type)
    return (
        f"if({rule} is null, null, named_struct('dataset', {literal(dataset)}, "
        f"'position', {position}, 'field', {literal(f.name)}, 'rule', {rule}, "
        f"'expected', if({rule} = 'nullability', 'non-null', {kind_of_field}), "
        f"'observed', coalesce({name_sql(kind)}, '')))"
    )


def with_rules(
    df: DataFrame, contracts: list[Contract], found: dict[str, str], route: bool = True
) -> tuple[DataFrame, list[list[Column]]]:
    """Add the broken rule of every contract field as a column.

    Also returned is, per contract, one violation struct or NULL per field, in
    contract field order. The rules are columns of their own because the
    structs use them several times: nested in place, the conditions multiply.
    """
    inside = {f"_in_{i}": falls_under(c, route) for i, c in enumerate(contracts)}
    rules: dict[str, Column] = {}
    structs: list[list[Column]] = []
    for i, c in enumerate(contracts):
        structs.append([])
        for j, f in enumerate(c.fields):
            rule, kind = f"_rule_{i}_{j}", found[f.name]
            rules[rule] = F.expr(f"if(_in_{i}, {rule_sql(f, kind)}, null)")
            structs[i].append(F.expr(violation_sql(c.dataset, j, f, rule, kind)))
    return df.withColumns(inside).withColumns(rules), structs


def any_rule(contracts: list[Contract]) -> Column:
    """Whether a row of :func:`with_rules` breaks any rule."""
    rules = [f"_rule_{i}_{j}" for i, c in enumerate(contracts) for j in range(len(c.fields))]
    return F.coalesce(*rules).isNotNull()


def schema_violations(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """One row per broken rule, with the record's other columns beside it.

    ``route`` keeps a record only for the contracts of its source; without it
    every record is held against every contract.
    """
    chosen = as_contracts(contracts)
    df, found = records.with_kinds([n for c in chosen for n in c.field_names], chosen)
    df, violations = with_rules(df, chosen, found, route)
    rows = [v for of_contract in violations for v in of_contract]
    keep = [column(name) for name in records.passthrough]
    # Only violations come through; sound records end here.
    broken = unfold(df, rows, *keep, only=any_rule(chosen))
    if records.order_by is None:
        return broken
    return broken.withColumn("message", _message(column(records.order_by).cast("string")))


def numbered_violations(records: Records, contract: Contract, route: bool = True) -> DataFrame:
    """Violations with ``record_index``: the record's number from 0 in file order.

    Counts only the records under the contract. Records are numbered within
    their file block and blocks are offset by a running count, so no task
    orders more than one block, or one row per block.
    """
    df, found = records.with_kinds(contract.field_names, [contract])
    df, violations = with_rules(df, [contract], found, route)
    broken = F.array_compact(F.array(*violations[0])).alias("broken")
    record = F.when(F.col("_in_0"), F.struct(column(records.order_by).alias("place"), broken))
    kept = unfold(df, [record]).select("place.*", "broken")
    in_block = Window.partitionBy("file", "block").orderBy("row")
    earlier = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        kept.groupBy("file", "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    )
    return (
        kept.withColumn("place", F.row_number().over(in_block) - 1)
        .where(F.size("broken") > 0)
        .join(offsets, ["file", "block"])
        .select((F.col("offset") + F.col("place")).alias("record_index"), F.inline("broken"))
        .withColumn("message", _message(F.col("record_index").cast("string")))
    )


def kind_counts(
    records: Records, contracts: Contract | Iterable[Contract]
) -> tuple[DataFrame, dict[str, str]]:
    """How many records show each combination of field kinds.

    The whole input folds into a few rows inside the map tasks (a combination
    is one short text), whatever the size of a source. Every count a contract
    needs about presence, nulls and types follows from this table, so the
    lines are read and parsed once for all contracts and rules.

    Columns: the line state, the source, ``records`` and one kind column per
    checked field; also returned is which column holds which field.
    """
    chosen = as_contracts(contracts)
    names = checked_names(chosen)
    df, found = records.with_kinds(names, chosen)
    counts = df.groupBy(STATE, SOURCE, kind_text(names, found).alias("_kinds")).agg(
        F.count(F.lit(1)).alias("records")
    )
    return kind_columns(counts, names)


def checked_names(contracts: list[Contract]) -> list[str]:
    return list(dict.fromkeys(n for c in contracts for n in c.checked_fields))


def kind_text(names: list[str], found: dict[str, str]) -> Column:
    """The kinds of all named fields as one text, three characters each."""
    return F.expr(f"concat({', '.join(f"coalesce({found[n]}, '{ABSENT}')" for n in names)})")


def kind_columns(counts: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """Counts per :func:`kind_text` with a kind column for every name instead of the text."""
    columns = {n: f"_kind_{i}" for i, n in enumerate(names)}
    parts = (
        f"nullif(substring(_kinds, {3 * i + 1}, 3), '{ABSENT}') as {c}"
        for i, c in enumerate(columns.values())
    )
    return counts.selectExpr(STATE, SOURCE, "records", *parts), columns


def schema_summary(
    records: Records, contracts: Contract | Iterable[Contract], route: bool = True
) -> DataFrame:
    """Violations per dataset, field, rule and observed type."""
    chosen = as_contracts(contracts)
    counts, found = kind_counts(records, chosen)
    counts, violations = with_rules(counts, chosen, found, route)
    rows = [v for of_contract in violations for v in of_contract]
    return (
        unfold(counts, rows, "records")
        .groupBy("dataset", "position", "field", "rule", "expected", "observed")
        .agg(F.sum("records").alias("violations"))
    )


def _message(place: Column) -> Column:
    # The messages of the reports.
    texts = {
        "missing_field": "Record %s is missing field %s",
        "nullability": "Record %s has null for non-nullable field %s",
        "type_mismatch": "Record %s field %s has invalid type",
    }
    return F.coalesce(
        *(
            F.when(F.col("rule") == rule, F.format_string(text, place, "field"))
            for rule, text in texts.items()
        )
    )
