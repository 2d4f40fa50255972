"""Exact order statistics per group, without sorting a group in one task.

The value at 0-based index ``floor(n * fraction)`` of each sorted group is
found in steps. The first counts values per coarse interval and finds the
interval that holds the wanted index; the next look inside that interval only,
at finer ones and then at single values. What a task sorts is a list of at most
2**DIGIT intervals of one group, whatever the range of the values and the number
of rows, even if one group holds most of them. The range is known from the
first pass: a narrow one needs one step, or two.

The input is evaluated once: its narrow rows are written and all steps read
those, so values that change from reading to reading, such as the current time,
cannot lose a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F

from pactline.session import broadcast_if, materialize, shared_folder

# Bits of a value that one step finds.
DIGIT = 16

def wide_sum(column: str) -> Column:
    """A sum that leaves the range of BIGINT without an error."""
    return F.sum(F.col(column).cast("decimal(38,0)"))


MERGE = {"sum": F.sum, "wide_sum": wide_sum, "max": F.max}


def with_ranks(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    fractions: Mapping[str, float],
    totals: Sequence[tuple[str, str, Column]] = (),
    weight: str | None = None,
) -> DataFrame:
    """One row per group with ``n``, the values at the fractions, and totals.

    ``value`` is a BIGINT column without nulls. ``weight`` says how often a row
    counts. ``totals`` lists further (name, ``sum``, ``wide_sum`` or ``max``,
    expression) aggregates, which share the first pass over the data.
    """
    # A struct as group key keeps groups whose name is null. Without groups the
    # key is 0 for every row, but no literal: that would turn joins into products.
    group = (F.struct(*by) if by else F.col(value) * 0).alias("_group")
    times = (F.lit(1) if weight is None else F.col(weight)).cast("bigint")
    extra = [expression.alias(name) for name, _, expression in totals]
    rows, low, high = _ranged(df.select(group, F.col(value).alias("_value"), times.alias("_n"), *extra))
    wide = max((high - low).bit_length() - DIGIT, 0)
    rows = rows.withColumn("_value", F.col("_value") - low)
    coarse = rows.groupBy("_group", _interval(wide)).agg(
        F.sum("_n").alias("_n"), *(MERGE[how](name).alias(name) for name, how, _ in totals)
    )
    in_group = Window.partitionBy("_group")
    running = coarse.withColumns(
        {
            "_all": F.sum("_n").over(in_group),
            "_upto": _running_sum(in_group.orderBy("_interval")),
        }
    )
    targets = []
    for name, fraction in fractions.items():
        # floor(n * fraction) in double arithmetic, counted from 0
        index = F.floor(F.col("_all").cast("double") * F.lit(fraction))
        before = F.col("_upto") - F.col("_n")
        target = F.struct(
            F.lit(name).alias("_name"), "_interval", (index - before).alias("_index")
        )
        targets.append(F.max(F.when((before <= index) & (index < F.col("_upto")), target)))
    groups = materialize(
        running.groupBy("_group").agg(
            F.sum("_n").alias("n"),
            *(MERGE[how](name).alias(name) for name, how, _ in totals),
            F.array(*targets).alias("_targets"),
        ),
        "ranks",
    )
    few = groups.small(len(fractions))
    wanted = groups.df.select("_group", F.inline("_targets"))
    while wide:
        fine = max(wide - DIGIT, 0)
        wanted, wide = _refine(rows, wanted, few, wide, fine), fine
    picked = wanted.groupBy("_group").agg(
        *(
            F.max(F.when(F.col("_name") == name, F.col("_interval") + low)).alias(name)
            for name in fractions
        )
    )
    names = [name for name, *_ in totals]
    return (
        groups.df.drop("_targets")
        .join(broadcast_if(groups.small(), picked), "_group", "left")
        .select(*(F.col(f"_group.`{k}`") for k in by), "n", *fractions, *names)
    )


def _ranged(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """The rows from a table of their own, with their least and largest value."""
    seen, spark = Observation(), rows.sparkSession
    path = shared_folder(spark, "rank-rows")
    ends = F.min("_value").alias("low"), F.max("_value").alias("high")
    rows.observe(seen, *ends).write.parquet(path)
    found = seen.get
    return spark.read.schema(rows.schema).parquet(path), found.get("low") or 0, found.get("high") or 0


def _interval(bits: int) -> Column:
    return F.shiftright("_value", bits).alias("_interval")


def _refine(rows: DataFrame, wanted: DataFrame, few: bool, wide: int, fine: int) -> DataFrame:
    """The finer interval that holds each wanted index, and the index inside it."""
    on = ["_group", "_wide"]
    wanted = wanted.withColumnRenamed("_interval", "_wide")
    placed = rows.select("_group", F.shiftright("_value", wide).alias("_wide"), _interval(fine), "_n")
    if few:
        # Filter and count in the map tasks.
        placed = placed.join(F.broadcast(wanted.select(*on).distinct()), on, "left_semi")
    # Counted before the join, so that no key stays hot.
    counted = placed.groupBy(*on, "_interval").agg(F.sum("_n").alias("_n"))
    met = counted.join(broadcast_if(few, wanted), on)
    upto = _running_sum(Window.partitionBy("_group", "_name").orderBy("_interval"))
    before = F.col("_upto") - F.col("_n")
    hit = (before <= F.col("_index")) & (F.col("_index") < F.col("_upto"))
    return (
        met.withColumn("_upto", upto)
        .where(hit)
        .select("_group", "_name", "_interval", (F.col("_index") - before).alias("_index"))
    )


def _running_sum(ordered: WindowSpec) -> Column:
    return F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
