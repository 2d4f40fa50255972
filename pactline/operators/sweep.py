"""Lag metrics of many overlapping windows: every event is counted once.

The ends of all windows cut time into segments; a window is a run of them. An
event falls into one segment, found by a binary search in the cuts, and is
counted there by lag. Segments are merged in pairs, pairs of pairs and so on,
where a window needs it; a window then is the sum of at most two nodes of each
level of that tree. So the work on events does not depend on how many windows
hold them, and the work on windows not on how many events they hold:

* sums and maxima add up over a window's nodes;
* its percentiles are found digit by digit. A step counts the nodes' lags in
  intervals of a 2**DIGIT-th of the interval found before, so in that many at
  most, and keeps the one that holds the wanted rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactline.session import materialize

# Bits of a lag that one step of the percentiles finds. A step meets each node of
# each window with 2**DIGIT counts at most, whatever the number of events.
DIGIT = 6
# Nodes of windows that stay in the plan; more are read from a table.
LISTED = 20_000


def sweep(
    lags: DataFrame,
    batches: DataFrame,
    spans: Sequence[tuple[int, int]],
    fractions: Mapping[str, float],
    sla_ms: float,
) -> DataFrame:
    """Counts, sums, maximum and percentiles of ``lag_us`` for each closed span of microseconds.

    ``lags`` has ``_at`` and ``lag_us``, ``batches`` has ``_at``. Spans without
    events have no row. The spans' ends, numbers of a list that the driver
    holds, are sent to all tasks.
    """
    spark = lags.sparkSession
    cuts = sorted({t for start, end in spans for t in (start, end + 1)})
    place = {t: n for n, t in enumerate(cuts)}
    pieces = [
        (start, end, level, node)
        for start, end in spans
        if start <= end
        for level, node in _cover(place[start], place[end + 1])
    ]
    names = "_from bigint, _to bigint, _level int, _node bigint"
    covered = spark.createDataFrame(pieces, names)
    if len(pieces) > LISTED:
        covered = materialize(covered, "pieces", measure=False).df
    wanted = covered.select("_level", "_node").distinct()

    folded = in_segments(lags, cuts).groupBy("_node", "lag_us").agg(F.count(F.lit(1)).alias("_n"))
    nodes = materialize(_tree(folded, wanted, ["lag_us"], len(cuts)), "nodes", measure=False).df
    begun = in_segments(batches, cuts).groupBy("_node").agg(F.count(F.lit(1)).alias("_n"))
    started = _tree(begun, wanted, [], len(cuts))

    late = F.col("lag_us") > F.lit(sla_ms * 1000.0)
    sums = nodes.groupBy("_level", "_node").agg(
        F.sum("_n").alias("total_events"),
        F.sum(F.col("lag_us").cast("decimal(20,0)") * F.col("_n")).alias("lag_sum"),
        F.max("lag_us").alias("lag_max"),
        F.sum(F.when(late, F.col("_n")).otherwise(0)).alias("sla_violations"),
    )
    span = ["_from", "_to"]
    totals = covered.join(sums, ["_level", "_node"]).groupBy(*span).agg(
        F.sum("total_events").alias("total_events"),
        F.sum("lag_sum").alias("lag_sum"),
        F.max("lag_max").alias("lag_max"),
        F.sum("sla_violations").cast("bigint").alias("sla_violations"),
    )
    count = covered.join(started, ["_level", "_node"]).groupBy(*span)
    count = count.agg(F.sum("_n").alias("total_batches"))
    found = totals.join(count, span, "left")
    ends = nodes.agg(F.min("lag_us").alias("low"), F.max("lag_us").alias("high")).first()
    return found.join(_percentiles(totals, covered, nodes, fractions, *ends), span)


def in_segments(rows: DataFrame, cuts: Sequence[int]) -> DataFrame:
    """Rows with the segment (``_node``) they are in; those before or after all cuts go.

    Segment n lasts from cut n to before cut n + 1. The cuts are one row.
    """
    one = rows.sparkSession.createDataFrame([(list(cuts),)], "_cuts array<bigint>")
    size = len(cuts)
    steps = [1 << b for b in range(max(size - 1, 0).bit_length() - 1, -1, -1)] or [0]

    def step(at: Column, add: Column) -> Column:
        # The largest place whose cut is not after the row: -1 before the first.
        later = F.get("_cuts", at + add)
        return F.when(later <= F.col("_at"), at + add).otherwise(at)

    first = F.when(F.get("_cuts", F.lit(0)) <= F.col("_at"), F.lit(0)).otherwise(F.lit(-1))
    walk = F.array(*(F.lit(s) for s in steps))
    found = F.when(first == 0, F.aggregate(walk, F.lit(0), step)).otherwise(first)
    placed = rows.crossJoin(F.broadcast(one))  # one row
    placed = placed.withColumn("_node", found.cast("bigint")).drop("_cuts", "_at")
    return placed.where((F.col("_node") >= 0) & (F.col("_node") < size - 1))


def _cover(first: int, stop: int) -> list[tuple[int, int]]:
    """The fewest nodes (level, number) that make up the segments ``first`` to ``stop``."""
    nodes, level = [], 0
    while first < stop:
        if first & 1:
            nodes.append((level, first))
            first += 1
        if stop & 1:
            stop -= 1
            nodes.append((level, stop))
        first, stop, level = first >> 1, stop >> 1, level + 1
    return nodes


def _tree(folded: DataFrame, wanted: DataFrame, by: list[str], cuts: int) -> DataFrame:
    """Counts of the wanted nodes of all levels, from those of the segments.

    A segment's row goes to the few levels at which a wanted node holds it; the
    map tasks add up before anything is sent.
    """
    levels = F.explode(F.sequence(F.lit(0), F.lit(max(cuts - 1, 1).bit_length())))
    rows = folded.select("*", levels.alias("_level"))
    rows = rows.withColumn("_node", F.expr("shiftright(_node, _level)"))
    kept = rows.join(wanted, ["_level", "_node"], "left_semi")
    return kept.groupBy("_level", "_node", *by).agg(F.sum("_n").alias("_n"))


def _percentiles(
    totals: DataFrame,
    covered: DataFrame,
    nodes: DataFrame,
    fractions: Mapping[str, float],
    low: int | None,
    high: int | None,
) -> DataFrame:
    """The lag at index ``floor(n * fraction)`` of each span's sorted lags, all in low to high."""
    low = low or 0
    wide = max(((high or 0) - low).bit_length() - DIGIT, 0)
    nodes = nodes.withColumn("_lag", F.col("lag_us") - low)
    span = ["_from", "_to"]
    ranks = F.array(
        *(
            F.struct(
                F.lit(name).alias("_name"),
                F.floor(F.col("total_events").cast("double") * F.lit(part)).alias("_index"),
            )
            for name, part in fractions.items()
        )
    )
    targets = totals.select(*span, F.inline(ranks))
    pieces = covered.select(*span, "_level", "_node")
    # The join makes many rows of few, so its tasks are not left to the size of its input.
    tasks = nodes.sparkSession.sparkContext.defaultParallelism
    before = None
    while before != 0:
        bits = wide if before is None else max(before - DIGIT, 0)
        keys = ["_level", "_node"]
        interval = F.shiftright("_lag", bits).alias("_interval")
        if before is None:
            counts = nodes.groupBy(*keys, interval)
        else:
            counts = nodes.groupBy(*keys, F.shiftright("_lag", before).alias("_wide"), interval)
            keys = [*keys, "_wide"]
        sought = targets.join(pieces, span).repartition(tasks, *keys)
        met = sought.join(counts.agg(F.sum("_n").alias("_n")), keys)
        met = met.groupBy(*span, "_name", "_index", "_interval").agg(F.sum("_n").alias("_n"))
        order = Window.partitionBy(*span, "_name").orderBy("_interval")
        upto = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ahead = F.col("_upto") - F.col("_n")
        hit = (ahead <= F.col("_index")) & (F.col("_index") < F.col("_upto"))
        targets = (
            met.withColumn("_upto", upto)
            .where(hit)
            .select(
                *span,
                "_name",
                F.col("_interval").alias("_wide"),
                (F.col("_index") - ahead).alias("_index"),
            )
        )
        before = bits
    return targets.groupBy(*span).agg(
        *(
            F.max(F.when(F.col("_name") == name, F.col("_wide") + low)).alias(name)
            for name in fractions
        )
    )
