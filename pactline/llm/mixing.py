"""Mix sources to target weights, cut to the word, without Python in the tasks.

Every document gets a hash-random key. Within its source the documents are
ordered by that key; a source takes whole epochs of itself and then the head of
that order up to its budget, the last document in part. The order is never made
in one place: the key's range is cut into ranges of about ``RANGE_ROWS``
documents, running sums are taken within a range, and the sums of the ranges
are summed in two levels. A source with a third of all rows is only more ranges.

Defined cases: a null text has size 0; a null source is a source of its own and
comes last; rows that repeat a ``doc_id`` are separate documents; a source
without words takes nothing; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Weights of the sources in code point order, repeated.
WEIGHTS = (5, 2, 1)
# A source gives at most so many epochs.
EPOCHS = 3
RANGE_ROWS = 1_000
_RANGES_PER_GROUP = 1_024
_KEY_BITS = 40
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def hash_key(seed: str = "mix") -> Column:
    """40 random-looking bits that depend on the document's id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(F.encode(name, "UTF-8")), 1, 10), 16, 10).cast("bigint")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS
) -> DataFrame:
    """``source``, ``docs``, ``source_size`` and ``target`` (words), one row per source.

    All sizes together are shared by weight; a target stops at ``epochs`` times
    its source, and what is over goes to the others by weight. Sources are
    taken by room per weight: whoever would be above its stop, given all before
    it stopped, is stopped. Comparisons are between whole numbers.
    """
    totals = sized.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size")
    )
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    choice = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(choice, ((rank - 1) % len(weights) + 1).cast("int"))
    exact = "decimal(38,0)"
    rows = totals.select(
        "source", "docs", "source_size", weight.cast("bigint").alias("w"), rank.alias("_mix_rank")
    ).withColumn("stop", F.col("source_size") * epochs)
    by_room = Window.orderBy(F.col("stop") / F.col("w"), "_mix_rank")
    ahead = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        (
            F.sum("source_size").over(everything)
            - F.coalesce(F.sum("stop").over(ahead), F.lit(0))
        ).alias("_mix_left"),
        F.sum("w").over(rest).alias("_mix_weights"),
    )
    stopped = (F.col("_mix_left").cast(exact) * F.col("w")) > (
        F.col("stop").cast(exact) * F.col("_mix_weights")
    )
    rows = rows.withColumn("_mix_stopped", stopped)
    shared = F.first(F.when(~F.col("_mix_stopped"), F.col("_mix_left")), True).over(everything)
    weights_left = F.first(F.when(~F.col("_mix_stopped"), F.col("_mix_weights")), True).over(everything)
    target = F.when(F.col("_mix_stopped"), F.col("stop").cast("double")).otherwise(
        (F.col("w") * shared).cast("double") / weights_left.cast("double")
    )
    return rows.select("source", "docs", "source_size", target.alias("target"))


def _prefix(ranges: DataFrame) -> DataFrame:
    """Words in all ranges of the source before each range, summed in two levels."""
    ranges = ranges.withColumn("_mix_group", F.floor(F.col("_mix_range") / _RANGES_PER_GROUP))
    before = (Window.unboundedPreceding, -1)
    group = Window.partitionBy("_mix_source").orderBy("_mix_group").rowsBetween(*before)
    groups = ranges.groupBy("_mix_source", "_mix_group").agg(F.sum("_mix_words").alias("_mix_words"))
    groups = groups.select(
        "_mix_source", "_mix_group", F.coalesce(F.sum("_mix_words").over(group), F.lit(0)).alias("_mix_base")
    )
    inside = Window.partitionBy("_mix_source", "_mix_group").orderBy("_mix_range").rowsBetween(*before)
    return (
        ranges.withColumn("_mix_inside", F.coalesce(F.sum("_mix_words").over(inside), F.lit(0)))
        .join(groups, ["_mix_source", "_mix_group"])
        .select("_mix_source", "_mix_range", (F.col("_mix_base") + F.col("_mix_inside")).alias("_mix_ahead"))
    )


def range_of(key: Column, ranges: Column) -> Column:
    """The range, of so many, that a key falls into; a share first, so nothing overflows."""
    return F.floor(key / F.lit(float(1 << _KEY_BITS)) * ranges)


def take(
    rows: DataFrame,
    sized: DataFrame | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = "mix",
) -> DataFrame:
    """Add ``source_size``, ``target`` and ``taken`` to rows with ``doc_id``, ``source``, ``size``.

    ``taken`` counts words with repeats: whole epochs of the document's size and
    then what the source's budget leaves for it. Further columns are kept.
    ``sized`` has the same documents without more columns, from a written table;
    it is read for the sums where ``rows`` are wide or costly.
    """
    sized = rows if sized is None else sized
    targets = source_targets(sized, weights, epochs)
    # Sources are known by their place from here on, so null joins like any other.
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    targets = targets.select(
        F.col("source").alias("_mix_name"),
        number.alias("_mix_source"),
        F.ceil(F.col("docs") / RANGE_ROWS).alias("_mix_ranges"),
        "source_size",
        "target",
    )
    place = range_of(F.col("_mix_key"), F.col("_mix_ranges"))

    def ranged(part: DataFrame) -> DataFrame:
        own = part.drop("source_size", "target", "taken")
        found = own.join(targets, F.col("source").eqNullSafe(F.col("_mix_name")))
        found = found.drop("_mix_name").withColumn("_mix_key", hash_key(seed))
        return found.withColumn("_mix_range", place.cast("bigint"))

    sums = (
        ranged(sized).groupBy("_mix_source", "_mix_range").agg(F.sum("size").alias("_mix_words"))
    )
    order = (
        Window.partitionBy("_mix_source", "_mix_range")
        .orderBy("_mix_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = ranged(rows).withColumn(
        "_mix_inside", F.coalesce(F.sum("size").over(order), F.lit(0))
    )
    found = found.join(_prefix(sums), ["_mix_source", "_mix_range"])
    budget = F.floor("target").cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    left = budget - whole * F.col("source_size") - F.col("_mix_ahead") - F.col("_mix_inside")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return found.withColumn("taken", taken.cast("bigint")).drop(
        "_mix_source", "_mix_ranges", "_mix_key", "_mix_range", "_mix_inside", "_mix_ahead"
    )


def sizes(docs: DataFrame, *more: str) -> DataFrame:
    """What ``take`` needs of the documents, and the named columns."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        *more,
    )


def mix(
    docs: DataFrame, sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS
) -> DataFrame:
    """The documents of the mix: a row per epoch, the one at the cut with its first words.

    The cut keeps the text up to the end of the last word taken. Other columns
    stay as they are. ``sized`` is ``sizes(docs)``, from a written table.
    """
    more = [c for c in docs.columns if c not in ("doc_id", "source")]
    taken = take(sizes(docs, *more), sized, weights, epochs)
    copies = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0)
    rows = taken.where(F.col("taken") > 0).select(
        "*", F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_mix_epoch")
    )
    words = F.least(F.col("size"), F.col("taken") - (F.col("_mix_epoch") - 1) * F.col("size"))
    pieces = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{_WORD}"), F.lit(0))
    head = F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")
    text = F.when(words < F.col("size"), head).otherwise(F.col("text"))
    return rows.withColumn("text", text).select(*docs.columns)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 10) AS BIGINT)
           AS k
  FROM documents
),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS r
  FROM sized GROUP BY source
),
weighed AS (
  SELECT *, CAST([5, 2, 1][(r - 1) % 3 + 1] AS BIGINT) AS w, 3 * source_size AS stop FROM totals
),
level AS (
  SELECT *,
         CAST(sum(source_size) OVER () - coalesce(sum(stop) OVER before, 0) AS HUGEINT) AS left_,
         CAST(sum(w) OVER after AS HUGEINT) AS weights
  FROM weighed
  WINDOW before AS (ORDER BY stop / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY stop / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
judged AS (SELECT *, left_ * w > stop * weights AS stopped FROM level),
open_ AS (
  SELECT left_, weights FROM judged WHERE NOT stopped ORDER BY stop / w, r LIMIT 1
),
targets AS (
  SELECT source, source_size,
         CASE WHEN stopped THEN CAST(stop AS DOUBLE)
              ELSE CAST(w * o.left_ AS DOUBLE) / CAST(o.weights AS DOUBLE) END AS target
  FROM judged j, open_ o
),
ordered AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (
           PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
budgets AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END
           AS epochs
  FROM ordered
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - ahead))
         AS BIGINT) AS taken
FROM budgets
"""
