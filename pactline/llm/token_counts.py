"""Exact histogram of encoded lengths, and every total that follows from it.

Texts are encoded once; a task sends one row per length it met. Suffix sums over
the histogram then answer totals, quantiles and truncated totals for any context
limit without another look at the texts. Lengths are summed in two levels, so
no task orders more than ``SPAN`` lengths or one row per span.

Defined cases: a null or empty text has length 0; an empty table has an empty
histogram; repeated rows count each time; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactline.llm.encoder import encoder
from pactline.llm.words import slices

SPAN = 256


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            found = [coder.encode(cut)[1] for cut in slices(batch.column("text"))]
            lengths, docs = np.unique(
                np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(lengths), pa.array(docs)], names=["n_tokens", "n_docs"]
            )

    return count


def length_histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``n_tokens``, ``n_docs``: how many whole texts encode to each length."""
    return (
        docs.select(F.col("text").cast("string").alias("text"))
        .mapInArrow(_counter(tokenizer), "n_tokens bigint, n_docs bigint")
        .groupBy("n_tokens")
        .agg(F.sum("n_docs").alias("n_docs"))
    )


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Add to each length what holds for a context limit of that length.

    ``docs_longer``, ``tokens_longer``: documents over the limit and their ids;
    ``kept_tokens``: ids left when each document is cut at the limit;
    ``lost_tokens``; ``total_docs``, ``total_tokens``; ``quantile``: the share of
    documents that fit. ``histogram`` is read twice; hand in a written table.
    """
    tokens = (F.col("n_tokens") * F.col("n_docs")).alias("tokens")
    rows = histogram.select("n_tokens", "n_docs", tokens).withColumn(
        "_span", F.floor(F.col("n_tokens") / SPAN).cast("bigint")
    )
    later = Window.orderBy(F.desc("_span"))
    above = later.rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("_span").agg(F.sum("n_docs").alias("_docs"), F.sum("tokens").alias("_tok"))
    all_spans = later.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = spans.select(
        "_span",
        F.coalesce(F.sum("_docs").over(above), F.lit(0)).alias("_docs_above"),
        F.coalesce(F.sum("_tok").over(above), F.lit(0)).alias("_tok_above"),
        F.sum("_docs").over(all_spans).alias("total_docs"),
        F.sum("_tok").over(all_spans).alias("total_tokens"),
    )
    inside = (
        Window.partitionBy("_span")
        .orderBy(F.desc("n_tokens"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    longer = F.coalesce(F.sum("n_docs").over(inside), F.lit(0)) + F.col("_docs_above")
    beyond = F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("_tok_above")
    found = rows.join(spans, "_span").select(
        "n_tokens",
        "n_docs",
        longer.alias("docs_longer"),
        beyond.alias("tokens_longer"),
        "total_docs",
        "total_tokens",
    )
    kept = F.col("total_tokens") - F.col("tokens_longer")
    kept = kept + F.col("docs_longer") * F.col("n_tokens")
    return found.select(
        "*",
        kept.alias("kept_tokens"),
        (F.col("total_tokens") - kept).alias("lost_tokens"),
        ((F.col("total_docs") - F.col("docs_longer")) / F.col("total_docs")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Totals for any context limits, whether or not a document has that length."""
    cuts = F.explode(F.array(*[F.lit(int(x)).cast("bigint") for x in limits]))
    fits = F.col("n_tokens") <= F.col("limit")
    wide = sums.select("*", cuts.alias("limit"))
    docs = F.coalesce(F.sum(F.when(fits, F.col("n_docs"))), F.lit(0))
    inside = F.coalesce(F.sum(F.when(fits, F.col("n_docs") * F.col("n_tokens"))), F.lit(0))
    over = F.first("total_docs") - docs
    return wide.groupBy("limit").agg(
        over.alias("docs_longer"), (inside + over * F.first("limit")).alias("kept_tokens")
    )


def at_quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that holds each share of the documents."""
    asked = F.explode(F.array(*[F.lit(float(x)) for x in shares]))
    return (
        sums.select("n_tokens", "quantile", asked.alias("share"))
        .where(F.col("quantile") >= F.col("share"))
        .groupBy("share")
        .agg(F.min("n_tokens").alias("n_tokens"))
    )
