"""What the operators share: session settings, checked inputs, written tables."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.llm.words import mix
from pactline.session import configure, shared_folder

# Texts handed to a Python worker at once; their bytes are cut further there.
BATCH_ROWS = 1_000

# Bits of a filter that goes to all tasks: 8 MB, whatever the number of keys.
FILTER_BITS = 26

ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for operators whose tasks run numpy on Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    # Workers started by a local session find the package beside its checkout.
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{paths}".rstrip(":")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Id, text and the named columns; whatever else the input has is left out."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[F.col(c) for c in more],
    )


def written(df: DataFrame, label: str, release: bool = True) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder, computed once.

    Cuts the lineage; the copy outlives the executors that made it. The shuffle
    files that made it are of no more use, but Spark keeps them until the driver
    happens to collect its garbage; ``release`` has it do so now, so an operator
    of many steps needs the disk of its largest step and not of all.
    """
    spark = df.sparkSession
    path, schema = shared_folder(spark, f"llm-{label}"), df.schema
    df.write.parquet(path)
    if release:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def _filter_places(keys: np.ndarray) -> list[np.ndarray]:
    """Two bits of the filter for each key."""
    spread = mix(keys.view(np.uint64))
    return [(x >> np.uint64(64 - FILTER_BITS)).astype(np.int64) for x in (spread, mix(spread))]


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = np.unique(np.concatenate(_filter_places(batch.column("key").to_numpy())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(places >> 5), pa.array(np.int64(1) << (places & 31))], names=["at", "bit"]
        )


def bit_filter(keys: DataFrame) -> np.ndarray:
    """The longs of ``key`` (no nulls) as a Bloom filter of fixed size.

    ``2**(FILTER_BITS - 5)`` sums at most come to the driver, whatever the
    number of keys; with very many keys the filter lets more pass, so a join
    has to follow.
    """
    found = keys.mapInArrow(_bits, "at bigint, bit bigint").groupBy("at")
    sums = found.agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 5), dtype=np.uint32)
    out[sums.column("at").to_numpy()] = sums.column("bits").to_numpy().astype(np.uint32)
    return out


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be among those of ``bit_filter``."""
    hit = np.ones(len(keys), dtype=bool)
    for place in _filter_places(keys):
        hit &= (bits[place >> 5] >> (place & 31).astype(np.uint32)) & 1 == 1
    return hit


def remainder(modulus: int) -> F.Column:
    """crc32 of the document's id as text, modulo ``modulus`` (null id: as '')."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(F.encode(name, "UTF-8")) % modulus


def hash_sample(rows: DataFrame, group: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows per value of ``group``, chosen by a hash of ``doc_id``.

    Rows are thinned where they are read, at a rate from the group's count, so a
    large group never meets in one task; the few left are then cut to ``most``.
    """
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_count"))
    rates = counts.select(
        F.col(group).alias("_group"), (F.lit(float(most)) / F.col("_count")).alias("_rate")
    )
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    # One row per group, and whoever samples by group holds a model of each group.
    thin = rows.join(F.broadcast(rates), F.col(group) == F.col("_group")).where(chance < F.col("_rate"))
    order = Window.partitionBy(group).orderBy(F.xxhash64(F.lit(seed), F.col("doc_id")), "doc_id")
    return (
        thin.withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") <= most)
        .drop("_nth", "_group", "_rate")
    )
