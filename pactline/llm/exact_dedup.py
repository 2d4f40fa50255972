"""Exact dedup with a streaming state that never expires, and a check of full texts.

``digest_texts`` reduces each document to a digest, its id and its locator.
``stream_digests`` runs a Structured Streaming aggregation over such rows: the
state, kept by RocksDB on the executors' disks and checkpointed to the shared
folder, holds for every digest ever seen the document to keep, its locator and
a count. New files in the folder are new arrivals; a restart goes on from the
checkpoint. ``confirm`` then compares full texts wherever a digest was hit:
documents with that digest are grouped by digest and text, so two texts with
one digest would stay apart. Copies fold in the map tasks before any shuffle.

Defined cases: null counts as an empty text, and empty texts equal each other;
of equal texts the largest ``doc_id`` stays, null being smaller than any id;
rows that repeat a ``doc_id`` count as separate members of their group; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.session import shared_folder

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ARRIVALS = "doc_id bigint, digest string, proof bigint, locator string"
STATE = "digest string, proof bigint, keep_id bigint, locator string, group_size bigint"
_STATE = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Many small stores: no megabytes set aside for the log of each.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case and every other character as it is; null is empty.

    Where all characters are ASCII the faster ``lower`` does the same.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def digest_texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest`` (SHA-256), ``proof`` (another hash) and ``locator`` (the file)."""
    text = normalised(F.col("text").cast("string"))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"),
        F.xxhash64(text).alias("proof"),
        F.input_file_name().alias("locator"),
    )


def stream_digests(arrivals: DataFrame, checkpoint: str, updates: str) -> None:
    """Fold a stream of digests into the state and write every changed key to ``updates``.

    Runs until all that has arrived is folded in. Each micro-batch overwrites
    its own folder, so a retry leaves one copy.
    """
    spark = arrivals.sparkSession
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    state = arrivals.groupBy("digest", "proof").agg(
        F.max("doc_id").alias("keep_id"),
        F.max_by("locator", F.coalesce("doc_id", F.lit(-(2**63)))).alias("locator"),
        F.count(F.lit(1)).alias("group_size"),
    )

    def save(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{updates}/batch={batch}")

    query = (
        state.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest(spark: SparkSession, updates: str) -> DataFrame:
    """The state as its updates leave it: the last row written for each key."""
    rows = spark.read.schema(f"{STATE}, batch int").parquet(updates)
    last = F.max_by(F.struct("keep_id", "locator", "group_size"), "batch").alias("_last")
    return rows.groupBy("digest", "proof").agg(last).select("digest", "proof", "_last.*")


def confirm(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """Compare full texts wherever a digest was hit: one row per digest and text.

    ``keep_id`` and ``group_size`` come from the texts themselves. Equal texts
    fold in the map tasks, so a text with many copies moves once per task. Two
    texts with one SHA-256 and one ``proof`` raise an error.
    """
    text = normalised(F.col("text").cast("string"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"),
        F.xxhash64(text).alias("proof"),
        text.alias("_text"),
    ).join(hits.select("digest", "proof"), ["digest", "proof"], "left_semi")
    same = rows.groupBy("digest", "proof", "_text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    one = same.groupBy("digest", "proof").agg(
        F.count(F.lit(1)).alias("_texts"),
        F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"),
    )
    refuse = F.raise_error(F.concat(F.lit("different texts share the digest "), F.col("digest")))
    size = F.when(F.col("_texts") == 1, F.col("group_size")).otherwise(refuse.cast("bigint"))
    return one.select("digest", "proof", "keep_id", size.alias("group_size"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "llm-exact")
    arrived, updates = f"{folder}/arrived", f"{folder}/updates"
    digest_texts(docs).write.parquet(arrived)
    # So that an empty table, which makes no micro-batch, has a state to read.
    spark.createDataFrame([], STATE).write.parquet(f"{updates}/batch=-1")
    arrivals = spark.readStream.schema(ARRIVALS).parquet(arrived)
    stream_digests(arrivals, f"{folder}/checkpoint", updates)
    hits = latest(spark, updates).where("group_size > 1")
    groups = confirm(docs, hits)
    rows = spark.read.schema(ARRIVALS).parquet(arrived).drop("locator")
    kept = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.join(groups, ["digest", "proof"], "left").select(
        "doc_id",
        kept.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(kept).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


ORACLE = """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM folded
"""
