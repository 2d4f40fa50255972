"""The training-data pipeline over ``documents``: five stages, each an operator of ``llm``.

A stage takes the documents its predecessor kept and returns documents; the
last returns where each document's token ids lie in the files it wrote. Between
stages the rows are written as Parquet to the shared folder and read again.

1. language: texts that the nearest-centroid classifier rejects go (null texts,
   texts without a letter, and texts unlike anything it learned from). It learns
   from the documents' own ``lang``.
2. near_dedup: of every group of near-duplicates (five-word shingles, similarity
   of 0.8 or more) the document with the smallest id stays.
3. decontamination: documents that hold a benchmark item go.
4. mixing: sources come to their target weights; a document appears once per
   epoch, and the one at a source's cut with its first words.
5. token_files: ids of every text in Simple-8b files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm import decontamination, language, mixing, near_dedup, token_files
from pactline.llm.common import prepare, table, written
from pactline.llm.queries import tokenizer
from pactline.session import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier rejects go; it learns from the documents' own ``lang``."""
    prepare(spark)
    return language.accept(docs, language.train(docs), *COLUMNS[2:])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates stays.

    Rows that repeat an id and its text are one document. Other texts under a
    repeated id, and texts without an id, are documents of their own: each is
    searched and judged under a key of its own.
    """
    prepare(spark)
    docs = docs.select(*COLUMNS)
    odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if odd.isEmpty():
        found = near_dedup.near_duplicates(docs, words=5, percent=80)
        return docs.join(found.where("not kept").select("doc_id"), "doc_id", "left_anti")
    digest = F.coalesce(F.sha2(F.col("text").cast("string"), 256), F.lit("")).alias("_digest")
    rest = F.min(F.struct(*COLUMNS[2:], "text")).alias("_rest")
    # Keys follow the ids, so that the smallest id of a group stays.
    rows = near_dedup.keys_of(docs.groupBy("doc_id", digest).agg(rest))
    rows = written(rows.select("doc_id", "_rest.*", "_key"), "keyed")
    found = near_dedup.near_duplicates(
        rows.select(F.col("_key").alias("doc_id"), "text"), words=5, percent=80
    )
    dropped = found.where("not kept").select(F.col("doc_id").alias("_key"))
    return rows.join(dropped, "_key", "left_anti").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    prepare(spark)
    return decontamination.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights; a repeated document is a row per epoch."""
    prepare(spark)
    sized = written(mixing.sizes(docs), "sizes")
    return mixing.mix(docs.select(*COLUMNS), sized)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text in files; returns where each document's ids lie in them."""
    prepare(spark)
    path = shared_folder(spark, "llm-token-files")
    token_files.write_tokens(docs, path, tokenizer())
    return token_files.read_tokens(spark, path)


STAGES = [
    ("language", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]
# Sketches, singular vectors and BPE have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns what the last one found."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
