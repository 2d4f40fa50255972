"""The registered queries: each operator over its whole table, with its SQL where SQL can tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm import (
    alignment,
    conversations,
    decontamination,
    exact_dedup,
    language,
    lm_scores,
    mixing,
    near_dedup,
    packing,
    substring_dedup,
    token_counts,
    token_files,
    toxicity,
)
from pactline.llm.common import prepare, remainder, table, written
from pactline.session import shared_folder


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer's file; another one is a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = shared_folder(spark, "llm-token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer())
    return token_files.read_tokens(spark, path)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents"), window=13)


def op4_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = lm_scores.train(docs.where(remainder(7) != 2), tokenizer("piece_bpe_32k.model"))
    return lm_scores.score(docs, model).withColumn("held_out", remainder(7) == 2)


def op5_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = docs.where(remainder(3) != 1).select("doc_id", "text")
    # A merge join at every size: whether labels are few enough to send is no matter of chance.
    known = labels.select("doc_id", "toxic").hint("merge")
    model = toxicity.train(learned.join(known, "doc_id"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "spans",
    )


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    sized = written(mixing.sizes(table(spark, sf_dir, "documents")), "sizes")
    return mixing.take(sized).select("doc_id", "size", "source_size", "target", "taken")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = decontamination.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "item_id", "cosine", "lcs_share", "answer_share")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(remainder(4) != 2))
    found = language.identify(docs, model)
    return found.select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op10_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = token_counts.length_histogram(table(spark, sf_dir, "documents"), tokenizer())
    return token_counts.suffix_sums(written(found, "lengths"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return conversations.audited(table(spark, sf_dir, "conversations"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return alignment.align_documents(
        table(spark, sf_dir, "documents"), tokenizer(), tokenizer("piece_bpe_32k.model")
    )


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer())


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_lattice_scores": op4_lattice_scores,
    "op5_stream_dedup": op5_stream_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_mix_sources": op7_mix_sources,
    "op8_decontamination": op8_decontamination,
    "op9_language": op9_language,
    "op10_length_histogram": op10_length_histogram,
    "op11_conversations": op11_conversations,
    "op12_alignment": op12_alignment,
    "op13_packing": op13_packing,
}
ORACLE = {
    "op2_near_duplicates": near_dedup.ORACLE,
    "op3_substring_dedup": substring_dedup.ORACLE,
    "op5_stream_dedup": exact_dedup.ORACLE,
    "op7_mix_sources": mixing.ORACLE,
    "op11_conversations": conversations.ORACLE,
}
