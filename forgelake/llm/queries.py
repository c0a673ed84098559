"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm import bisectors, chat, chunks, decontaminate, divergence, language, licenses, metric_tree, mixing, near_dup, ngram_lm, private, secrets
from forgelake.llm.shared import read_table

Runner = Callable[[SparkSession, str], DataFrame]


def remainder(modulus: int) -> F.Column:
    """crc32 of the document's id as text, modulo a number: the split that learning and holding out share."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op1_metric_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_tree.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"), mixing.quality_weights(labels))


def op3_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of all documents under a model of those whose remainder is not 2; a null id counts as held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngram_lm.fit(docs.where(remainder(7) != 2))
    scored = ngram_lm.score(docs, model)
    return scored.withColumn("held_out", F.coalesce(remainder(7) == 2, F.lit(True)))


def op4_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose remainder is not 0; a null id counts as held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(remainder(5) != 0))
    scored = language.score(docs, model)
    return scored.withColumn("held_out", F.coalesce(remainder(5) == 0, F.lit(True)))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"), path_col="source")


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_passages(read_table(spark, sf_dir, "documents"))


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return private.find_private(docs, private.fit(docs))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_probe(read_table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_conversations(turns))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op13_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisectors.cluster(read_table(spark, sf_dir, "embeddings"))


RUNNERS: dict[str, Runner] = {
    "op1_metric_tree_top_k": op1_metric_tree_top_k,
    "op2_mix_sources": op2_mix_sources,
    "op3_ngram_lm": op3_ngram_lm,
    "op4_minhash_near_dup": op4_minhash_near_dup,
    "op5_language_id": op5_language_id,
    "op6_license_scan": op6_license_scan,
    "op7_secret_scan": op7_secret_scan,
    "op8_chunk_dedup": op8_chunk_dedup,
    "op9_private_data": op9_private_data,
    "op10_decontaminate": op10_decontaminate,
    "op11_chat_format": op11_chat_format,
    "op12_source_divergence": op12_source_divergence,
    "op13_bisector_clusters": op13_bisector_clusters,
}


def runners() -> dict[str, Runner]:
    return dict(RUNNERS)


def checks() -> dict[str, str]:
    return {
        "op1_metric_tree_top_k": metric_tree.SQL, "op2_mix_sources": mixing.SQL, "op11_chat_format": chat.SQL,
        "op12_source_divergence": divergence.SQL, "op13_bisector_clusters": bisectors.SQL,
    }
