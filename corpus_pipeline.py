"""The corpus pipeline: STAGES in order, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm import decontaminate, language, mixing, near_dup, private
from forgelake.llm.shared import cut_lineage, filled, new_path, read_table, tune


def _row_key() -> Column:
    """A 64-bit hash of a document's id and text: tells rows apart that repeat an id or have none; equal rows share it.

    Among n rows two different ones meet with a chance of n * n / 2 ** 65, and then share a decision.
    """
    return F.xxhash64(F.col("doc_id"), filled("text"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be recognised (null texts, texts without a letter) go.

    Learns from the documents' own labels. Without any labelled document nothing is judged
    but the letters. Every row is judged by itself, whatever its id.
    """
    tune(spark)
    model = language.fit(docs)
    judged = language.score(docs, model, carry=True)
    # `und` for want of a learned language is no reason to go.
    kept = judged.where("lang_pred <> 'und'") if model.languages else judged.where(F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False)))
    return kept.select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays: the one with the smallest id.

    Of rows that repeat an id, one stays: with the text that was judged for the id, and among
    equal texts the one whose columns come first as JSON. Rows with a null id all stay.
    """
    found = near_dup.near_duplicates(docs, shingle=5, percent=80).where("kept and doc_id is not null").select("doc_id", "text_hash")
    times = docs.where("doc_id is not null").groupBy("doc_id").agg((F.count("*") > 1).alias("many"))
    kept = cut_lineage(found.join(times, "doc_id").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"), "many"), "kept")

    def named(which: DataFrame) -> DataFrame:
        return docs.join(which, (docs["doc_id"] == which["kept_id"]) & (F.xxhash64(filled("text")) == which["kept_hash"]), "left_semi")

    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = named(kept.where("many")).groupBy("doc_id").agg(F.min_by(whole, F.to_json(whole)).alias("row")).select("row.*")
    return named(kept.where("not many")).unionByName(once).unionByName(docs.where("doc_id is null"))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of a test item, also edited, go; each row by its own text, whatever its id."""
    found = decontaminate.contaminated(docs.select(_row_key().alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    found = found.select(F.col("doc_id").alias("found_key")).distinct()
    return docs.join(found, _row_key() == found["found_key"], "left_anti")


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in the text; n_chars follows the new text."""
    redacted = private.find_private(docs, private.fit(docs), replace=True).select(*docs.columns)
    return redacted.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else redacted


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the columns of documents, and size, source_size, target and taken; documents of which the mix takes nothing go.

    Where documents have a column of one of these names, theirs stays and the mix's is left out.
    """
    weights = mixing.quality_weights(read_table(spark, sf_dir, "labels"))
    others = tuple(c for c in docs.columns if c not in ("doc_id", "source"))
    mixed = mixing.mix_sources(docs, weights, keep=others)
    added = ("size", "source_size", "target", "taken")
    return mixed.where("taken > 0").select(*[F.col(f"{c}_kept").alias(c) if c in added else F.col(c) for c in docs.columns], *[c for c in added if c not in docs.columns])


STAGES = [
    ("language", identify_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("private_data", redact_private),
    ("mixing", mix),
]

#: SQL cannot express the learned stages; tests compare the stages of near duplicates and mixing with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
