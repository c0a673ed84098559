"""Stages of the pipeline on planted cases, and the registered queries against their SQL."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from forgelake.llm import language, mixing, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.checks()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "conversations"):
        duck.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    df = entry_point.queries()[name](spark, FOLDER)
    found = duck.execute(queries.checks()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == sorted(found.fetchall(), key=str)


def test_pipeline_keeps_clean_documents_and_columns(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = documents
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == documents.columns
        docs = out
    assert docs.count() > 50


def test_stages_on_empty_and_odd_rows(spark, rows):
    odd = rows([(1, None), (2, ""), (3, "1234"), (4, "the cat and the dog"), (5, "the cat and the dog"), (5, "the cat and the dog"), (None, "der Hund und die Katze")]).drop("score")
    kept = corpus_pipeline.identify_language(spark, odd, FOLDER)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "5", "5", "None"]
    single = corpus_pipeline.near_duplicates(spark, kept, FOLDER)
    assert sorted(str(r["doc_id"]) for r in single.collect()) == ["4", "None"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), FOLDER).count() == 0


def test_stages_judge_rows_and_not_ids(spark):
    """Rows that share an id or have none are judged each by its text; columns may be named like working ones."""
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first()["text"]
    clean = "the small house stands behind the old trees and nobody has lived in it for years"
    names = ("row", "kept_id", "text_hash", "found_key", "many", "key", "at", "size", "lang_pred")
    plain = [(7, item, 1), (7, clean, 2), (None, item, 3), (None, clean, 4), (8, "12 34", 5), (8, clean + " now", 6)]
    docs = spark.createDataFrame([(i, t, "en", "a", n, *[n] * len(names)) for i, t, n in plain], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} long" for c in names))
    kept = corpus_pipeline.identify_language(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(r["row"] for r in kept.collect()) == [1, 2, 3, 4, 6]
    rest = corpus_pipeline.decontaminate_benchmark(spark, kept, FOLDER)
    assert rest.columns == docs.columns
    assert sorted(r["row"] for r in rest.collect()) == [2, 4, 6]
    single = corpus_pipeline.near_duplicates(spark, rest, FOLDER)
    assert single.columns == docs.columns
    assert sorted(r["row"] for r in single.collect()) == [2, 4]
    mixed = corpus_pipeline.mix(spark, single, FOLDER)
    assert all(r["key"] == r["at"] == r["size"] == r["row"] for r in mixed.collect())


def test_language_rows_carry_all_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.fit(docs)
    carried = language.score(docs, model, carry=True)
    assert {(r["doc_id"], r["lang_pred"]) for r in language.score(docs, model).collect()} == {(r["doc_id"], r["lang_pred"]) for r in carried.collect()}
    assert sorted(map(str, carried.select("row.*").collect())) == sorted(map(str, docs.collect()))


def test_mix_cuts_where_the_running_total_does(spark):
    """Against a loop over the documents in the order of their keys, with repeated and null ids and texts."""
    texts = ["a b c d e", "x y z", "q", "one two three four five six seven"]
    plain = [(None if i % 7 == 3 else i % 40, None if i % 11 == 5 else texts[i % 4], ("a", "a", "a", "b", None)[i % 5]) for i in range(120)]
    docs = spark.createDataFrame(plain, "doc_id long, text string, source string")
    rows = docs.select("doc_id", "source", mixing.uniform("doc_id", 1).alias("u"), F.xxhash64("text").alias("digest"), "text").collect()
    found = mixing.mix_sources(docs, keep=("text",)).collect()
    assert len(found) == len(rows)
    target = {r["source"]: (r["source_size"], r["target"]) for r in found}
    expected = []
    for source, (whole, goal) in target.items():
        own = [r for r in rows if r["source"] == source]
        epochs = int(goal // whole) if whole else 0
        rest = int(goal) - epochs * whole
        alike = {}
        for r in own:
            size = len((r["text"] or "").split())
            alike.setdefault((-math.log(r["u"]), r["doc_id"] is not None, r["doc_id"] or 0, size, r["digest"]), []).append(r)
        for place in sorted(alike):
            size, many = place[3], len(alike[place])
            part = size if rest >= size * many else max(rest, 0) // many
            rest -= size * many
            expected += [(r["doc_id"], r["text"], source, epochs * size + part) for r in alike[place]]
    assert sorted(map(str, expected)) == sorted(str((r["doc_id"], r["text"], r["source"], r["taken"])) for r in found)
