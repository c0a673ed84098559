"""The list of queries without SQL; `test_pipeline` runs the others against theirs."""

from forgelake.llm import queries

#: SQL cannot express these; other tests hold them against brute force or planted cases.
WITHOUT_SQL = {
    "op3_ngram_lm", "op4_minhash_near_dup", "op5_language_id", "op6_license_scan", "op7_secret_scan", "op8_chunk_dedup", "op9_private_data", "op10_decontaminate",
}


def test_every_other_query_has_sql():
    assert set(queries.runners()) - set(queries.checks()) == WITHOUT_SQL
