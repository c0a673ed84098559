import pytest


@pytest.fixture(scope="session")
def rows(spark):
    """Documents from (doc_id, text) pairs, with the columns of the real table and one with a clashing name."""

    def make(pairs, lang=None, source=None):
        schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
        return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t), None) for i, t in pairs], schema)

    return make
