import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def tiny(spark):
    """Builds a documents frame from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def make(rows):
        extra = [(i, t, "en", "s", None if t is None else len(t), 1.5, "k", 7) for i, t in rows]
        return spark.createDataFrame(extra, f"{DOCS}, score double, key string, n int")

    return make
