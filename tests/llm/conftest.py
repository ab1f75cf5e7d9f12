import pytest

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def documents(spark):
    """``documents(text, ...)`` numbered from 0, or ``(id, text)`` pairs; with columns of clashing names."""

    def make(*texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        full = [(i, t, "en", "src", len(t or ""), "x", 1.0, "y") for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", mark STRING, score DOUBLE, token STRING")

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return table, [(r.doc_id, r.text or "") for r in table.select("doc_id", "text").collect()]
