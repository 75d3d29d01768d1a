import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text) pairs, with columns whose names an operator might use."""

    def make(*rows):
        full = [(i, t, "en", None, len(t) if t is not None else None, "x", 1) for i, t in rows]
        return spark.createDataFrame(full, f"{DOCS}, fp string, row int")

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
