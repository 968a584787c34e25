import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from {doc_id: text} or (doc_id, text) pairs."""

    def make(rows):
        pairs = rows.items() if isinstance(rows, dict) else rows
        return spark.createDataFrame([(i, t, "en", "src0", len(t) if t is not None else None) for i, t in pairs], DOCS)

    return make


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
