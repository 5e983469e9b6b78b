import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Builds a documents table from texts (or whole rows)."""
    def build(texts, schema=DOCS):
        rows = [t if isinstance(t, tuple) else (i, t, "en", "src0", len(t or ""))
                for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, schema)
    return build
