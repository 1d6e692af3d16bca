import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes documents from (doc_id, text[, source[, lang]]) rows."""
    def make(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else None, r[2] if len(r) > 2 else "s",
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
