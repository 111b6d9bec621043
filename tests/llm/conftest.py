import pytest


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang, source) rows, with columns that clash with results."""
    def make(rows):
        rows = [(*r, "en", "src1")[:2] + ((r[2], r[3]) if len(r) == 4 else ("en", "src1")) for r in rows]
        full = [(i, t, l, s, len(t or ""), "clash", 7, None) for i, t, l, s in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, digest string, kept int, `odd.name` string"
        )
    return make


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return make
