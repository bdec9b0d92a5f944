import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (ids 0, 1, ...) or from (id, text[, lang, source]) rows."""
    def make(rows, extra=""):
        full = []
        for i, r in enumerate(rows):
            r = (i, r) if r is None or isinstance(r, str) else tuple(r)
            r = r + ("en", "web")[len(r) - 2:] if len(r) < 4 else r
            full.append((*r[:4], None if r[1] is None else len(r[1]), *r[4:]))
        return spark.createDataFrame(full, DOCS + extra)
    return make
