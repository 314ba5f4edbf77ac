import pytest

from clickloom.llm.workers import ready

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, lang) rows."""
    ready(spark)

    def make(rows, *extra):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, *(0 for _ in extra))
                for r in rows]
        schema = DOCS + "".join(f", {name} int" for name in extra)
        return spark.createDataFrame(rows, schema)

    return make
