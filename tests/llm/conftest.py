import pytest

from sourcelens.llm.common import prepare

EXTRA = ", extra int, spans string, rank int, score double, n_shingles long, class string"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs(llm):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those of operators."""
    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long" + EXTRA
        return llm.createDataFrame(
            [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), 1, "x", 7, 0.5, 9, "c") for i, t in rows], schema)

    return make
