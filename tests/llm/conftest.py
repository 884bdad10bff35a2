import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, words string, fp string"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang[, source]]); three more columns have names that operators use too."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 0, 1.0, "w", "f") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
