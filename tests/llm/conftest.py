import pytest
from llm_helpers import CLASHING, sentence, text


@pytest.fixture(scope="session")
def documents(spark):
    """Builds (doc_id, text, lang, source, n_chars) rows and columns with clashing names."""

    def make(rows, extra=True):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], schema)
        return df.selectExpr("*", *(f"'x' AS {c}" for c in CLASHING)) if extra else df

    return make


@pytest.fixture(scope="session")
def odd():
    """Rows that every operator must take: NULLs, no words, very long, repeated rows and ids."""
    long = " ".join(sentence(k) for k in range(4000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, text(5)), (5, text(5)), (6, text(5)), (None, text(7)),
        (None, None), (7, "word"), (8, "\u00e9\u00df \u4e2d\u6587 \U0001f600 \u2581 x\\<s>"), (9, text(9)), (9, text(10)),
    ]
