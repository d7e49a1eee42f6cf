import pytest


@pytest.fixture(scope="session")
def make(spark):
    """A table of documents from texts, ids from 0, with columns that clash with internal names."""

    def build(texts, ids=None):
        rows = [(i if ids is None else ids[i], t, "en", "s", None, 1, "x") for i, t in enumerate(texts)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, _id int, kept string"
        )

    return build
