import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes documents from texts; ids count from 0 and other columns are filled."""

    def make(texts, ids=None, lang="en"):
        rows = [(i if ids is None else ids[i], t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOC)

    return make
