import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _id string, kept int, tail string"


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text) as documents, with extra columns of names that operators use."""

    def made(rows):
        full = [(i, t, "en", "s", len(t) if t else None, "mine", 7, "own") for i, t in rows]
        return spark.createDataFrame(full, COLUMNS)

    return made


#: Null and empty texts, null and repeated ids, repeated rows, white space alone.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (4, "one"),
    (4, "another text of the same id"),
    (None, "no id here"),
    (None, None),
]
