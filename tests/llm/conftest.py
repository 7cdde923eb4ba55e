import pytest


@pytest.fixture
def docs(spark):
    """Documents with the columns of the pipeline's input and some more that clash with operators' names."""

    def make(rows):
        full = [(i, t, "en", "s", 0, 1.5, "x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score double, _email string")

    return make


#: Null, empty, blank, one word, repeated rows, a very long text, odd characters.
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (None, "no id here at all"), (5, "a b c d e f " * 20000), (6, "é😀ß 日本語 \u0000 ABC"), (7, "word")]
