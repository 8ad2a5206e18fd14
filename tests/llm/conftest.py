import pytest

from tallyhouse.llm.queries import importable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, uid long, size int, score double, start long, spans string, component string, own_key string, own_text string, `row` string, `set` int, first string, item long, label string, vals string"


@pytest.fixture(autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def table(spark):
    """A table of documents with columns that no operator asked for, from (doc_id, text[, lang[, source]])."""

    def make(rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), "x", 7, None, 0.5, 3, "y", None, f"keep-{doc_id}", "own", "r", 4, None, 9, "l", "v"))
        return spark.createDataFrame(full, SCHEMA)

    return make


LONG = " ".join(f"word{k % 977} and{k % 31}" for k in range(60_000))
# NULL and empty texts, ties, repeated rows, NULL in every column, a very long text.
ODD = [
    (1, None),
    (2, ""),
    (3, "same words in the same order, twice over here", "en", "a"),
    (4, "same words in the same order, twice over here", "en", "b"),
    (4, "same words in the same order, twice over here", "en", "b"),
    (None, "a row without an id, but with some words in it", None, None),
    (5, LONG, "en", "a"),
    (6, " \n\t ", "en", None),
    (7, "x", None, "a"),
    (8, "ünï¢ødé 中文 😀 text", "de", "a"),
]


@pytest.fixture
def odd(table):
    return table(ODD)


@pytest.fixture
def nothing(table):
    return table([])
