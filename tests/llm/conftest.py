import pytest

SF_DIR = "/root/testdata/sf0.001"
WORDS = "the of and thin erer onlysh tionha reble edst anwh oror stin ingou heath bly"
LONG = " ".join(f"{w}{i % 997}" for i, w in enumerate(WORDS.split() * 3000))
HEAD = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n_words string, _text string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns named like results."""
    texts = [
        (0, "Plain words stand here, quite calmly. " * 5), (1, None), (2, ""), (3, LONG), (4, LONG), (5, " \t\n "), (6, "1 2 3"),
        (7, "one"), (7, "one"), (None, "a text without id"), (8, "é à ü ñ " * 20), (9, "<|im_end|> \\ \x00   😀 " * 3), (10, "x" * 200_000),
        (11, "a@b.co, +1 (559) 555-3817 and 10.1.2.3 " * 2),
    ]
    rows = [(i, t, None if i in (1, None) else "en", None, None, "clash", None, "clash") for i, t in texts]
    return spark.createDataFrame(rows, HEAD)


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)


@pytest.fixture(scope="session")
def small(spark):
    """The smallest documents table."""
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
