import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(*rows):
        full = [(r + (None, None))[:4] for r in rows]
        data = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in full]
        return spark.createDataFrame(data, DOCUMENTS).repartition(3)

    return make


ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "Two words"),
    (6, "three WORDS here"),
    (7, "same text again and again\nline two of it\nline three of it"),
    (8, "same text again and again\nline two of it\nline three of it"),
    (8, "same text again and again\nline two of it\nline three of it"),
    (9, "ünïcödé — 漢字 🙂 <|endoftext|>  double  spaces \n\n end "),
    (10, "long " * 30_000),
    (11, "x" * 70_000),
    (12, "a\0b c\x0bd"),
    (None, "no id at all, but a text"),
]


@pytest.fixture(scope="session")
def odd(documents):
    return documents(*ODD_TEXTS)
