import pytest
from llm_texts import LONG
from pyspark.sql import Row


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns that clash."""
    texts = [
        (1, "Licensed under CC BY-NC 4.0.\nsome words follow here", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, "b"),
        (4, " \t\n \x0b\x0c\r ", "fr", None),
        (5, LONG, "de", "b"),
        (None, "no id but quite some words in this one text of mine", None, "a"),
        (6, "twice the same text with enough words to count as a text", "en", "b"),
        (6, "twice the same text with enough words to count as a text", "en", "b"),
        (None, None, None, None),
        (7, "ñ漢字😀 ퟿ x", "es", "a"),
        (8, "one", "en", "a"),
    ]
    clashing = ["size", "kept", "score", "taken", "n_words", "doc", "copies", "row", "key", "cid", "n", "license", "first"]
    extra = {name: "mine" for name in clashing}
    rows = [Row(doc_id=i, text=t, lang=lang, source=s, n_chars=None if t is None else len(t), **extra) for i, t, lang, s in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clashing)
    return spark.createDataFrame(rows, schema).coalesce(2)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
