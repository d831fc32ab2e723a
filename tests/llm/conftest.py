import pytest

# Columns whose names the operators use inside.
EXTRA = ["row", "score", "shard", "slot", "label", "text_key", "node", "d", "k", "lines", "removed", "id", "page", "key", "group_size", "n"]
LONG = "word " * 60_000


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and blank texts, a very long one, repeated rows and ids, clashing columns."""
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (4, "another text under the same id"), (None, "no id here at all"),
        (None, None), (5, LONG), (6, "a\nb\nc\nd"), (7, "a\nb\nc\nd"), (8, "é ü ñ 日本 \U0001F600 <|endoftext|>"), (9, "1234 5678 !!! ???"),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(i, t, "en" if i else None, None, len(t or ""), *["x"] * len(EXTRA)) for i, t in texts], schema)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture
def frame(spark):
    """(id, text) pairs to a frame."""
    return lambda *rows: spark.createDataFrame(list(rows), "doc_id bigint, text string")
