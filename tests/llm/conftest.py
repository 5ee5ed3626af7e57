import uuid

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for their own columns.
CLASHING = (
    "score double, kept string, fingerprint int, component_id string, digest string, keep_id int, place string, "
    "group_size string, ids string, key string, n int, node int, root int, best int, first int, label string, `a b` int"
)


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text), with columns that clash with the operators' own."""

    def build(rows):
        filled = [(i, t, None, "s", None if t is None else len(t), *[None] * 17) for i, t in rows]
        return spark.createDataFrame(filled, f"{COLUMNS}, {CLASHING}")

    return build


@pytest.fixture
def odd_rows():
    """Null, empty, blank and very long texts, ties, repeated rows, null ids."""
    long = " ".join(f"word{k % 977}" for k in range(60_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "a"),
        (5, "A  a"),
        (6, "one two three four five"),
        (6, "one two three four five"),
        (7, "One two THREE four five"),
        (8, "one two three four six"),
        (9, long),
        (10, long + " tail"),
        (11, long),
        (None, "one two three four five"),
        (None, "nothing else"),
        (12, "Ünïcode　ｗｏｒｄｓ 😀 \x00 end"),
        (13, "x" * 70_000),
    ]


@pytest.fixture
def away():
    """A fresh name, for folders below the shared one."""
    return lambda: uuid.uuid4().hex[:8]
