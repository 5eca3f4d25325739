import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, id long, band int, unit long, row int, bucket int, score double, spans string, a long, b long, key string, size long"


def long_text(words: int = 30_000) -> str:
    """A very long text; word i is spelled by its number."""
    return " ".join("".join("abcdefghij"[int(c)] for c in str(i * 7919 % 100_003)) for i in range(words))


@pytest.fixture(scope="session")
def edge_rows():
    """doc_id, text, lang, source: nulls, empties, white space, a very long text, repeated rows and ties."""
    return [
        (1, "the cat sat on the mat and looked at the dog", "en", "s0"),
        (1, "the cat sat on the mat and looked at the dog", "en", "s0"),
        (2, "the cat sat on the mat and looked at the dog", "en", "s0"),
        (3, None, "en", "s1"),
        (4, "", None, None),
        (5, " \n\t ", "de", "s1"),
        (6, "der hund und die katze sind im haus und schlafen", "de", None),
        (7, "12345 67890 !!!", None, "s0"),
        (8, long_text(), None, "s2"),
        (9, "one", "en", "s2"),
        (10, "password = abcdefghijkl1234 é▁漢字😀 <|im_end|>\\ \x00z", None, "s2"),
        (None, "no id here at all", "en", "s2"),
        (None, None, None, None),
    ]


def widened(rows):
    return [(d, t, g, s, len(t) if t is not None else None, "clash", 1, 2, 3, 4, 5, 0.5, "clash", 7, 8, "k", 9) for d, t, g, s in rows]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The edge rows as a table with columns whose names clash with the operators' own."""
    return spark.createDataFrame(widened(edge_rows), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
