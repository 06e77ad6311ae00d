import random

import pytest

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def sentence(draw, n):
    return " ".join("".join(draw.choices(LETTERS, k=draw.randint(2, 8))) for _ in range(n))


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use inside."""

    def build(rows):
        schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, n_lines STRING, band STRING, _range STRING, score STRING"
        full = [(i, t, "en", "s", None if t is None else len(t), "x", None, "y", "z") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture
def odd_rows():
    """Nulls, empty and very long texts, equal rows, rows that share an id, white space and symbols."""
    draw = random.Random(5)
    long = sentence(draw, 20_000)
    return [
        (1, None), (2, ""), (3, "   \t "), (4, "\n\n"), (5, "x"), (6, "word " * 400), (7, long), (8, long),
        (9, "a" * 50_000), (10, "A b▁c \U0001f600 é\n end  of   it "), (10, "A b▁c \U0001f600 é\n end  of   it "),
        (11, "one two three four five six"), (11, "another text of the same id"), (None, "no id at all but some words"),
        (None, None), (12, "!!! ??? 123 456"), (13, "\x00 nul and \x0b tab"),
    ]
