"""Small tables with the cases every corpus operator has to take."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep_id long, size string, score string"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """Rows (doc_id, text[, source]) with extra columns whose names the operators use themselves."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, -1, "x", "y") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    draw = random.Random(4)
    words = [f"w{n}" for n in range(300)]
    text = " ".join(draw.choices(words, k=60))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, text), (5, text), (5, text), (6, "a b"), (7, "a b"), (None, text),
        (8, " ".join(draw.choices(words, k=40_000))), (9, "Don't  stop<|endoftext|>é 中文 '' 12"), (10, None),
    ]
