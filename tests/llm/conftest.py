import random

import pytest

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, through a stored table as the operators expect."""
    def build(rows, **extra):
        full = [(i, t, "en", "s", None if t is None else len(t), *[v for v in extra.values()]) for i, t in rows]
        return spark.createDataFrame(full, ", ".join([SHAPE, *[f"{k} string" for k in extra]]))
    return build


@pytest.fixture
def prose():
    """Reproducible texts of made-up words."""
    def build(n_words, seed=0, vocabulary=400):
        rng = random.Random(seed)
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(vocabulary)]
        return " ".join(rng.choice(words) for _ in range(n_words))
    return build


ODD = [(1, None), (2, ""), (3, "   \n\t "), (None, "a text without an id"), (5, "twice"), (5, "twice"), (6, "é" * 3000 + " 日本 🙂")]
