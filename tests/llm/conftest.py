import random

import pytest

PLAIN = "doc_id bigint, text string"


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) rows, with columns whose names operators use themselves."""

    def make(rows):
        clashing = "key string, h string, a string, node string, _text string, _score string, n_lines string"
        extra = ("k", "h", "a", "n", "t", "s", "l")
        return spark.createDataFrame([(*r, *extra) for r in rows], f"{PLAIN}, {clashing}")

    return make


@pytest.fixture
def prose():
    """Random words, the same in every run."""

    def make(n, seed, vocabulary=4000):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))

    return make

