import random

import pytest

from starloom.session import release_scratch

WORDS = [f"{a}{b}{n}" for a in ("ka", "lo", "mi", "tu", "re") for b in ("san", "tor", "vel") for n in range(40)]


@pytest.fixture(autouse=True)
def scratch(spark):
    yield
    release_scratch(spark)


@pytest.fixture
def prose():
    """Texts of given lengths in words, the same for the same seed."""
    def make(words: int, seed: int = 0, sentence: int = 9) -> str:
        rng = random.Random(seed)
        found = [rng.choice(WORDS) for _ in range(words)]
        return " ".join(w + "." if i % sentence == sentence - 1 else w for i, w in enumerate(found))

    return make


@pytest.fixture
def docs(spark):
    """A stored table of (doc_id, text, ...) rows; stored, so that row numbers are fixed."""
    from starloom.session import materialise

    def make(rows, schema="doc_id long, text string"):
        return materialise(spark.createDataFrame(rows, schema), "docs")

    return make
