import random

import pytest

WORDS = [a + b for a in "ka lo mi ren tas ul vor xen yip zu".split() for b in "dar es fin go hal is jun".split()]


@pytest.fixture(scope="session")
def prose():
    """prose(seed, n): n words drawn from a small vocabulary."""
    return lambda seed, n: " ".join(random.Random(seed).choices(WORDS, k=n))


@pytest.fixture()
def docs_of(spark):
    """docs_of(texts): rows of documents with an extra column that has an unlucky name."""

    def make(texts, ids=None, sources=None):
        rows = [
            (i if ids is None else ids[i], t, "en", sources[i] if sources else "s0", len(t or ""), f"x{i}")
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, score string"
        )

    return make
