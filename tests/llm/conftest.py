from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def texts():
    """A few hundred small texts: near copies, exact copies, shared lines, shared passages, empty and odd ones."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    out: list[str | None] = []
    for _ in range(25):
        base = words(rng.randint(30, 90))
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
    passage, line = " ".join(words(40)), "A common  line."
    for i in range(40):
        out.append("\n".join([" ".join(words(rng.randint(1, 20))), passage if i % 3 == 0 else "", f"  {line if i % 2 else line.lower()}\t", " ".join(words(5))]))
    out += [None, "", " ", "one", "one two three", "One two THREE", "\n\n", "é ü 日本語 " * 20, "for " * 300, "x" * 3000, "a b " * 6000]
    out += out[:10]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    sources = [None, "a", "b", "c", "hot", "hot", "hot"]
    rows = [(i, t, ["en", "fr", None][i % 3], sources[i % 7], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
