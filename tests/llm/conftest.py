import random

import pytest


@pytest.fixture(scope="session")
def texts():
    """Small awkward texts: empty, blank, copies, near copies, accents, long runs, shared passages."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(90)
    out = [None, "", " \n\t ", "one", "two words", "a" * 700, "é" * 300, passage, passage, passage.upper(), passage + " end", "x " + passage]
    out += [prose(rng.randint(0, 60)) + " " + passage[rng.randint(0, 80) : 400] + " " + prose(rng.randint(0, 40)) for _ in range(12)]
    out += [prose(rng.randint(1, 200)) for _ in range(20)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents with columns whose names the operators use inside, one row twice, one without an id."""
    rows = [(i * 3 + 1, t, "k", 7, "s", i) for i, t in enumerate(texts)]
    rows += [rows[7], (None, "no id here at all", "k", 7, "s", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, n long, spans string, fp int")
