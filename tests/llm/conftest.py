import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `_words` string, tag int, ID string, component_id long, n_words long"


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}x{rng.randrange(9)}" for _ in range(n))


def rows_of(texts):
    """(doc_id, text, source) triples as full rows, with clashing columns."""
    return [(i, t, "en" if i is None or i % 3 else None, s, None if t is None else len(t), "clash", 5, "x", 9, 1) for i, t, s in texts]


@pytest.fixture(scope="session")
def corpus():
    """Copies, near copies, shared passages, repeated lines, nulls, empties, a
    repeated row, two texts under one id, and a very long text."""
    rng = random.Random(5)
    passage = words(rng, 70)
    out = []
    for i in range(60):
        body = "\n".join(words(rng, rng.randint(5, 60)) for _ in range(rng.randint(1, 5)))
        if i % 4 == 0:
            body = f"{words(rng, 9)} {passage}\n{body}"
        if i % 3:
            body = f"All rights reserved here.\n{body}"
        out.append((i, body, f"s{i % 3}"))
    base = words(rng, 300)
    for i in range(60, 72):
        w = base.split()
        w[rng.randrange(300)] = "changed"
        out.append((i, " ".join(w), "s0"))
    out += [(72 + k, out[3][1], "s0") for k in range(5)]
    out += [(80, None, "s1"), (81, "", None), (82, " \t\n ", "s1"), (83, "One", None), (84, out[0][1] + "\n" + out[0][1], "s2")]
    out += [(85, "Ärger ÄRGER ab AB\x0bcd\x85e f", "s1"), (86, words(rng, 30_000, 5000), "s2"), (87, "spam spam spam " * 40, "s0")]
    out += [(None, words(rng, 80), "s1"), (None, out[5][1], "s1")]
    out += [out[7], out[7], (8, "another text under eight " + words(rng, 120), "s2"), (90, "# $ % " * 60, "s0")]
    return out


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(rows_of(corpus), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, corpus):
    rows = [(i, 0 if t and ("spam" in t or "#" in t) else 1, 0) for i, t, _ in corpus if i is not None and t and i % 2 == 0]
    return spark.createDataFrame([*rows, (None, 1, 0), (10, None, None), (87, 0, 0), (12, 1, 1), (12, 1, 1)], "doc_id long, quality int, toxic int")
