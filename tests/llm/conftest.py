from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """Texts with copies, near copies, shared passages, junk, nulls and odd white space."""
    rng = random.Random(5)
    vocabulary = ["the", "of", "and", *("".join(rng.choices("abdeiou", k=rng.randint(2, 7))) for _ in range(300))]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage = words(60)
    texts: list[str | None] = [None, "", " \t\n", "One", "one  ONE", "x y", "x y z", "é ü", "a\x0bb\x0cc"]
    for size in (5, 12, 40, 150, 400, 900):
        base = words(size)
        texts += [" ".join(base)] * 2 + [" ".join(base).upper()]
        for edits in (1, 3, size // 40 + 1, size // 20 + 1, size // 8 + 1):
            near = list(base)
            for _ in range(edits):
                near[rng.randrange(size)] = rng.choice(vocabulary)
            texts.append("\n".join(" ".join(near[i : i + 12]) for i in range(0, size, 12)))
    for _ in range(12):
        a, b = words(rng.randint(0, 80)), words(rng.randint(0, 80))
        texts.append(" ".join(a + passage + b))
    texts.append(" ".join(["ha"] * 500))
    texts.append(" ".join(words(30) * 4))
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def documents(spark, prose):
    rows = [(i, t, "en", "s", len(t or ""), "x") for i, t in prose]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, bucket string")
