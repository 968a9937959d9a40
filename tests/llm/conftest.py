from __future__ import annotations

import random

import pytest

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, bucket int, slice int, block int, row long"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with columns whose names the operators use themselves."""

    def build(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t), 0.5, "x", 1, 2, 3, 4) for i, t in rows]
        return spark.createDataFrame(full, EXTRA).repartition(3)

    return build


@pytest.fixture(scope="session")
def corpus():
    """Odd texts, exact and near copies, shared passages, one very long text."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = say(40), say(120)
    rows = [None, "", " \t\n", "one", "one two", "Two Words", "two words", "ÀÉ ünïcode naïve ÀÉ", "a" * 300, say(6000)]
    rows += [base] * 5 + [base.upper()]
    for k in range(25):
        words = base.split()
        for _ in range(k % 6):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append(" ".join(words))
    rows += [say(rng.randint(1, 80)) + " " + passage + "\n" + say(rng.randint(1, 80)) for _ in range(12)]
    rows += [say(rng.randint(1, 200)) for _ in range(15)]
    ids = rng.sample(range(1000), len(rows))
    return list(zip(ids, rows))
