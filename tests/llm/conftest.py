import random

import pytest

from stowage.llm.shipping import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size string, line string, a int, key string"
SF = "/root/testdata/sf0.001"
WORDS = [f"w{k}x" for k in range(3000)]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, source) rows, with further columns whose names clash with inner ones."""
    def build(rows):
        full = [(d, t, "en", s, len(t or ""), "r", "s", "l", 1, "k") for d, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, blanks, repeats, ties, sharp text, and one very long text."""
    rng = random.Random(5)
    long = " ".join(rng.choices(WORDS, k=30_000))
    plain = " ".join(rng.choices(WORDS, k=80))
    return [
        (1, None, "s"), (2, "", "s"), (3, " \t\n ", None), (4, plain, "s"), (4, plain, "s"), (5, plain, None),
        (None, plain, "t"), (None, None, None), (6, long, "t"), (7, "a" * 5000, "t"), (8, "ÅB c d \U0001f600 <|endoftext|> <s> ▁x\n\ny  ", "\U0001f600"),
        (9, "one", "ﬀ"), (10, "Same same SAME same same same", "s"),
    ]
