import random

import pytest

COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, row string, hash string, "
           "block string, size string, shard string, bits string, slot string, score string, kept string")


def _prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["th", "an", "er", "ing", "ou", "re"]) for _ in range(rng.randint(1, 4)))
                    for _ in range(words))


TEXTS = [
    (1, _prose(1, 120)), (2, ""), (3, None), (4, _prose(2, 60)), (5, _prose(1, 120)), (6, _prose(1, 120)),
    (7, "one"), (8, "one two"), (9, " \t\n\x0b\x0c\r "), (10, "a " * 100), (11, _prose(3, 30_000)),
    (12, _prose(2, 60) + " and"), (13, "naïve Σίσυφος ÀÉ 中文 😀 <|endoftext|> can't # a | b"),
    (None, _prose(4, 40)), (None, None), (14, _prose(5, 50)), (14, _prose(5, 50)), (15, _prose(6, 50)),
    (15, _prose(7, 50)), (16, "THE!! END!! " * 30), (-3, "line\nline\n" + _prose(8, 25)),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like internal ones."""
    rows = [(i, t, None if n % 5 == 0 else "en", None if n % 4 == 0 else f"s{n % 3}", None if n % 6 == 0 else n,
             *["x"] * 9) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def texts():
    return TEXTS
