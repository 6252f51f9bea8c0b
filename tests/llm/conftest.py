import random

import pytest

COLUMNS = "doc_id long, text string, id string, digest string, row int, doc long, place int, `by` string"


def prose(seed: int, n: int) -> str:
    """Words without meaning, so that texts of different seeds share no 5 words in a row."""
    rnd = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ten", "or", "sa", "vel", "du", "ri", "an"]
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names operators use inside."""
    a, b = prose(1, 80), prose(2, 120)
    rows = [(1, a), (2, a), (2, a), (3, b), (None, b), (None, None), (4, None), (5, ""), (6, " \n\t "), (7, "one two"), (8, "one two"), (9, prose(3, 40_000)),
            (10, "héé 漢字 😀 <|endoftext|> it's '  \n\n x"), (None, None)]
    return spark.createDataFrame([(i, t, "x", "y", 1, 2, 3, None) for i, t in rows], COLUMNS)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
