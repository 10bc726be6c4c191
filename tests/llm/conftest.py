import random

import pytest

SCHEMA = "doc_id long, text string, kept boolean, chunk string, n long"


def prose(seed: int, n: int, words: int = 400) -> str:
    pick = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("lo", "ra", "mé", "tis", "ku", "den", "o", "shi", "ба", "日")
                  for b in ("n", "ther", "a", "ing", "q", "ß", "el", "x9", "up", "or")]
    return " ".join(pick.choice(vocabulary) + pick.choice(("", "", "", ",", ".", "\n"))
                    for _ in range(n))


def cases() -> list[tuple]:
    """(doc_id, text): empty, long, repeated, near, passage-sharing and odd texts."""
    base, passage = prose(1, 260), prose(2, 90)
    near = base.split(" ")
    near[100] = "changed"
    texts = [base, base.upper(), base, " ".join(near), None, "", " \n\t ", "one", "one two", "ONE two",
             prose(3, 120) + " " + passage + " " + prose(4, 50), passage + " " + prose(5, 80),
             prose(6, 40) + "\n" + passage, "ab " * 300, "x" * 5000, "x" * 5000 + " y",
             "Same line here\n" * 30, "\x00\x1f odd\x85white　space <|endoftext|> ' ''s 12 345",
             prose(7, 6000), prose(8, 200), prose(8, 200) + " tail", "é" * 150 + "é" * 150]
    return list(enumerate(texts, 10))


@pytest.fixture(scope="session")
def rows():
    return cases()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The cases with other columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, "c", 1) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_ids(spark):
    """Rows that are repeated, share a doc_id, or have none."""
    text = prose(9, 150)
    return spark.createDataFrame(
        [(1, text, None, "c", 1), (1, text, None, "c", 1), (2, text, None, "c", 1),
         (None, text, None, "c", 1), (None, None, None, None, None), (3, None, True, "c", 1)], SCHEMA)
