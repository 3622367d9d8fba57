import random

import pytest

#: Rows with every oddity: null id, null and empty text, repeats, a long text, columns whose names clash.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, kept boolean, score double"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(r.randint(1, 4))) for _ in range(words))


def odd_rows() -> list[tuple]:
    texts = [prose(1, 80), prose(1, 80), prose(2, 60), None, "", " \n\t ", prose(3, 3), "!!! ###", prose(4, 4000), prose(2, 60) + " end", "ünï 漢字 \x00 ﬁ"]
    rows = [(k, t, ["en", None, "de"][k % 3], "s" if k % 2 else None, None if t is None else len(t), 7, None, 0.5) for k, t in enumerate(texts)]
    return [*rows, rows[2], (None, prose(5, 30), "en", "s", 1, 1, True, None), (None, prose(5, 30), "en", "s", 1, 1, True, None), (-5, "", None, None, 0, 0, False, 1.0)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
