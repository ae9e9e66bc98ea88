"""A small table with the cases that every operator has to stand: nulls, empty and long texts, copies, clashing columns."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, node string, rep int, key int"


def made_texts() -> list[str | None]:
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["été", "größe", "naïve,", "end.", "日本"]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 220))) for _ in range(40)]
    near = []
    for t in base[:12]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        near.append(" ".join(w))
    hot = " ".join(rng.choices(words, k=60))
    copies = [hot] * 30
    for i in range(20):
        w = hot.split()
        w[i * 3] = f"x{i}"
        copies.append(" ".join(w))
    lines = ["a line that is here again and again\n" * 9, "one\n\ntwo  three\t four\n", "  lead and trail  ", "token: abcdefabcdef0123456789"]
    long_ = " ".join(rng.choices(words, k=30000))
    return [*base, *near, *copies, *lines, long_, "", None, "   \n\t ", "UPPER lower Upper", "a b c"]


@pytest.fixture(scope="session")
def texts():
    return made_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i * 3, t, "en" if i % 3 else None, f"src{i % 4}", len(t) if t is not None else None, i, "s", None, 1, 2) for i, t in enumerate(texts)]
    rows += [(None, "a row without an id " * 8, None, None, None, None, None, None, None, None), rows[0]]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
