import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, block int, key string, score double, kept string"


def words(rnd, n, vocabulary=400):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows and ids, copies, near copies, shared passages; (doc_id, text)."""
    rnd = random.Random(5)
    long_text = " ".join(words(rnd, 30_000, 30_000))
    base = words(rnd, 300, 5_000)
    passage = " ".join(words(rnd, 60, 5_000))
    rows = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, "One"), (5, "two words"), (6, "ONE"), (7, long_text), (8, long_text)]
    rows += [(None, "a text of no id"), (None, None), (9, "repeated row"), (9, "repeated row"), (10, "x" * 40_000), (11, "x" * 40_000)]
    rows += [(12, "é ü  naïve \u0085 café x \x1c y"), (13, "12 !! 34 ??")]
    for i in range(25):  # near copies
        copy = list(base)
        for _ in range(rnd.randrange(0, 6)):
            copy[rnd.randrange(len(copy))] = f"edit{i}"
        rows.append((100 + i, " ".join(copy)))
    for i in range(12):  # a passage that unlike documents share, twice in some
        rows.append((200 + i, " ".join([*words(rnd, 80, 9_000), passage, *words(rnd, 30, 9_000), *([passage] if i % 4 == 0 else [])])))
    for i in range(30):
        rows.append((300 + i, " ".join(words(rnd, rnd.randrange(1, 120), 3_000))))
    rnd.shuffle(rows)
    return rows


def frame(spark, rows, parts=5):
    full = [(i, t, ["en", "de", None][k % 3], f"s{k % 4}", None if t is None else len(t), k, "k", 0.5, t) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS).repartition(parts)


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
