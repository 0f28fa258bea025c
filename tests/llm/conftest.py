import random

import pytest

LONG = "ab cd " * 30_000


@pytest.fixture(scope="session")
def odd_rows():
    """Rows (doc_id, text) that every operator must take: null, empty, blank, very long, repeated."""
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, LONG), (7, "größe ▁ 日本語 🙂 x y\r\nz"),
            (8, "the same line of a text\nand one more line\nthird line here"), (9, "the same line of a text\nand one more line\nthird line here"),
            (9, "the same line of a text\nand one more line\nthird line here"), (None, "the same line of a text\nand one more line\nthird line here"),
            (None, None), (10, "0" * 3000 + " 1.2.3.4 +1 (222) 333-4444 a.b@c.de 4111 1111 1111 1111")]


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text), with extra columns whose names clash with helper columns."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en" if i is None or i % 3 else None, f"src{(i or 0) % 4}", None if t is None else len(t), "x", 1, 2, 3)
             for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, row_ string, n_words int, key int, kept int")
    return make


@pytest.fixture(scope="session")
def corpus():
    """Random texts with exact and near copies, shared passages and repeated lines."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice(["on", "the", "er", "wh", "at", "ing", "é", "ß"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]

    def line(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = line(60)
    block = "\n".join(line(9) for _ in range(25))
    base = line(120)
    rows = []
    for i in range(140):
        kind = i % 7
        if kind == 0:
            text = base
        elif kind == 1:
            words = base.split(" ")
            for _ in range(rng.randint(1, 9)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary) + str(rng.randint(0, 9))
            text = " ".join(words)
        elif kind == 2:
            text = line(30) + " " + passage + " " + line(20)
        elif kind == 3:
            text = line(12) + "\n" + block + "\n" + line(8)
        elif kind == 4:
            text = "\n".join([line(5)] * 3 + [line(7)]) + " #$%" * rng.randint(0, 9)
        else:
            text = "\n".join(line(rng.randint(1, 40)).capitalize() + "." for _ in range(rng.randint(1, 9)))
        rows.append((i, text))
    return rows
