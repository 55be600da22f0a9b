from __future__ import annotations

import random

import pytest

#: Columns of documents, and names that operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key long, row string, _id long, component_id long"


def corpus(n: int = 160, seed: int = 3) -> list[tuple]:
    """Documents of two invented languages with copies, near copies, nulls, empty and long texts."""
    rnd = random.Random(seed)
    parts = {"aa": ["ka", "lo", "mi", "tu", "ra", "no"], "bb": ["sch", "ber", "ung", "eit", "zen", "ach"]}
    rows: list[tuple] = []
    for i in range(n):
        lang = rnd.choice(["aa", "bb"])
        word = lambda: "".join(rnd.choice(parts[lang]) for _ in range(rnd.randint(1, 4)))  # noqa: E731, B023
        words = [word() for _ in range(rnd.choice([3, 12, 40, 120, 400]))]
        if rows and rnd.random() < 0.3:
            _, text, lang, _ = rnd.choice(rows)
            words = text.split(" ")
            if rnd.random() < 0.6:
                words[rnd.randrange(len(words))] = word()
        rows.append((i, " ".join(words), lang, f"s{rnd.choice([0, 0, 0, 1, 2])}"))
    rows += [
        (n, None, "aa", "s0"), (n + 1, "", None, None), (n + 2, " \n\t ", "bb", "s1"), (n + 3, "12 34 !!", "aa", None),
        (n + 4, " ".join(["kalo"] * 30_000), "aa", "s2"), (None, "ka lo mi tu", "aa", "s1"), (n + 5, "Ka  LO\nmi\r\ntu é ß 日本 😀", "bb", "s0"),
    ]
    rows += [rows[0], rows[0]]
    return [(*r, len(r[1] or ""), 7, 8, "x", 9, 10) for r in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
