from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidecast.llm import merkle


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(digests: list[str]) -> list[list[str]]:
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def path(levels: list[list[str]], at: int) -> list[tuple[str, bool]]:
    out = []
    for level in levels[:-1]:
        near = at ^ 1
        out.append((level[near] if near < len(level) else "", at % 2 == 1))
        at //= 2
    return out


def plain(rows: list[tuple]) -> list[tuple]:
    """Rows are (doc_id, lang, leaf, candidate)."""
    groups: dict = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([r[2] for r in groups[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for at, (doc, _, own, candidate) in enumerate(groups[g]):
            folded, siblings = candidate, ""
            for near, odd in path(trees[g], at) + path(top, place):
                folded, siblings = sha(near, folded) if odd else sha(folded, near), siblings + near
            out.append((doc, own, trees[g][-1][0], top[-1][0], sha(siblings), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def rows_of(n: int, groups: list, seed: int = 1) -> list[tuple]:
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        own = sha("row", str(i))
        rows.append((rnd.choice([i, i, i, i // 2, None]), rnd.choice(groups), own, own if i % 5 else sha("tampered", str(i))))
    return rows + rows[:3] * (n > 3)


SCHEMA = "doc_id long, lang string, leaf string, tampered string, idx int, size string, tree long, row int"


def found(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in merkle.verify(docs, F.col("lang"), "tampered").collect()), key=str)


@pytest.mark.parametrize(("n", "groups"), [(1, ["en"]), (1, [None]), (2, ["en"]), (37, ["en", None, "", "-", "ß", "z"]), (700, ["en", "en", "en", "de"])])
def test_equals_the_plain_version(spark, n, groups):
    rows = rows_of(n, groups)
    assert found(spark, rows) == plain(rows)


def test_many_steps_and_copies_of_hot_nodes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "STRIDE", 2)
    monkeypatch.setattr(merkle, "SHARE", 8)
    rows = rows_of(300, ["en", "en", "en", "fr", None])
    assert found(spark, rows) == plain(rows)


def test_fields_as_hashed(spark):
    values = [(None, "é", ""), (7, None, " \n"), (-3, "日本😀", None)]
    docs = spark.createDataFrame(values, "a long, b string, c string")
    assert [r[0] for r in docs.select(merkle.leaf("a", "b", "c")).collect()] == [sha(*map(field, v)) for v in values]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.verify(docs, F.col("lang"), "tampered").collect() == []
    assert merkle.build_manifest(docs, F.col("lang")).root is None


def test_recursion_limit_is_restored(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    found(spark, rows_of(5, ["en"]))
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
