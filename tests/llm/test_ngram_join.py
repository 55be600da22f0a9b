from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm import brute
from tidecast.llm import ngram_join, words
from tidecast.llm.components import components


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_components_are_those_of_all_pairs(docs, rows):
    got = [tuple(r) for r in ngram_join.join_components(docs).collect()]
    assert ordered(got) == ordered(brute.components(rows))


def test_short_and_edited_texts(spark):
    """Sizes around every band's edge, chains of edits, a hot group of near copies and a shared passage."""
    rnd = random.Random(5)
    rows = []
    passage = [rnd.choice("abcdefghij") for _ in range(60)]
    for i in range(500):
        if rows and rnd.random() < 0.7:
            w = rnd.choice(rows[: 1 + len(rows) // 3])[1].split(" ")
            for _ in range(rnd.randint(0, 3)):
                k, what = rnd.randrange(len(w)), rnd.random()
                if what < 0.4:
                    w[k] = rnd.choice("abcdefghij")
                elif what < 0.7:
                    w.insert(k, rnd.choice("ABCDEFG"))
                elif len(w) > 1:
                    w.pop(k)
        else:
            w = [rnd.choice(["aa", "b", "c", "dd", "e", "f", "g", "h"]) for _ in range(rnd.choice([1, 2, 4, 5, 9, 10, 15, 16, 22, 40, 80, 200]))]
            if rnd.random() < 0.2:
                w += passage
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in ngram_join.join_components(df).collect()]
    assert ordered(got) == ordered(brute.components(rows))
    assert len({r[2] for r in got}) < 480


def test_other_thresholds(spark, rows):
    some = [(r[0], r[1]) for r in rows if r[1] is not None and len(r[1]) < 3000]
    df = spark.createDataFrame(some, "doc_id long, text string")
    got = [tuple(r) for r in ngram_join.join_components(df, n=3, percent=60).collect()]
    assert ordered(got) == ordered(brute.components(some, 3, 60))


def test_empty_table(empty):
    assert ngram_join.join_components(empty).collect() == []
    assert ngram_join.keep_one(empty).collect() == []


def test_one_of_each_group_stays_with_all_columns(docs, rows):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert got == sorted({c for i, _, c in brute.components(rows) if i is not None and i == c})
    assert kept.where("doc_id is null").count() == 1


def test_segments_are_allocated_by_cost():
    plan = ngram_join.bands(85, 10_000)
    assert any(b.deletion for b in plan) and not all(b.deletion for b in plan)
    for band in plan:
        most = 15 * 2 * band.high // 185
        assert band.segments + band.deletion == most + 1 + band.slack
        assert band.deletion or max(band.rare, band.common) <= band.slack


def test_partners_are_at_most_one_band_up(spark):
    for percent in (30, 50, 60, 80, 85):
        highs = [b.high for b in ngram_join.bands(percent, 10_000)]
        assert all(100 * a // percent <= b for a, b in zip(highs, highs[1:]))
    rows = [(n, " ".join(f"t{n}x{i}" for i in range(n))) for n in range(20, 120)]
    rows += [(1000 + r[0], r[1] + "".join(f" more{i}" for i in range(r[0] * 66 // 100))) for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in ngram_join.join_components(df, n=1, percent=60).collect()]
    assert ordered(got) == ordered(brute.components(rows, 1, 60))
    assert len({r[2] for r in got}) == 100


def test_common_elements_change_no_result(spark, docs, rows, monkeypatch):
    """Whatever counts as common, the components are the same."""
    expected = ordered(brute.components(rows))
    for items in (lambda *a: np.zeros(0, np.uint64), lambda *a: np.sort(np.concatenate([all_items(rows)[::2]]))):
        monkeypatch.setattr(ngram_join, "common_items", items)
        assert ordered(tuple(r) for r in ngram_join.join_components(docs).collect()) == expected


#: A text of 90 words, a pair with 14 edits in common and 8 of its own each, and texts with one word replaced.
BASE = [f"w{i}" for i in range(90)]
PAIR = [[*BASE[11:], *[f"both{i}" for i in range(7)], *[f"u{i}" for i in range(4)]], [*BASE[:4], *BASE[15:], *[f"both{i}" for i in range(7)], *[f"v{i}" for i in range(4)]]]
NEAR = [[*BASE[:20], f"x{k}", *BASE[21:]] for k in range(12)]


def by_edits(spark, monkeypatch, rows, buckets):
    """Components of single words at 0.8, with given buckets and comparison by edits only."""
    monkeypatch.setattr(ngram_join, "SMALL_BUCKET", 2)
    monkeypatch.setattr(ngram_join, "_stars", lambda rows, turn: rows.select(F.col("key").alias("u"), F.col("key").alias("v")).limit(0))
    given = spark.createDataFrame(buckets, "doc_id long, bucket long, weight long")
    monkeypatch.setattr(ngram_join, "members", lambda sketches, plan: sketches.join(given, "doc_id").select("bucket", "key", "weight").distinct())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return ordered(tuple(r) for r in ngram_join.join_components(df, n=1, percent=80).collect())


def test_repeated_rows_in_a_large_bucket(spark, monkeypatch):
    """Edits of a text count once, however often its row is there."""
    rows = [(i, " ".join(w)) for i, w in enumerate([BASE, *PAIR, *NEAR])]
    rows += [rows[1], rows[1], rows[2], rows[2]]
    buckets = [(i, 0, 99 if i == 0 else 50) for i in range(15)]
    expected = ordered(brute.components(rows, 1, 80))
    assert {c for _, _, c in expected} == {0, 1}
    assert by_edits(spark, monkeypatch, rows, buckets) == expected


def test_links_without_shared_edits_in_the_last_turn(spark, monkeypatch):
    """When the bucket of near copies closes, what the pair has in common becomes the consensus of the rest."""
    rows = [(i, " ".join(w)) for i, w in enumerate([BASE, *PAIR, *NEAR])]
    buckets = [(i, 0, 99 if i == 0 else 50) for i in range(3)] + [(i, 1, 99 if i == 0 else 50) for i in (0, *range(3, 15))]
    expected = ordered(brute.components(rows, 1, 80))
    assert {c for _, _, c in expected} == {0, 1}
    assert by_edits(spark, monkeypatch, rows, buckets) == expected


def test_edits_of_one_class_alone_make_no_rows(spark, monkeypatch):
    """Texts that share a passage only have many edits that no other has, and too few in common to link; near copies stay."""
    rows = [(i, " ".join([*BASE, *[f"own{i}x{k}" for k in range(200)]])) for i in range(40)]
    rows += [(100 + i, " ".join(w)) for i, w in enumerate([BASE, *PAIR, *NEAR])]
    made, spread = [], ngram_join._spread

    def counted(edits):
        made.append((edits.agg(F.sum(F.size("items"))).first()[0], spread(edits).count()))
        return spread(edits)

    monkeypatch.setattr(ngram_join, "_spread", counted)
    expected = ordered(brute.components(rows, 1, 80))
    assert by_edits(spark, monkeypatch, rows, [(r[0], 0, 99 if r[0] == 100 else 50) for r in rows]) == expected
    assert {c for _, _, c in expected} == {*range(40), 100, 101}
    # 40 * 200 edits are of one class each. A few may meet a bit of the bitmap.
    assert made and max(items for items, _ in made) < 400
    assert max(n for _, n in made) < 100


def all_items(rows):
    data, offsets = words.buffers(pa.array([r[1] for r in rows]))
    return np.unique(ngram_join.shingle_sets(data, offsets, 4)[0])


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
