from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidecast.llm import language, outliers


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    k, n = 3, 6
    emit, move, start = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    first = np.array([True, False, False, True, False, False])
    got = language.forward_backward(emit, first, move, start)
    expected = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        score = sum(emit[t, y] + (start[y] if first[t] else move[path[t - 1], y]) for t, y in enumerate(path))
        for t, y in enumerate(path):
            expected[t, y] += np.exp(score)
    assert got == pytest.approx(expected / expected.sum(axis=1, keepdims=True))


def test_long_chains_equal_word_by_word():
    rng = np.random.default_rng(2)
    k, n = 4, 5 * language.STRIDE + 17
    emit, move, start = 3 * rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    first = rng.random(n) < 0.01
    first[0] = True
    got = language.forward_backward(emit, first, move, start)
    edges = [*np.flatnonzero(first).tolist(), n]
    for a, b in itertools.pairwise(edges):
        ahead = [np.exp(emit[a] + start)]
        for t in range(a + 1, b):
            ahead.append(ahead[-1] @ np.exp(move) * np.exp(emit[t]))
            ahead[-1] /= ahead[-1].sum()
        back = [np.ones(k)]
        for t in range(b - 1, a, -1):
            back.append(np.exp(move) @ (np.exp(emit[t]) * back[-1]))
            back[-1] /= back[-1].sum()
        p = np.array(ahead) * np.array(back[::-1])
        assert got[a:b] == pytest.approx(p / p.sum(axis=1, keepdims=True))


@pytest.fixture(scope="module")
def crf(docs):
    return language.fit(docs, rounds=40)


def test_held_out_documents_are_recognised(docs, crf):
    got = language.predict(docs, crf).join(docs.select("doc_id", "lang", "text").distinct(), "doc_id")
    letters = got.where("n_letter_words >= 3 and held_out and lang is not null")
    assert letters.count() > 20
    assert letters.where("lang = lang_pred").count() >= 0.95 * letters.count()


def test_texts_without_letters_are_unknown(docs, crf, rows):
    got = {r.doc_id: r for r in language.predict(docs, crf).collect()}
    n = max(r[0] for r in rows if r[0] is not None)
    for i in (n - 5, n - 4, n - 3, n - 2):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.predict(docs, crf).count() == len(rows)


def test_labels_switch_within_a_text(crf):
    rnd = random.Random(4)
    word = lambda parts: "".join(rnd.choice(parts) for _ in range(3))
    text = [word(["ka", "lo", "mi", "tu"]) for _ in range(30)] + [word(["sch", "ber", "ung", "eit"]) for _ in range(30)]
    emit = np.stack([crf.emission(w) for w in text]).astype(float)
    first = np.arange(len(text)) == 0
    best = language.forward_backward(emit, first, crf.moves, crf.starts).argmax(axis=1)
    assert (best[:28] == 0).all() and (best[32:] == 1).all()
    assert (np.diag(crf.moves) > crf.moves.mean(axis=1)).all()


def test_held_out_rows_and_labels_are_not_learned_from(docs, crf):
    wrong = F.when(language.held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang"))
    assert language.fit(docs.withColumn("lang", wrong), rounds=1).labels == crf.labels


def test_language_of_empty_or_unlabelled_tables(docs, empty, crf):
    assert language.predict(empty, language.fit(empty)).collect() == []
    none = language.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.predict(docs, none).collect()} == {"und"}


def test_rejected_languages_go_and_columns_stay(docs, crf, rows):
    kept = language.keep_languages(docs, crf)
    assert kept.columns == docs.columns
    assert kept.count() == len(rows) - 4


def test_counts_of_texts(docs, rows):
    got = outliers.judge(docs, least_rows=20).collect()
    found = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert found == sorted((r[0] is not None, r[0] or 0, *brute.text_counts(r[1])) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_repeated_windows_and_lines(spark):
    texts = ["a b c d e f a b c d e", "x\nx\n\n \nx\ny", "a " * 12, "a b c d e", "# $ <b> | 100%\n# $ <b> | 100%", None, ""]
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in outliers.judge(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.text_counts(t)
    assert not got[5].kept


def vectors(spark, n=600, bad=40, seed=6):
    rng = np.random.default_rng(seed)
    x = rng.normal([5, 1.6, 0.1, 0.2, 0.1], [1, 0.1, 0.03, 0.1, 0.1], (n, 5))
    x[:, 1] += 0.05 * (x[:, 0] - 5)
    x[:bad] += [0, 0.9, 0.5, 0, 0]
    rows = [(i, "g", *map(float, v)) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, group string, x0 double, x1 double, x2 double, x3 double, x4 double")


def reference_estimate(x):
    """Concentration steps on exact distances; the floors are those of the operator."""
    floors = np.diag(np.array(list(outliers.STATISTICS.values())) ** 2)
    middle = np.median(x, axis=0)
    spread = 1.4826 * np.median(np.abs(x - middle), axis=0)
    found = []
    for mean, cov in ((middle, np.diag(spread**2) + floors), (x.mean(axis=0), np.cov(x.T, bias=True) + floors)):
        for _ in range(outliers.STEPS):
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            near = x[np.argsort(d)[: int(np.ceil(outliers.KEPT * len(x)))]]
            mean, cov = near.mean(axis=0), np.cov(near.T, bias=True) + floors
        found.append((np.linalg.slogdet(cov)[1], mean, cov))
    return min(found, key=lambda f: f[0])


def test_estimates_follow_the_majority(spark):
    x, df = vectors(spark)
    r = outliers.estimates(df, 50).first()
    _, mean, cov = reference_estimate(x)
    low = np.array([[r[f"l_{i}_{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    assert [r[f"m_{i}"] for i in range(5)] == pytest.approx(mean.tolist(), abs=0.05)
    assert (low @ low.T) == pytest.approx(cov, rel=0.1, abs=0.02)
    # A plain mean and covariance are drawn towards the outliers.
    assert abs(r["m_2"] - 0.1) < abs(x[:, 2].mean() - 0.1) / 2


def test_distance_is_mahalanobis(spark):
    x, df = vectors(spark)
    est = outliers.estimates(df, 50)
    r = est.first()
    low = np.array([[r[f"l_{i}_{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    mean = np.array([r[f"m_{i}"] for i in range(5)])
    expected = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(low @ low.T), x - mean)
    got = df.join(est, "group").select("id", outliers.distance([F.col(c) for c in outliers.STATISTICS]).alias("d")).orderBy("id").collect()
    assert [g.d for g in got] == pytest.approx(expected.tolist())
    far = expected / r["scale"]
    assert (far[:40] > outliers.CUTOFF).all() and (far[40:] < outliers.CUTOFF).all()


def test_small_groups_are_pooled(spark):
    rows = [(i, "en", f"s{i % 30}", False) for i in range(90)] + [(i, "de", "big", False) for i in range(60)] + [(1, None, None, False)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, base_failed boolean")
    got = {(r.lang, r.source): r.group for r in outliers.grouped(df, 50).collect()}
    assert len({g for (lang, _), g in got.items() if lang == "en"}) == 1
    assert got["de", "big"] == '{"lang":"de","source":"big"}' and got[None, None] == "rest"


def test_quality_of_an_empty_table(empty):
    assert outliers.judge(empty).collect() == []


def test_no_python_in_the_quality_plan(docs):
    text = outliers.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Pandas", "InArrow", "NestedLoop", "Cartesian"))


def test_all_letters_of_a_long_run_count():
    """A run of which only the first 64 and the last letters look like another language."""
    rnd = random.Random(2)
    parts = {"aa": ["ka", "lo", "mi", "tu", "ra", "no"], "bb": ["sch", "ber", "ung", "eit", "zen", "ach"]}
    run = lambda label, n: "".join(rnd.choice(parts[label]) for _ in range(n))
    crf = language.train({label: [[run(label, rnd.randint(1, 4)) for _ in range(60)] for _ in range(20)] for label in parts}, 20)
    word = run("aa", 32) + run("bb", 200) + run("aa", 3)
    assert crf.labels[int(crf.emission(word).argmax())] == "bb"
