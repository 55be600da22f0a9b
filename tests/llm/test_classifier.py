from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidecast.llm import classifier, words

SCHEMA = "doc_id long, text string, lang string, quality long, score double, h int, piece string"


def found(texts, limit=classifier.SLICE_BYTES, bits=40):
    data, offsets = words.buffers(pa.array(texts, pa.string()))
    out = [Counter() for _ in texts]
    for part, bounds, rows in classifier.pieces(data, offsets, limit):
        for slot, owner in zip(*classifier.features(part, bounds, bits)):
            out[rows[owner // classifier.KINDS]][int(slot), int(owner % classifier.KINDS)] += 1
    return out


def n_features(text):
    """Words, neighbours, and runs of three and four characters whose inner characters are no white space."""
    space = r"[\x20\x09-\x0D]"
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    padded = f" {text} "
    runs = sum(bool(re.search(r"[^\x20\x09-\x0D]", padded[i + 1 : i + n - 1])) and not re.search(space, padded[i + 1 : i + n - 1]) for n in (3, 4) for i in range(len(padded) - n + 1))
    return len(ws) + max(len(ws) - 1, 0) + runs


TEXTS = ["a", "ab cd", "", None, "é ß 日本語 😀😀", " \n\t ", "one  two\r\nthree", "x" * 300, "la la la la"]


def test_features_are_those_defined():
    for text, have in zip(TEXTS, found(TEXTS)):
        assert sum(have.values()) == n_features(text or "")
    alone = [found([t])[0] for t in TEXTS]
    assert alone == found(TEXTS)


def test_a_repeated_word_has_one_pair_feature():
    a, b = (found([t])[0] for t in ("la la la la", "Und Und Und Und"))
    shared = a & b
    assert max(shared.values()) == 3


def test_long_texts_are_cut_at_white_space():
    rnd = random.Random(2)
    text = " ".join("".join(rnd.choice("abcé日") for _ in range(rnd.randint(1, 9))) for _ in range(4000))
    whole, cut = found([text])[0], found([text], limit=997)[0]
    n_cuts = sum(whole.values()) - sum(cut.values())
    assert 0 < n_cuts <= len(text.encode()) // 900 + 1
    assert not cut - whole
    solid = "é" * 3000
    assert sum(found([solid], limit=101)[0].values()) > 0.9 * sum(found([solid])[0].values())


def toy(n=1500, seed=4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        good = rnd.random() < 0.7
        body = ["".join(rnd.choice("kalomitu") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(20, 120))]
        if not good:
            body = [w + rnd.choice(["$$$", "***"]) for w in body] if rnd.random() < 0.5 else [body[0]] * len(body)
        rows.append((i, " ".join(body), "aa", int(good), 0.0, 1, "x"))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame(toy(), SCHEMA)
    return classifier.fit(docs, docs, epochs=20)


def test_held_out_labels_are_told_apart(spark, model):
    rows = toy()
    got = {r.doc_id: r for r in classifier.score(spark.createDataFrame(rows, SCHEMA).repartition(3), model).collect()}
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(got[r[0]].held_out == (r in held) for r in rows)
    assert sum(got[r[0]].predicted == r[3] for r in held) >= 0.97 * len(held)
    assert all(got[r[0]].predicted == int(got[r[0]].score >= 0.7) and 0 <= got[r[0]].score <= 1 for r in rows)


def test_scores_are_those_of_averaged_vectors(spark, model):
    rows = [(i, t, None, None, 0.0, 1, "x") for i, t in enumerate(TEXTS)] + [(None, "la la", None, None, 0.0, 1, "x"), (0, "a", None, None, 0.0, 1, "x")]
    got = classifier.score(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert len(got) == len(rows)
    bits = int(np.log2(len(model.table)))
    for r in got:
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        have = found([text], bits=bits)[0]
        kinds = {kind for _, kind in have}
        means = [sum(model.table[k].astype(float) * n for (k, o), n in have.items() if o == kind) / sum(n for (_, o), n in have.items() if o == kind) for kind in kinds]
        mean = np.mean(means, axis=0) if means else np.zeros(model.table.shape[1])
        logits = mean @ model.weights + model.bias
        assert r.score == pytest.approx(1 / (1 + np.exp(logits[0] - logits[1])), abs=1e-5)


def test_held_out_and_contradicting_labels_are_not_learned_from(spark):
    rows = toy(120)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    docs = spark.createDataFrame(rows, SCHEMA)
    clean = [(r[0], r[3]) for r in rows if not held(r[0])]
    odd = [(i, 1 - y) for i, y in ((r[0], r[3]) for r in rows if held(r[0]))] + [(None, 1), (3, None), (9999, 0)]
    labels = "doc_id long, quality int"
    first = classifier.fit(docs, spark.createDataFrame([c for c in clean if c[0] != 1], labels), epochs=2)
    second = classifier.fit(docs, spark.createDataFrame([*clean, *odd, *clean, (1, 0), (1, 1)], labels), epochs=2)
    weights = [m.numbers()[0] for m in (first, second)]
    assert np.corrcoef(*weights)[0, 1] > 0.95


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame(toy(5), SCHEMA)
    none = classifier.fit(docs, docs.limit(0))
    assert {r.score for r in classifier.score(docs, none).collect()} == {0.5}
    assert classifier.score(docs.limit(0), none).collect() == []
