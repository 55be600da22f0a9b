from __future__ import annotations

import ctypes
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import brute
from tidecast.llm import packing, queries, tokens
from tidecast.llm.staging import release, stage


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "secrets", "mixing", "packing"]
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {"pipeline", *queries.QUERIES} <= set(entry.queries())


def key(r):
    return (r is None, r or 0)


def test_stages_over_planted_cases(spark, docs, rows, tmp_path):
    secret = "token=" + "".join(random.Random(1).choice("0123456789abcdef") for _ in range(40))
    planted = [(5000, f"kalo mitu {secret} rano lotu kamira", "aa", "s1", 1, 7, 8, "x", 9, 10)]
    df = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    given = [*rows, *planted]
    out, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, out, str(tmp_path)), name)
        seen[name] = out.collect()
        if name != "packing":
            assert out.columns == df.columns
    known = [r for r in given if any(c.isalpha() for c in r[1] or "")]
    assert sorted((r.doc_id for r in seen["language"]), key=key) == sorted((r[0] for r in known), key=key)
    least = [i for i, _, c in brute.components(known) if i is None or i == c]
    assert sorted((r.doc_id for r in seen["near_duplicates"]), key=key) == sorted(set(least), key=key)
    texts = {r[0]: r[1] for r in known}
    for r in seen["secrets"]:
        assert (r.text == texts[r.doc_id]) == (r.doc_id != 5000)
        assert r.n_chars == len(r.text)
    assert [r.text for r in seen["secrets"] if r.doc_id == 5000] == ["kalo mitu [secret] rano lotu kamira"]
    times = Counter(r.doc_id for r in seen["mixing"])
    mixed = brute.mix([(r.doc_id, r.text, r.lang, r.source) for r in seen["secrets"]])
    assert times == {i: t // z for i, _, z, _, _, t in mixed if t}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    clean = {r.doc_id: r.text for r in seen["secrets"]}
    tokens = {i: len(library.encode(clean[i], add_special_tokens=False).ids) + 1 for i in times}
    assert sum(r.length for r in seen["packing"]) == sum(tokens[i] * n for i, n in times.items())
    assert Counter(r.doc_id for r in seen["packing"] if r.piece == 0) == times


def test_near_copies_by_five_words_and_a_similarity_of_080(spark, docs, rows):
    """Appended text and single-word edits that four-word n-grams at 0.85 do not link."""
    words = [f"w{i}" for i in range(500)]
    edited = [f"x{i}" if i % 45 == 20 else w for i, w in enumerate(words)]
    planted = [(6000, words), (6001, edited), (6002, words + [f"y{i}" for i in range(100)]), (6003, words + [f"z{i}" for i in range(130)])]
    planted = [(i, " ".join(w), "aa", "s0", 1, 7, 8, "x", 9, 10) for i, w in planted]
    every = [*rows, *planted]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.unionByName(spark.createDataFrame(planted, docs.schema)), "").collect()
    assert sorted({r.doc_id for r in kept}, key=key) == sorted({i for i, _, c in brute.components(every, 5, 80) if i is None or i == c}, key=key)
    assert sorted(r.doc_id for r in kept if (r.doc_id or 0) >= 6000) == [6000, 6003]
    assert {6001, 6002} <= {i for i, _, c in brute.components(every) if i == c}


def test_pipeline_of_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_hold_little_in_python_workers(spark, docs):
    """Short batches in every stage with Python, freed memory given back, and few remembered pieces for the same ids."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    try:
        for name, step in corpus_pipeline.STAGES:
            if name != "mixing":
                spark.conf.set(rows, "10000")
                step(spark, docs, "")
                assert int(spark.conf.get(rows)) <= 500, name
    finally:
        spark.conf.set(rows, before)
    path = public_tokenizers.path("word_bpe_49k.json")
    usual, few = (packing.cut_pieces(docs, path, remembered=n) for n in (None, 50))
    assert sorted(map(str, usual.collect())) == sorted(map(str, few.collect()))
    held = tokens.Encoder(path, 50)
    for low in range(0, 1000, 50):
        text = " ".join(f"w{i}" for i in range(low, low + 50)).encode()
        held.encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert len(held.keys) <= 100


def test_a_task_gives_free_memory_back():
    """Small blocks between kept ones are not returned by free alone."""
    def resident():
        return int(open("/proc/self/statm").read().split()[1]) * 4096

    libc = ctypes.CDLL(None)
    libc.malloc.restype, libc.free.argtypes = ctypes.c_void_p, [ctypes.c_void_p]
    blocks = [libc.malloc(100_000) for _ in range(1000)]
    for b in blocks:
        ctypes.memset(b, 1, 100_000)
    for b in blocks[:-1]:
        libc.free(b)
    full = resident()
    release()
    assert full - resident() > 50_000_000
    libc.free(blocks[-1])


def test_vocabulary_path_is_a_parameter(docs):
    a = packing.cut_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")).agg({"length": "sum"}).first()[0]
    b = packing.cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json")).agg({"length": "sum"}).first()[0]
    assert a != b and np.isfinite(a)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_on_small_tables(spark, name):
    out = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    table = "embeddings" if name.startswith("op5") else "pages" if name.startswith("op9") else "documents"
    if table == "documents" and not name.startswith("op3"):
        assert out.count() == spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").count()
    else:
        assert out.count() > 0
