from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidecast.llm import binary, packing, simple8b, tokens, words
from tidecast.llm.staging import new_path

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_those_of_the_library(path):
    rnd = random.Random(1)
    alphabet = ["a", "B", "the", " ", "  ", "\n", "\t", "\r\n", " ", "　", "é", "é", "ß", "12", "½", "'s", "'", "<|endoftext|>",
                "hello", "WORLD", ".", ",", "\x1c", "\x00", "日本", "İ", " ", "’", "😀", "\x0b"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    texts += ["".join(rnd.choice([a for a in alphabet if a.isascii()]) for _ in range(30)) for _ in range(1000)]
    texts += ["", None, " ", "\n\n", "a" * 500]
    library, own = Tokenizer.from_file(path), tokens.Encoder(path)
    data, offsets = words.buffers(pa.array(texts))
    for low, high in words.slices(offsets, 20_000):
        ids, bounds = own.encode(data[offsets[low] : offsets[high]], offsets[low : high + 1])
        for i in range(low, high):
            expected = library.encode(texts[i] or "", add_special_tokens=False).ids + [0]
            assert ids[bounds[i - low] : bounds[i - low + 1]].tolist() == expected


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for trial in range(100):
        sizes = rng.integers(0, 5 if trial % 7 == 0 else 3000, rng.integers(0, 8))
        bounds = np.append(0, np.cumsum(sizes)).astype(np.int64)
        values = rng.integers(0, 2**63, bounds[-1], dtype=np.uint64) * np.uint64(2) >> rng.integers(0, 64, bounds[-1]).astype(np.uint64)
        if trial % 3 == 0:
            values = rng.integers(0, 50_000, bounds[-1]).astype(np.uint64)
        if trial % 5 == 0:
            values[100:400] = 7
        coded, streams, blocks = simple8b.encode(values, bounds)
        block_sizes = np.array([min(simple8b.BLOCK, n - i) for n in sizes for i in range(0, n, simple8b.BLOCK)], np.int64)
        assert (simple8b.decode(coded, blocks, block_sizes) == values).all()
        if len(blocks) > 1:  # any block by itself
            last = coded[blocks[-1] :]
            assert (simple8b.decode(last, np.array([0]), block_sizes[-1:]) == values[-block_sizes[-1] :]).all()


def expected_ids(rows, path):
    library = Tokenizer.from_file(path)
    return [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_all_ids_in_order(spark, docs, rows):
    path = new_path(spark, "ids")
    binary.write_ids(docs, path, BYTE, shard_docs=40)
    got = sorted(tuple(r) for r in binary.corpus_index(spark, path).fillna(-1, ["doc_id"]).collect())
    per_id = defaultdict(list)
    for i, ids in expected_ids(rows, BYTE):
        per_id[-1 if i is None else i].append(ids)
    start, expected = 0, []
    for i in sorted(per_id):
        for ids in sorted(per_id[i], key=lambda x: (len(x), crc(x))):
            expected.append((i, start, len(ids), crc(ids)))
            start += len(ids)
    assert got == expected
    shards = spark.read.parquet(path).select("shard").distinct().count()
    assert shards > 2
    long = binary.read_ids(spark, path, with_ids=True).where("n_tokens > 20000").first()
    assert long.ids == next(ids for _, ids in expected_ids([r for r in rows if r[1] and len(r[1]) > 100_000], BYTE))


def test_files_of_an_empty_table(spark, empty):
    path = new_path(spark, "ids")
    binary.write_ids(empty, path, BYTE)
    assert binary.corpus_index(spark, path).collect() == []


def test_packing_places_every_piece_once(docs, rows):
    capacity = 256
    got = packing.pack(packing.cut_pieces(docs, WORD, capacity, with_ids=True), capacity).collect()
    expected = []
    for i, ids in expected_ids(rows, WORD):
        expected += [(i, k, k * capacity, ids[k * capacity : (k + 1) * capacity]) for k in range(-(-len(ids) // capacity))]
    found = [(r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4 for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // capacity) * 1.05 + 1


def test_packing_an_empty_table(empty):
    assert packing.pack(packing.cut_pieces(empty, WORD)).collect() == []


def checked(histogram, capacity=2048):
    """Number of sequences of the plan, and the share of the tokens below ``capacity`` that the program placed."""
    plan, n_program = packing.make_plan(histogram, capacity)
    placed = defaultdict(int)
    for content, times in plan:
        assert times > 0 and sum(k * v for k, v in content.items()) <= capacity
        for k, v in content.items():
            placed[k] += v * times
    assert placed == {k: v for k, v in histogram.items() if v}
    first = capacity in histogram
    made = sum(times * sum(k * v for k, v in content.items()) for content, times in plan[first : first + n_program])
    return sum(t for _, t in plan), made / max(1, sum(k * v for k, v in histogram.items() if k < capacity))


@pytest.mark.parametrize("many", [1, 40, 3000])
def test_plan_places_all_lengths_in_few_sequences(many):
    rng = np.random.default_rng(many)
    lengths = np.clip(rng.lognormal(6, 1, many * 20).astype(int), 1, 2048)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
    sequences, share = checked(histogram)
    assert sequences <= -(-int(lengths.sum()) // 2048) * 1.002 + 1
    assert share >= 0.5


def test_plan_of_documents_comes_from_the_program(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packing.cut_pieces(docs, WORD)
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    sequences, share = checked(histogram)
    assert sequences <= -(-sum(k * v for k, v in histogram.items()) // 2048) * 1.01
    assert share >= 0.5


def test_the_program_beats_best_fit():
    """Lengths whose size says little: a third of a sequence and more, or five of them."""
    rng = np.random.default_rng(0)
    near_thirds = np.clip(rng.normal(680, 30, 20_000).astype(int), 1, 2047)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(near_thirds, return_counts=True))}
    for counts, most in ((histogram, 6670), ({1100: 3000, 950: 2500, 700: 1000, 600: 4000, 353: 2000}, 5256)):
        sequences, share = checked(counts)
        assert sequences <= most < sum(t for _, t in packing.best_fit(counts, 2048)) - 50
        assert share == 1


@pytest.mark.parametrize("histogram", [{}, {2048: 3}, {5: 3}, {2000: 7, 1500: 9}, {1: 100_000, 2: 5}, {700: 1000, 2048: 2}])
def test_plan_of_odd_histograms(histogram):
    assert checked(histogram)[0] == sum(t for _, t in packing.best_fit(histogram, 2048))


def test_dual_prices_bound_every_configuration():
    lengths, counts = np.array([353, 600, 700, 950, 1100]), np.array([2000, 4000, 1000, 2500, 3000])
    found, bound, dual = packing.solve(lengths, counts, 2048, 2000, 0.1, 0.01)
    assert packing.best_configuration(lengths, dual, counts, 2048)[1] <= 1 + 1e-9
    assert bound == pytest.approx(float(dual @ counts))
    covered = sum(config * x for config, x in found)
    assert (covered >= counts * (1 - 1e-9)).all()
    assert bound <= sum(x for _, x in found) <= 1.03 * bound


def test_knapsack_prices():
    lengths, prices = np.array([2, 3, 7]), np.array([1.0, 1.6, 3.0])
    for bounds in ([9, 9, 9], [1, 2, 1], [0, 3, 0]):
        best, found = packing.best_configuration(lengths, prices, np.array(bounds), 10)
        fits = [(a, b, c) for a in range(bounds[0] + 1) for b in range(bounds[1] + 1) for c in range(bounds[2] + 1) if 2 * a + 3 * b + 7 * c <= 10]
        assert found == pytest.approx(max(float(np.dot(x, prices)) for x in fits)) == pytest.approx(float(best @ prices))
        assert tuple(best) in fits


def test_repeats_of_one_length_are_placed():
    plan = packing.best_fit({700: 5, 600: 1, 5: 1000}, 2048)
    placed = defaultdict(int)
    for content, times in plan:
        for k, v in content.items():
            placed[k] += v * times
    assert placed == {700: 5, 600: 1, 5: 1000}
