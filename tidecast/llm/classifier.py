"""Quality classifier by supervised subword embeddings.

A text's features are its words, its pairs of neighbouring words and the runs of three and four characters that
touch no white space but at their rims. Each is hashed into a table of learned vectors. The document is the
average of the averages of these three kinds (else the many runs would drown the pairs), and a softmax over it gives the
probabilities of both labels. Table and softmax are trained together by stochastic gradient descent in numpy (batches, steps scaled by the gradients seen so far). The pair of neighbours
is hashed by the difference of its words' hashes, so that a word that repeats itself has one feature, whatever the word.

The fit reads a bounded sample: of each label the ``per_class`` documents with the least hashes, and ``window`` characters of
each, at a place that its hash picks. Examples are weighted by how many labelled documents they stand for. Scoring reads whole texts. It needs
no vectors: the softmax is linear, so each table row is reduced to one number, and a text takes their means.

A null or empty text is scored by the bias alone. Repeated rows are scored each. Repeated labels of a document with the same
value count once; with different values it is not learned from. Rows without id or label are not learned
from. Without labels, every score is 0.5; with only one label, training goes on with that. An empty table gives no
rows. Other columns are not read. In a text beyond ``SLICE_BYTES``, a pair of words across a cut is not counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm import words
from tidecast.llm.staging import map_batches
from tidecast.llm.language import held_out

SLICE_BYTES = 500_000
#: Lengths of the character runs.
RUNS = (3, 4)
#: Words, pairs, runs.
KINDS = 3
_SALT = {"word": np.uint64(0x51ED270B7A1F4C35), "pair": np.uint64(0x2545F4914F6CDD1D), 3: np.uint64(0x9E6C63D0876A9A47), 4: np.uint64(0xC2B2AE3D27D4EB4F)}
_STEP = np.uint64(0x100000001B3)


def pieces(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets and row numbers of slices of at most ``limit`` bytes; longer rows are cut, at white space where there is any."""
    for low, high in words.slices(offsets, limit):
        if offsets[high] - offsets[low] <= limit:
            yield data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], np.arange(low, high)
            continue
        at, end = int(offsets[low]), int(offsets[high])
        while at < end:
            stop = min(at + limit, end)
            if stop < end:
                gaps = np.flatnonzero(words.SPACES[data[at:stop]])
                if len(gaps):
                    stop = at + int(gaps[-1]) + 1
                else:
                    while stop > at + 1 and data[stop] & 0xC0 == 0x80:
                        stop -= 1
            yield data[at:stop], np.array([0, stop - at]), np.array([low])
            at = stop


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all features of a slice, and ``KINDS`` times the slice's row that each belongs to, plus its kind."""
    shift = np.uint64(64 - bits)

    def slot(values: np.ndarray, salt: np.uint64) -> np.ndarray:
        return (words.mix(values ^ salt) >> shift).astype(np.int64)

    starts, lengths, rows = words.spans(data, offsets)
    own = words.hashes(data, starts, lengths)
    near = np.flatnonzero(rows[1:] == rows[:-1]) + 1
    found, owners = [slot(own, _SALT["word"]), slot(own[near] - own[near - 1], _SALT["pair"])], [KINDS * rows, KINDS * rows[near] + 1]
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    bounds = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    # A space before each row and one at the end.
    text = np.full(len(chars) + len(offsets), 32, np.uint64)
    text[np.arange(len(chars)) + row + 1] = chars
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds) + 1)
    space = (text == 32) | ((text >= 9) & (text <= 13))
    text[space] = 32
    for n in RUNS:
        m = len(text) - n + 1
        if m <= 0:
            continue
        inside = ~space[1 : m + 1]
        for k in range(2, n - 1):
            inside = inside & ~space[k : m + k]
        at = np.flatnonzero(inside)
        value = text[at]
        for k in range(1, n):
            value = value * _STEP + text[at + k]
        found.append(slot(value, _SALT[n]))
        # The first place of a run belongs to its row, the space before the row included.
        owners.append(KINDS * owner[at] + 2)
    return np.concatenate(found), np.concatenate(owners)


@dataclass
class Classifier:
    """Table of vectors, softmax weights and bias."""

    table: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def numbers(self) -> tuple[np.ndarray, float]:
        """What each table row and the bias add to the log odds of label 1."""
        return (self.table @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def _batch(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The features of a batch: distinct table rows, and place, text and share of each distinct (row, text)."""
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    slots, owners = features(data, offsets, bits)
    n = KINDS * len(texts)
    total = np.bincount(owners, minlength=n)
    kinds = (total.reshape(-1, KINDS) > 0).sum(axis=1)
    # A feature of one hash may be of several kinds; its shares add up.
    pair, count = np.unique(slots * n + owners, return_counts=True)
    owner = pair % n
    share = count / total[owner] / kinds[owner // KINDS]
    pair, number = np.unique(pair // n * len(texts) + owner // KINDS, return_inverse=True)
    used, place = np.unique(pair // len(texts), return_inverse=True)
    return used, place.astype(np.int32), (pair % len(texts)).astype(np.int16), np.bincount(number, weights=share).astype(np.float32)


def train(texts: list[bytes], labels: list[int], weights: list[float], dim: int = 8, bits: int = 18, epochs: int = 8, rate: float = 0.3, size: int = 64, spread: float = 0.01, seed: int = 5) -> Classifier:
    """Fit table and softmax by stochastic gradient descent on the weighted cross entropy."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-spread, spread, (1 << bits, dim)).astype(np.float32)
    state = [np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)]
    model = Classifier(table, *state)
    order = rng.permutation(len(texts))
    truth, weight = np.array(labels, np.int64), np.array(weights, np.float32)
    seen_table, seen = np.full(1 << bits, 1e-8, np.float32), [np.full_like(s, 1e-8) for s in state]
    batches = [order[i : i + size] for i in range(0, len(order), size)]
    parts = [_batch([texts[i] for i in rows], bits) for rows in batches]
    scale = weight.mean() if len(weight) else 1.0
    for epoch in range(epochs):
        for b in rng.permutation(len(batches)):
            rows, (used, place, owner, share) = batches[b], parts[b]
            x = np.zeros((len(rows), len(used)), np.float32)
            x[owner, place] = share
            vectors = table[used]
            hidden = x @ vectors
            logits = hidden @ model.weights + model.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), truth[rows]] -= 1
            p *= (weight[rows] / scale)[:, None] / len(rows)
            slopes = [hidden.T @ p, p.sum(axis=0)]
            slope = x.T @ (p @ model.weights.T)
            step = rate * (1 - epoch / epochs)
            seen_table[used] += (slope**2).mean(axis=1)
            table[used] = vectors - step * slope / np.sqrt(seen_table[used])[:, None]
            for value, total, g in zip(state, seen, slopes):
                total += g**2
                value -= step * g / np.sqrt(total)
    return model


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = 2000, window: int = 3000, label: str = "quality",
    doc_id: str = "doc_id", text: str = "text", **training: float,
) -> Classifier:
    """Learn from a bounded sample of the labelled documents that are not held out."""
    marked = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
    marked = marked.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("doc_id"))
    marked = marked.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other")
    counts = {r.y: r.n for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    marked = marked.withColumn("h", F.xxhash64("doc_id", F.lit(9)))
    picked = None
    for y in sorted(counts):
        some = marked.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        return Classifier(np.zeros((1, 1), np.float32), np.zeros((1, 2), np.float32), np.zeros(2, np.float32))
    spare = F.greatest(F.length("text") - window, F.lit(0)) + 1
    piece = F.substring("text", F.lit(1) + F.pmod("h", spare).cast("int"), F.lit(window))
    # At most twice ``per_class`` rows of ids.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id", "y", "h").agg(F.min(F.coalesce(piece, F.lit(""))).alias("piece")).collect()
    rows = sorted(rows, key=lambda r: (r.h, str(r.doc_id)))
    taken = {y: sum(r.y == y for r in rows) for y in counts}
    weights = [counts[r.y] / taken[r.y] for r in rows]
    return train([r.piece.encode() for r in rows], [r.y for r in rows], weights, **training)


def score(docs: DataFrame, model: Classifier, least: float = 0.7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, n_features`` of every whole text."""
    numbers, bias = model.numbers()
    bits = int(np.log2(len(numbers)))
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()), T.StructField("n_features", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.buffers(batch.column(2))
            total, count = np.zeros((batch.num_rows, KINDS)), np.zeros((batch.num_rows, KINDS), np.int64)
            for part, bounds, rows in pieces(data, offsets) if bits else ():
                slots, owners = features(part, bounds, bits)
                total[rows] += np.bincount(owners, weights=numbers[slots], minlength=KINDS * len(rows)).reshape(-1, KINDS)
                count[rows] += np.bincount(owners, minlength=KINDS * len(rows)).reshape(-1, KINDS)
            kinds = (count > 0).sum(axis=1)
            odds = (total / np.maximum(count, 1)).sum(axis=1) / np.maximum(kinds, 1) + bias
            p = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            columns = [*batch.columns[:2], pa.array(p), pa.array((p >= least).astype(np.int32)), pa.array(count.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(docs.select(F.col(doc_id), held_out(doc_id).alias("held_out"), F.col(text)), run, schema)
