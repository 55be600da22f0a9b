"""Language identification with a linear-chain conditional random field over the words of a text.

Words are runs of letters, in lower case. A word's features are its prefixes and suffixes up to four
letters, its letter trigrams, its length and the languages in whose lexicon it is; they are hashed into a
fixed table of weights. Learned transitions carry evidence from word to word, so a run of words that fit
several languages takes that of its neighbours, and a text that switches language is labelled word by
word. Forward-backward gives every word's probability of every language; a document's language is the one
with the largest sum of probabilities over its words, and its score is that sum's share.

Training chains are made of spans of labelled documents of different languages, so that switches occur.
The lexicon comes from one half of the sample and the weights are fitted on the other half, else the
lexicon would explain every word. The sample is bounded (``per_language`` documents of each language and
``window`` characters of each, at a place that its hash picks); prediction reads whole texts.

A text that is null or has no letter is ``und`` with score 0. Rows without label or without id are not
learned from. Repeated rows are predicted each. An empty table, or one without labels, gives ``und`` for
every row. Columns other than id, text and label are kept by :func:`keep_languages` and else not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm import words
from tidecast.llm.staging import map_batches, worker_store

UNKNOWN = "und"
#: Hashed features; the first entries belong to the lexicon, the length and the bias.
WEIGHTS = 1 << 17
SLICE_BYTES = 1_000_000
REMEMBERED = 800_000
#: New runs of letters that are featurised at a time, and their bytes.
CHUNK, CHUNK_BYTES = 4096, 1 << 17
#: Chain steps that are multiplied one after the other; chains beyond that run side by side.
STRIDE = 128

_LETTERS = re.compile(r"[^\W\d_]+")


def _letters() -> np.ndarray:
    """Bytes that may belong to a letter: ASCII letters and all of other scripts."""
    table = np.zeros(256, dtype=bool)
    table[65:91] = table[97:123] = table[128:] = True
    return table


LETTER_BYTES = _letters()


def features(word: str, lexicon: dict[str, int], n_labels: int) -> list[int]:
    """Numbers of a word's features."""
    out = [0, 1 + min(len(word), 15), 17 + lexicon.get(word, n_labels)]
    marked = f"<{word}>"
    parts = [f"p{word[:k]}" for k in range(1, min(4, len(word)) + 1)]
    parts += [f"s{word[-k:]}" for k in range(1, min(4, len(word)) + 1)]
    parts += [marked[i : i + 3] for i in range(len(marked) - 2)]
    low = 18 + n_labels
    return out + [low + zlib.crc32(p.encode()) % (WEIGHTS - low) for p in parts]


@dataclass
class Crf:
    """Labels, feature weights, transitions (from, to) and start weights; all in log space."""

    labels: list[str]
    lexicon: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray | None = None
    moves: np.ndarray | None = None
    starts: np.ndarray | None = None

    def emission(self, word: str) -> np.ndarray:
        return self.weights[features(word, self.lexicon, len(self.labels))].sum(axis=0)


def _scaled(x: np.ndarray) -> np.ndarray:
    axes = tuple(range(1, x.ndim))
    return x / x.max(axis=axes, keepdims=True)


def forward_backward(emissions: np.ndarray, first: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Probabilities of every label at every word of many chains, laid end to end.

    ``first`` marks the first word of each chain. There the step forgets what came before, so all chains
    are one product of small matrices; it is cut into pieces that are multiplied side by side, and the
    pieces are joined by their products, which gives the same result as going word by word.
    """
    n, k = emissions.shape
    if not n:
        return emissions
    n_pieces = -(-n // STRIDE)
    pad = n_pieces * STRIDE - n
    emit = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    emit = np.concatenate([emit, np.ones((pad, k))]).reshape(n_pieces, STRIDE, k)
    head = np.concatenate([first, np.ones(pad, dtype=bool)]).reshape(n_pieces, STRIDE)
    move, start = np.exp(moves - moves.max()), np.exp(starts - starts.max())

    whole = np.broadcast_to(np.eye(k), (n_pieces, k, k))
    for t in range(STRIDE):
        step = whole @ move
        reset = head[:, t]
        if reset.any():
            step[reset] = whole[reset].sum(axis=2, keepdims=True) * start
        whole = _scaled(step * emit[:, t, None, :])
    into, back = np.empty((n_pieces, k)), np.empty((n_pieces, k))
    state = np.ones(k) / k
    for i in range(n_pieces):
        into[i] = state
        state = state @ whole[i]
        state = state / state.sum()
    state = np.ones(k) / k
    for i in range(n_pieces - 1, -1, -1):
        back[i] = state
        state = whole[i] @ state
        state = state / state.sum()

    forward = np.empty((n_pieces, STRIDE, k))
    state = into
    for t in range(STRIDE):
        step = state @ move
        reset = head[:, t]
        step[reset] = start
        state = step * emit[:, t]
        state = state / state.sum(axis=1, keepdims=True)
        forward[:, t] = state
    state = back
    for t in range(STRIDE - 1, -1, -1):
        here = forward[:, t] * state
        ahead = state * emit[:, t]
        reset = head[:, t]
        state = ahead @ move.T
        state[reset] = (ahead[reset] @ start)[:, None]
        state = state / state.sum(axis=1, keepdims=True)
        forward[:, t] = here / here.sum(axis=1, keepdims=True)
    return forward.reshape(-1, k)[:n]


def chains(samples: dict[int, list[list[str]]], rng: np.random.Generator, span: tuple[int, int] = (8, 40), spans: int = 6) -> list[list[tuple[str, int]]]:
    """Chains of spans of documents of random languages; every word of the sample is in one."""
    cut = []
    for label, docs in samples.items():
        for doc in docs:
            at = 0
            while at < len(doc):
                n = int(rng.integers(*span))
                cut.append([(w, label) for w in doc[at : at + n]])
                at += n
    order = rng.permutation(len(cut))
    return [sum((cut[j] for j in order[i : i + spans]), []) for i in range(0, len(order), spans)]


def train(samples: dict[str, list[list[str]]], rounds: int = 60, rate: float = 0.15, decay: float = 1e-6, seed: int = 11) -> Crf:
    """Fit by gradient steps (Adam) on the exact conditional likelihood."""
    labels = sorted(samples)
    rng = np.random.default_rng(seed)
    known, fitted = {}, {}
    for i, name in enumerate(labels):
        docs = [d for d in samples[name] if d]
        half = len(docs) // 2
        known[i], fitted[i] = docs[:half], docs[half:]
    crf = Crf(labels, _lexicon(known, len(labels)))
    k = len(labels)
    rows = chains(fitted, rng)
    if not rows:
        return crf
    vocabulary: dict[str, int] = {}
    word = np.array([vocabulary.setdefault(w, len(vocabulary)) for row in rows for w, _ in row])
    truth = np.array([y for row in rows for _, y in row])
    first = np.zeros(len(word), dtype=bool)
    first[np.cumsum([0, *(len(r) for r in rows[:-1])])] = True
    lists = [features(w, crf.lexicon, k) for w in vocabulary]
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    column = np.array([f for x in lists for f in x])
    used, column = np.unique(column, return_inverse=True)
    state = {"w": np.zeros((len(used), k)), "m": np.eye(k) * 2.0, "s": np.zeros(k)}
    inner = ~first
    seen_moves = np.zeros((k, k))
    np.add.at(seen_moves, (truth[:-1][inner[1:]], truth[1:][inner[1:]]), 1)
    seen_words = np.stack([np.bincount(word[truth == y], minlength=len(lists)) for y in range(k)], axis=1).astype(float)
    seen_starts = np.bincount(truth[first], minlength=k)
    moment = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in state.items()}
    for turn in range(1, rounds + 1):
        emit = np.stack([np.bincount(owner, weights=state["w"][column, y], minlength=len(lists)) for y in range(k)], axis=1)
        p = forward_backward(emit[word], first, state["m"], state["s"])
        expected = np.stack([np.bincount(word, weights=p[:, y], minlength=len(lists)) for y in range(k)], axis=1)
        by_word = (seen_words - expected)[owner]
        slope = {"w": np.stack([np.bincount(column, weights=by_word[:, y], minlength=len(used)) for y in range(k)], axis=1)}
        slope["s"] = seen_starts - p[first].sum(axis=0)
        slope["m"] = seen_moves - _expected_moves(p, emit[word], state["m"], inner)
        for name, value in state.items():
            g = slope[name] / len(word) - decay * value
            a, b = moment[name]
            a, b = 0.9 * a + 0.1 * g, 0.99 * b + 0.01 * g * g
            moment[name] = a, b
            state[name] = value + rate * (a / (1 - 0.9**turn)) / (np.sqrt(b / (1 - 0.99**turn)) + 1e-8)
    crf.weights = np.zeros((WEIGHTS, k), np.float32)
    crf.weights[used] = state["w"]
    crf.moves, crf.starts = state["m"], state["s"]
    return crf


def _expected_moves(p: np.ndarray, emit: np.ndarray, moves: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Expected transitions, with the pairs' probabilities rebuilt from those of the single words.

    p(a, b) is proportional to f(a) * move(a, b) * g(b); f and g are fitted to both margins, which
    determine them.
    """
    left, right = p[:-1][inner[1:]], p[1:][inner[1:]]
    move = np.exp(moves - moves.max())
    f, g = left.copy(), right.copy()
    for _ in range(8):
        f = left / np.maximum(g @ move.T, 1e-12)
        g = right / np.maximum(f @ move, 1e-12)
    return (f.T @ g) * move


def _lexicon(known: dict[int, list[list[str]]], n_labels: int, least: int = 3, share: float = 0.8) -> dict[str, int]:
    """Words seen often and almost only in one language, with that language."""
    counts: dict[str, np.ndarray] = {}
    for label, docs in known.items():
        for doc in docs:
            for w in doc:
                counts.setdefault(w, np.zeros(n_labels))[label] += 1
    return {w: int(c.argmax()) for w, c in sorted(counts.items()) if c.sum() >= least and c.max() >= share * c.sum()}


def letter_words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def held_out(doc_id: str | Column) -> Column:
    """Whether a document is never learned from: crc32 of its id modulo 4 is 2."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, per_language: int = 200, window: int = 6_000, rounds: int = 60,
    doc_id: str = "doc_id", text: str = "text", label: str = "lang",
) -> Crf:
    """Learn from a bounded sample of the labelled documents that are not held out.

    The sample takes the ``per_language`` documents with the least hashes of each language: a first pass
    over ids and labels finds the hash that ends it, a second one reads the texts.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"), F.col(text).alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out("doc_id"))
    rows = rows.withColumn("h", F.xxhash64("doc_id", F.lit(3)))
    nth = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    last = rows.select("label", "h").withColumn("nth", nth).where(F.col("nth") <= per_language)
    ends = {r.label: r.h for r in last.groupBy("label").agg(F.max("h").alias("h")).collect()}
    if not ends:
        return Crf([])
    limit = F.create_map(*[x for name, h in sorted(ends.items()) for x in (F.lit(name), F.lit(h))])
    spare = F.greatest(F.length("text") - window, F.lit(0)) + 1
    piece = F.substring("text", F.lit(1) + F.pmod("h", spare).cast("int"), F.lit(window))
    picked = rows.where(F.col("h") <= limit[F.col("label")]).select("label", "h", piece.alias("piece"))
    samples: dict[str, list[list[str]]] = {name: [] for name in ends}
    for r in sorted(picked.collect(), key=lambda r: (r.label, r.h, r.piece or "")):
        if len(samples[r.label]) < per_language:
            samples[r.label].append(letter_words(r.piece or ""))
    return train(samples, rounds)


class _Worker:
    """Emissions of the words seen by one Python worker, by hash."""

    def __init__(self, crf: Crf):
        self.crf = crf
        self.forget()

    def forget(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.table, self.used = np.zeros((1 << 12, len(self.crf.labels)), np.float32), 0

    def add(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Put the emissions of runs of letters into the table; NaN where a run holds no letter.

        A run's Python objects live no longer than those of ``CHUNK`` runs or ``CHUNK_BYTES`` bytes.
        """
        crf, first = self.crf, self.used
        self.used += len(starts)
        if self.used > len(self.table):
            grown = np.zeros((max(self.used, 2 * len(self.table)), self.table.shape[1]), np.float32)
            grown[:first] = self.table[:first]
            self.table = grown
        low = 0
        while low < len(starts):
            size = np.cumsum(lengths[low : low + CHUNK])
            high = low + max(1, int(np.searchsorted(size, CHUNK_BYTES, side="right")))
            flat, counts = array("i"), []
            for a, n in zip(starts[low:high].tolist(), lengths[low:high].tolist()):
                before = len(flat)
                for w in letter_words(data[a : a + n].tobytes().decode("utf-8", "replace")):
                    flat.extend(features(w, crf.lexicon, len(crf.labels)))
                counts.append(len(flat) - before)
            out = self.table[first + low : first + high]
            out[:] = np.nan
            some = np.flatnonzero(counts)
            if len(some):
                column, ends = np.frombuffer(flat, np.int32), np.cumsum(counts)
                bounds = (ends - counts)[some]
                for y in range(len(crf.labels)):
                    out[some, y] = np.add.reduceat(crf.weights[column, y], bounds, dtype=np.float64)
            low = high
        return np.arange(first, self.used)

    def label(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of the letter words of a slice, the rows that they belong to, and how they switch."""
        crf, n_rows = self.crf, len(offsets) - 1
        starts, lengths, rows = words.spans(data, offsets, LETTER_BYTES)
        if len(self.keys) > REMEMBERED:
            self.forget()
        uniq, place, number = words.distinct(words.hashes(data, starts, lengths))
        at = np.searchsorted(self.keys, uniq)
        have = at < len(self.keys)
        have[have] = self.keys[at[have]] == uniq[have]
        new = np.flatnonzero(~have)
        rows_new = self.add(data, starts[place[new]], lengths[place[new]])
        row = np.empty(len(uniq), np.int64)
        row[have], row[new] = self.rows[at[have]], rows_new
        self.keys, self.rows = np.insert(self.keys, at[new], uniq[new]), np.insert(self.rows, at[new], rows_new)
        emit = self.table[row[number]].astype(np.float64)
        keep = ~np.isnan(emit[:, 0])
        emit, rows = emit[keep], rows[keep]
        first = np.ones(len(rows), dtype=bool)
        first[1:] = rows[1:] != rows[:-1]
        p = forward_backward(emit, first, crf.moves, crf.starts)
        total = np.stack([np.bincount(rows, weights=p[:, y], minlength=n_rows) for y in range(p.shape[1])], axis=1)
        best = p.argmax(axis=1)
        change = np.flatnonzero(~first[1:] & (best[1:] != best[:-1])) + 1
        return total, np.bincount(rows, minlength=n_rows), np.bincount(rows[change], minlength=n_rows)


def _predictor(crf: Crf):
    """A function of a slice of texts that gives best labels (0: unknown), scores, words and switches."""
    token = f"{id(crf)} {np.random.default_rng().integers(2**62)}"

    def run(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        best, score, count, moves = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        if crf.weights is not None:
            store = worker_store("language")
            if store.get("crf", (None,))[0] != token:
                store["crf"] = (token, _Worker(crf))
            total, count, moves = store["crf"][1].label(data, offsets)
            some = count > 0
            best[some] = total[some].argmax(axis=1) + 1
            score[some] = np.minimum(1.0, total[some].max(axis=1) / count[some])
        return best, score, count, moves

    return run


def predict(docs: DataFrame, crf: Crf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, n_letter_words, n_switches`` of every whole text."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("n_letter_words", T.LongType()), T.StructField("n_switches", T.LongType()),
    ])
    label, names = _predictor(crf), [UNKNOWN, *crf.labels]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.buffers(batch.column(2))
            for low, high in words.slices(offsets, SLICE_BYTES):
                best, score, count, moves = label(data[offsets[low] : offsets[high]], offsets[low : high + 1])
                columns = [*(c.slice(low, high - low) for c in batch.columns[:2]), pa.array([names[i] for i in best], pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score), pa.array(count), pa.array(moves)], names=schema.names)

    return map_batches(docs.select(F.col(doc_id), held_out(doc_id).alias("held_out"), F.col(text)), run, schema)


def keep_languages(docs: DataFrame, crf: Crf, least_score: float = 0.5, text: str = "text") -> DataFrame:
    """The documents, with all their columns, whose language is known with a score of at least ``least_score``."""
    at_text, label = docs.columns.index(text), _predictor(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.buffers(batch.column(at_text))
            for low, high in words.slices(offsets, SLICE_BYTES):
                best, score, _, _ = label(data[offsets[low] : offsets[high]], offsets[low : high + 1])
                yield batch.slice(low, high - low).filter(pa.array((best > 0) & (score >= least_score)))

    return map_batches(docs, run, docs.schema)
