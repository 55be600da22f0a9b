"""Secrets in whole texts: fixed patterns, and tokens that pass a battery of randomness tests.

Candidates are maximal runs of 20 or more of ``[A-Za-z0-9+/_-]``, and their parts of 20 or more between
separators (``+/``, ``_-`` or all four), that have a letter and one kind of separators at most. The
encoding is the smallest that has all characters (hexadecimal, base 32, 36, 62, letters of one case or
both, each with separators if there are any); runs of digits alone are numbers. Three tests ask whether a run is consistent with random characters
of that encoding: chi-squared uniformity over the alphabet, runs above and below its middle, and lag-one
serial correlation; the smallest of the three p-values counts three times. Ordinary text is the null
hypothesis to reject: under a character-pair model counted over all documents, the likelihood ratio of
random against ordinary is a number that ordinary runs exceed ``1 / p`` with a chance of at most ``p``.
Ordinary is an even mixture of running text, text in capitals, and either as words joined by separators.
Such bounds shrink with the length, so false discoveries are controlled in classes of length, by the
Benjamini-Hochberg rule over all candidates of the corpus. A candidate is reported if the tests pass, the
rule rejects ordinary text, and neither a fixed pattern nor a longer reported one covers part of it.

Null text is empty and has no secrets. Positions are code points, ends exclusive. Repeated rows are
scanned each. An empty table gives no rows. Columns other than the id and the text are kept by
:func:`redact` and not read by :func:`scan`.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm import words
from tidecast.llm.staging import map_batches, stage

SLICE_BYTES = 500_000
KINDS = ("assign", "access", "hex", "random")
LEAST = 20
#: Smallest combined p-value of the battery, and the share of false discoveries.
ALPHA, SHARE = 0.001, 0.01
#: First lengths of the classes in which false discoveries are counted.
LENGTHS = (20, 32, 64)
#: Bins per power of ten, and how many powers are told apart.
BINS, POWERS = 10, 60

_ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_DIGITS, _LOWERS, _UPPERS = b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = _UPPERS + _LOWERS + _DIGITS + b"+/_-"
_OTHER = len(_SYMBOLS)
_PARTS = [re.compile(rb"[A-Za-z0-9%s]{%d,}" % (x, LEAST)) for x in (b"_-", b"+/", b"")]
#: Mean length of words that separators join.
JOINED = 8


def _tables() -> tuple[np.ndarray, np.ndarray]:
    code = np.full(256, _OTHER, np.int64)
    code[list(_SYMBOLS)] = np.arange(_OTHER)
    return code, code < _OTHER


CODE, TOKEN = _tables()


def _sign(values: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table


ASSIGNING = _sign(b":=")


def alphabet(token: bytes) -> bytes | None:
    """The alphabet of the encoding that a token suggests; None if it looks like a word, number or path."""
    have = set(token)
    digit, lower, upper = (bool(have & set(x)) for x in (_DIGITS, _LOWERS, _UPPERS))
    if not digit or not (lower or upper):
        return None
    for own in (_DIGITS + b"abcdef", _DIGITS + b"ABCDEF", _UPPERS + b"234567", _DIGITS + _LOWERS, _DIGITS + _UPPERS, _UPPERS + _LOWERS + _DIGITS):
        if have <= set(own):
            return own
    for extra in (b"+/", b"-_"):
        if have <= set(own + extra) and lower and upper:
            return own + extra
    return None


def encoding(token: bytes) -> bytes | None:
    """:func:`alphabet`, or else that of letters alone or of one case with separators; None without letters."""
    own = alphabet(token)
    if own is not None:
        return own
    have = set(token)
    if not have & set(_LOWERS + _UPPERS):
        return None
    own = b"".join(x for x in (_UPPERS, _LOWERS, _DIGITS) if have & set(x))
    for extra in (b"", b"+/", b"-_"):
        if have <= set(own + extra):
            return own + extra
    return None


def candidates(run: bytes) -> list[tuple[int, int]]:
    """Spans of a run that are tested, the longest first: the run and its parts between separators."""
    found = {(0, len(run))} | {m.span() for part in _PARTS for m in part.finditer(run)}
    return sorted((x for x in found if encoding(run[x[0] : x[1]])), key=lambda x: (x[0] - x[1], x[0]))


def battery(token: bytes, own: bytes) -> float:
    """Combined p-value of the three randomness tests, for one token and its alphabet."""
    rank = np.zeros(256, np.int64)
    rank[list(own)] = np.arange(len(own))
    x = rank[np.frombuffer(token, np.uint8)]
    n, k = len(x), len(own)
    counts = np.bincount(x, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    p = [0.5 * math.erfc((chi - (k - 1)) / math.sqrt(4 * (k - 1) * (n - 1) / n))]
    high = x >= k // 2
    a = int(high.sum())
    b = n - a
    mean = 2 * a * b / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + int((high[1:] != high[:-1]).sum())
    p.append(math.erfc(abs(runs - mean) / math.sqrt(2 * spread)) if spread > 0 else 0.0)
    y = x - x.mean()
    power = float((y * y).sum())
    r = float((y[1:] * y[:-1]).sum()) / power if power else 1.0
    p.append(math.erfc(abs(r + 1 / n) * math.sqrt(n / 2)))
    return min(1.0, 3 * min(p))


@dataclass
class Model:
    """Log probabilities of character pairs in ordinary text, and the least bin reported of each length class."""

    pairs: np.ndarray
    least: tuple[int, ...]

    def bin(self, token: bytes, own: bytes) -> int:
        """How unlike ordinary text a token is, in tenths of powers of ten."""
        plain = [token] if re.search(b"[a-z]", token) else [token, token.lower()]
        ordinary = [x for t in plain for x in (self._running(t), self._joined(t))]
        most = max(ordinary)
        # Four parts of the mixture: running or joined, as it is or in capitals.
        ordinary = most + math.log(sum(math.exp(x - most) for x in ordinary) / 4)
        ratio = -len(token) * math.log(len(own)) - ordinary
        return int(min(max(ratio / math.log(10), 0), POWERS) * BINS)

    def _running(self, token: bytes) -> float:
        code = np.append(_OTHER, CODE[np.frombuffer(token, np.uint8)])
        return float(self.pairs[code[:-1], code[1:]].sum())

    def _joined(self, token: bytes) -> float:
        """Words of a mean length of ``JOINED``, each as after a space, with one of four separators between."""
        cut = re.split(rb"[+/_-]", token)
        letters, cuts = sum(map(len, cut)), len(cut) - 1
        return sum(map(self._running, cut)) + letters * math.log(1 - 1 / JOINED) - cuts * math.log(4 * JOINED)

    def is_secret(self, token: bytes) -> bool:
        own = encoding(token)
        if own is None:
            return False
        least = self.least[length_class(len(token))]
        return self.bin(token, own) >= least and battery(token, own) >= ALPHA


def length_class(n: int) -> int:
    return sum(n >= low for low in LENGTHS) - 1


def _long_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, lengths, rows = words.spans(data, offsets, TOKEN)
    keep = lengths >= LEAST
    return starts[keep], lengths[keep], rows[keep]


def pair_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each pair of characters is in the texts, ``SLICE_BYTES`` of them at a time; none across two texts."""
    size = (_OTHER + 1) ** 2
    total = np.zeros(size, np.int64)
    edge = (offsets - offsets[0])[1:-1]
    edge = np.unique(edge[(edge > 0) & (edge < len(data))]) - 1
    for low in range(0, len(data) - 1, SLICE_BYTES):
        code = CODE[data[low : low + SLICE_BYTES + 1]]
        pair = code[:-1] * (_OTHER + 1) + code[1:]
        cut = edge[slice(*np.searchsorted(edge, [low, low + len(pair)]))] - low
        total += np.bincount(pair, minlength=size) - np.bincount(pair[cut], minlength=size)
    return total


def _characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of the texts, and at the end one row of pair counts."""
    total = np.zeros((_OTHER + 1) ** 2, np.int64)
    schema = pa.schema([("counts", pa.list_(pa.int64())), ("token", pa.binary())])
    for batch in batches:
        data, offsets = words.buffers(batch.column(0))
        for low, high in words.slices(offsets, SLICE_BYTES):
            part, at = data[offsets[low] : offsets[high]], offsets[low : high + 1]
            if not len(part):
                continue
            total += pair_counts(part, at)
            starts, lengths, _ = _long_runs(part, at)
            tokens = [part[a : a + n].tobytes() for a, n in zip(starts.tolist(), lengths.tolist())]
            tokens = [t[x:y] for t in tokens for x, y in candidates(t)]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(tokens), schema.types[0]), pa.array(tokens, pa.binary())], schema=schema)
    yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], schema.types[0]), pa.nulls(1, pa.binary())], schema=schema)


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Character pairs and false-discovery thresholds of a corpus, counted over all its texts."""

    seen = stage(map_batches(docs.select(F.col(text)), _characters, "counts array<bigint>, token binary"), "characters")
    rows = seen.where("counts is not null").select(F.posexplode("counts").alias("pair", "n")).groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.ones((_OTHER + 1) ** 2)
    counts[[r.pair for r in rows]] += [r.n for r in rows]
    counts = counts.reshape(_OTHER + 1, _OTHER + 1)
    model = Model(np.log(counts / counts.sum(axis=1, keepdims=True)), ())

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            kinds = [length_class(len(t)) for t in tokens]
            bins = [model.bin(t, encoding(t)) for t in tokens]
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(bins, pa.int32())], names=["kind", "bin"])

    found = map_batches(seen.where("token is not null").select("token"), binned, "kind int, bin int")
    table = np.zeros((len(LENGTHS), POWERS * BINS + 1))
    for r in found.groupBy("kind", "bin").agg(F.count("*").alias("n")).collect():
        table[r.kind, r.bin] = r.n
    return Model(model.pairs, tuple(least_bin(row) for row in table))


def least_bin(counts: np.ndarray) -> int:
    """Benjamini-Hochberg on binned p-values: the least bin whose tail holds few enough false discoveries."""
    tail = np.cumsum(counts[::-1])[::-1]
    bound = 10.0 ** (-np.arange(len(counts)) / BINS)
    ok = (bound * counts.sum() <= SHARE * tail) & (tail > 0)
    return int(np.argmax(ok)) if ok.any() else len(counts)


def _spans(data: np.ndarray, offsets: np.ndarray, model: Model | None) -> dict[int, list[tuple[int, int, int]]]:
    """Byte spans ``(start, kind, end)`` within the texts, by row, in order."""
    base = offsets - offsets[0]
    out: dict[int, list[tuple[int, int, int]]] = {}
    raw = data.tobytes()
    for row in np.unique(np.searchsorted(base, np.flatnonzero(ASSIGNING[data]), side="right") - 1).tolist():
        low = int(base[row])
        for m in _ASSIGN.finditer(raw[low : int(base[row + 1])]):
            if len(m[1]) >= 6:
                out.setdefault(row, []).append((m.start(), 0, m.end()))
    starts, lengths, rows = _long_runs(data, offsets)
    runs = list(zip(starts.tolist(), lengths.tolist(), rows.tolist(), (starts - base[rows]).tolist()))
    for start, n, row, at in runs:
        token = raw[start : start + n]
        for kind, pattern, least in ((1, _ACCESS, 20), (2, _HEX, 24)):
            for m in pattern.finditer(token):
                if m.end() - m.start() >= least:
                    out.setdefault(row, []).append((at + m.start(), kind, at + m.end()))
    if model is not None:
        for start, n, row, at in runs:
            token = raw[start : start + n]
            for x, y in candidates(token):
                if all(b <= at + x or a >= at + y for a, _, b in out.get(row, ())) and model.is_secret(token[x:y]):
                    out.setdefault(row, []).append((at + x, 3, at + y))
    return {row: sorted(found) for row, found in out.items()}


def _points(text: np.ndarray, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans in code points."""
    before = np.append(0, np.cumsum((text & 0xC0) != 0x80))
    return [(int(before[a]), kind, int(before[b])) for a, kind, b in found]


def scan(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, found`` of every document; ``found`` lists ``kind, start, end`` by start, then kind."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType),
        T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()),
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    ])

    def joined(found: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
        for batch in batches:
            data, offsets = words.buffers(batch.column(1))
            for low, high in words.slices(offsets, SLICE_BYTES):
                part, at = data[offsets[low] : offsets[high]], offsets[low : high + 1]
                rows = [nothing] * (high - low)
                for row, found in _spans(part, at, model).items():
                    found = _points(part[at[row] - at[0] : at[row + 1] - at[0]], found)
                    fixed = [x for x in found if x[1] < 3]
                    count = [sum(x[1] == k for x in fixed) for k in range(3)]
                    rows[row] = (*count, hashlib.sha256(joined(fixed).encode()).hexdigest(), joined(found))
                columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()] * 2)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *columns], names=schema.names)

    return map_batches(docs.select(F.col(doc_id), F.col(text)), run, schema)


def redact(docs: DataFrame, model: Model | None, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same documents and columns with every secret replaced by ``mark``; overlapping spans become one."""
    at_text = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at_text)
            data, offsets = words.buffers(column)
            clean: dict[int, bytes] = {}
            for low, high in words.slices(offsets, SLICE_BYTES):
                part, at = data[offsets[low] : offsets[high]], offsets[low : high + 1]
                for row, found in _spans(part, at, model).items():
                    raw, out, place = part[at[row] - at[0] : at[row + 1] - at[0]].tobytes(), [], 0
                    for a, _, b in found:
                        if a >= place:
                            out += [raw[place:a], mark.encode()]
                        place = max(place, b)
                    clean[low + row] = b"".join([*out, raw[place:]])
            if clean:
                values = column.to_pylist()
                for row, value in clean.items():
                    values[row] = value.decode("utf-8", "replace")
                column = pa.array(values, column.type)
            columns = [column if i == at_text else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_batches(docs, run, docs.schema)
