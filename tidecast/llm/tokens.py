"""Token ids of whole texts with the tokenizers library.

A text is cut at places where the tokenizer's own word pattern always cuts, so each piece may be
encoded by itself and its ids may be remembered. Every piece not seen before goes through the library;
texts with white space outside ASCII or with the strings of special tokens go through it whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
from tokenizers import Tokenizer

from tidecast.llm import words
from tidecast.llm.staging import worker_store

#: Pieces remembered at once, and the longest piece that is remembered, in bytes.
REMEMBERED, LONGEST = 1_200_000, 48
#: For a vocabulary that tells spaces and letter cases apart, so that pieces are more.
MORE = 2_500_000
#: Parts of pieces remembered at once.
PARTS = 150_000
MORE_PARTS = 300_000
SLICE_BYTES = 2_000_000

_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_LOWER_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_BYTE_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^A-Za-z0-9 ]+")


class Encoder:
    """Encodes slices of a text column.

    ``keep_space`` tells byte-level vocabularies, where white space has ids, from vocabularies that
    drop white space and letter case. ``remembered`` replaces the usual number of pieces that are kept;
    parts of pieces are kept in proportion.
    """

    def __init__(self, path: str, remembered: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = tok = Tokenizer.from_file(path)
        self.keep_space = tok.normalizer is None
        self.normalizer, self.splitter, self.model = tok.normalizer, tok.pre_tokenizer, tok.model
        added = tok.get_added_tokens_decoder().values()
        self.special = re.compile(b"|".join(re.escape(t.content.encode()) for t in added) or b"(?!)")
        usual = MORE if self.keep_space else REMEMBERED
        self.most = usual if remembered is None else remembered
        self.most_parts = (MORE_PARTS if self.keep_space else PARTS) * self.most // usual
        self.parts: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _split(self, pieces: list[str]) -> list[list[str]]:
        """Pieces as the parts that the vocabulary's merges work on."""
        plain = [p.isascii() and p.isprintable() and not p.isspace() for p in pieces]
        if self.keep_space:
            out = [_BYTE_ASCII.findall(p) if ok else None for p, ok in zip(pieces, plain)]
            out = [x and [p.replace(" ", "Ġ") for p in x] for x in out]
        else:
            out = [_LOWER_ASCII.findall(p.lower()) if ok else None for p, ok in zip(pieces, plain)]
        rest = [i for i, ok in enumerate(plain) if not ok]
        joint = [i for i in rest if not pieces[i].isspace()]
        cut = self._split_joined([pieces[i] for i in joint]) if joint else {}
        for i in rest:
            out[i] = []
        if cut is None:
            joint, cut = [], {}
        for k, i in enumerate(joint):
            out[i] = cut.get(k, [])
        for i in set(rest) - set(joint):
            text = pieces[i] if self.keep_space else self.normalizer.normalize_str(pieces[i])
            out[i] = [p for p, _ in self.splitter.pre_tokenize_str(text)]
        return out

    def _split_joined(self, pieces: list[str]) -> dict[int, list[str]] | None:
        """The library's own parts of many pieces in one call; None if a piece holds white space itself."""
        between = "\n" if self.keep_space else " "
        text = between.join(pieces)
        if not self.keep_space:
            text = self.normalizer.normalize_str(text)
            pieces, expected = text.split(" "), len(pieces)
            if len(pieces) != expected:
                return None
        elif any(between in p for p in pieces):
            return None
        ends = np.cumsum([len(p) + 1 for p in pieces])
        parts = self.splitter.pre_tokenize_str(text)
        owner = np.searchsorted(ends, [span[0] for _, span in parts], side="right").tolist()
        gaps = set((ends - 1).tolist())
        out: dict[int, list[str]] = {}
        for k, (part, span) in zip(owner, parts):
            if span[0] not in gaps:
                out.setdefault(k, []).append(part)
        return out

    def _encode(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        """Ids of short pieces without outer context, one after the other, and how many each has."""
        if len(self.parts) > self.most_parts:
            self.parts.clear()
        seen, flat, counts = self.parts, [], []
        for parts in self._split(pieces):
            before = len(flat)
            for part in parts:
                ids = seen.get(part)
                if ids is None:
                    ids = seen[part] = [t.id for t in self.model.tokenize(part)]
                flat += ids
            counts.append(len(flat) - before)
        return flat, counts

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, length and row of every piece."""
        base = offsets - offsets[0]
        raw = data.tobytes()
        whole = set()
        for pattern in (_WIDE_SPACE, self.special) if self.keep_space else (self.special,):
            whole |= {int(np.searchsorted(base, m.start(), side="right")) - 1 for m in pattern.finditer(raw)}
        starts, lengths, rows = words.spans(data, offsets)
        if self.keep_space:
            mark = np.zeros(len(data) + 1, dtype=bool)
            first = starts == base[rows]
            prev = np.where(first, 0, data[starts - 1]) if len(starts) else starts
            joins = prev == 32
            mark[starts - joins] = True
            mark[starts + lengths] = True
            gap_from = np.zeros(len(starts), np.int64)
            if len(starts):
                gap_from[1:] = (starts + lengths)[:-1]
                gap_from = np.maximum(gap_from, base[rows])
            mark[(starts - 1)[~joins & ~first & (starts - gap_from > 1)]] = True
            mark[base] = True
            edges = np.flatnonzero(mark)
            starts, lengths = edges[:-1], np.diff(edges)
            rows = np.searchsorted(base, starts, side="right") - 1
        if whole:
            odd = np.array(sorted(whole))
            keep = ~np.isin(rows, odd)
            starts = np.concatenate([starts[keep], base[odd]])
            lengths = np.concatenate([lengths[keep], base[odd + 1] - base[odd]])
            rows = np.concatenate([rows[keep], odd])
            order = np.argsort(starts, kind="stable")
            starts, lengths, rows = starts[order], lengths[order], rows[order]
            self.whole = odd
        else:
            self.whole = np.zeros(0, np.int64)
        return starts, lengths, rows

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int | None = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, each with ``end`` behind it, and the offsets of the rows."""
        if len(self.keys) > self.most:
            self._forget()
        n_rows = len(offsets) - 1
        starts, lengths, rows = self._cuts(data, offsets)
        uniq, place, number = words.distinct(words.hashes(data, starts, lengths))
        at = np.searchsorted(self.keys, uniq)
        have = at < len(self.keys)
        have[have] = self.keys[at[have]] == uniq[have]
        numbers = np.empty(len(uniq), np.int64)
        numbers[have] = self.numbers[at[have]]
        new = np.flatnonzero(~have)
        low, size = starts[place[new]], lengths[place[new]]
        alone = (size > LONGEST) | np.isin(rows[place[new]], self.whole)
        text = [data[i : i + n].tobytes().decode("utf-8", "replace") for i, n in zip(low.tolist(), size.tolist())]
        flat, counts = self._encode([t for t, x in zip(text, alone) if not x])
        n_short = len(counts)
        for t, x in zip(text, alone):
            if x:
                ids = self.tokenizer.encode(t, add_special_tokens=False).ids
                flat += ids
                counts.append(len(ids))
        closing = [] if end is None else [end]
        flat, counts = flat + closing, counts + [len(closing)]
        first = len(self.begin)
        numbers[new[~alone]] = first + np.arange(n_short)
        numbers[new[alone]] = first + n_short + np.arange(len(counts) - 1 - n_short)
        sizes = np.array(counts, np.int64)
        begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(sizes) - sizes])
        count = np.concatenate([self.count, sizes])
        pool = np.concatenate([self.pool, np.array(flat, np.uint32)])
        short = new[~alone]
        self.keys = np.insert(self.keys, at[short], uniq[short])
        self.numbers = np.insert(self.numbers, at[short], numbers[short])
        keep = first + n_short
        self.begin, self.count = begin[:keep], count[:keep]
        self.pool = pool[: len(self.pool) + int(sizes[:n_short].sum())]

        pieces = numbers[number]
        ends = np.cumsum(np.bincount(rows, minlength=n_rows))
        pieces = np.insert(pieces, ends, first + len(counts) - 1)
        sizes = count[pieces]
        total = np.cumsum(sizes)
        ids = pool[np.arange(int(total[-1]) if len(total) else 0) + np.repeat(begin[pieces] - (total - sizes), sizes)]
        bounds = np.zeros(n_rows + 1, np.int64)
        bounds[1:] = total[ends + np.arange(n_rows)] if n_rows else 0
        return ids, bounds


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    store = worker_store("tokens")
    key = f"encoder {path} {remembered}"
    if key not in store:
        store[key] = Encoder(path, remembered)
    return store[key]
