"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def words(text: str | None) -> list[str]:
    return _WORD.findall(text or "")


def shingles(text: str | None, n: int = 4) -> frozenset:
    w = words((text or "").translate(_LOWER))
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def components(rows: list[tuple], n: int = 4, percent: int = 85) -> list[tuple]:
    """``id, size, component`` of every row."""
    sets = [shingles(r[1], n) if r[0] is not None else frozenset() for r in rows]
    parent = list(range(len(rows)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    seen: dict = {}
    for i, own in enumerate(sets):
        for j in range(i):
            common = len(own & sets[j])
            if common and 100 * common >= percent * (len(own) + len(sets[j]) - common):
                parent[top(i)] = top(j)
    for i, r in enumerate(rows):
        if r[0] is not None and r[0] in seen:
            parent[top(i)] = top(seen[r[0]])
        seen[r[0]] = i
    least: dict[int, int] = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return [(r[0], len(shingles(r[1], n)), least[top(i)] if r[0] is not None else None) for i, r in enumerate(rows)]


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if _WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def fixed_secrets(text: str | None) -> list[tuple[int, int, int]]:
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def targets(sizes: dict, weights=(5.0, 2.0, 1.0), share: float = 1.5, most: int = 2) -> dict:
    """Water filling: hand out the budget by weight until nobody is above the limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, budget = set(), share * sum(sizes.values())
    while True:
        rest = budget - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        level = rest / total if total else 0
        above = {s for s in names if s not in full and level * weight[s] >= most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in names}
        full |= above


def mix(rows: list[tuple], seed: int = 7) -> list[tuple]:
    """``id, source, size, source size, target, taken`` of every row."""
    sized = [(r[0], r[3], len(words(r[1]))) for r in rows]
    sizes: dict = defaultdict(int)
    for _, source, size in sized:
        sizes[source] += size
    goal = targets(sizes)
    low = lambda v: (v is not None, v if v is not None else 0)
    name = lambda v: (v is not None, v or "")
    copies = []
    for source in sizes:
        key = lambda i: hashlib.md5((f"{sized[i][0]}:{seed}" if sized[i][0] is not None else str(seed)).encode()).hexdigest()
        queue = sorted((i for i, r in enumerate(sized) if r[1] == source and r[2]), key=lambda i: (key(i), low(sized[i][0]), sized[i][2]))
        end = 0
        for i in queue:
            end += sized[i][2]
            copies += [((end + k * sizes[source]) / goal[source], name(source), end, low(sized[i][0]), i) for k in range(2)]
    taken, total, budget = Counter(), 0, int(1.5 * sum(sizes.values()))
    for *_, i in sorted(copies):
        total += sized[i][2]
        if total <= budget:
            taken[i] += sized[i][2]
    return [(i, s, z, sizes[s], goal[s], taken[k]) for k, (i, s, z) in enumerate(sized)]
