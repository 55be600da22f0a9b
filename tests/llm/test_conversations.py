from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import pytest

from tidecast.llm import conversations

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
SPACE = " \t\n\x0b\x0c\r"


def best(turns: list[tuple[str, str]], faults: list[str]) -> tuple[int, str, tuple[str, ...]]:
    """Cheapest edits with the least audit, turn by turn over the four states."""
    fits = {0: "user", 1: "user", 2: "assistant", 3: "user"}

    def better(into, state, way):
        if state not in into or way < into[state]:
            into[state] = way

    def put_in(ways):
        out = dict(ways)
        for _ in range(3):
            for state, (c, a, r) in list(out.items()):
                better(out, 3 if state == 2 else 2, (c + 3, a + "I", (*r, fits[state] + ":")))
        return out

    ways = {0: (0, "", ())}
    for (role, text), fault in zip(turns, faults):
        new = {}
        for state, (c, a, r) in put_in(ways).items():
            better(new, state, (c + 4, a + "D", r))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            better(new, 3 if state == 2 else 2, (c + 3 + more, a + "R", (*r, f"{fits[state]}:{text}")))
            if (state, role[:1]) in NEXT:
                better(new, NEXT[state, role[:1]], (c + more, a + "K", (*r, f"{role}:{text}")))
        ways = new
    return min(w for state, w in put_in(ways).items() if state in (0, 3))


def plain(rows: list[tuple], damaged: bool = True) -> dict:
    out = {}
    for conv in {r[0] for r in rows}:
        turns = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0)):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            turns += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        faults, seen = [], set()
        for _, role, text in turns:
            end = text.rstrip(SPACE)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
        numbers = [t for t, _, _ in turns if t is not None]
        legal = {("s", "u"), ("u", "a"), ("a", "u")}
        said = [(r, x) for _, r, x in turns]
        cost, audit, kept = best(said, faults)
        out[conv] = {
            "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
            "illegal": sum((a[:1], b[:1]) not in legal for (a, _), (b, _) in itertools.pairwise(said)),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest(),
        }
    return out


def turns(n: int = 60, seed: int = 5) -> list[tuple]:
    rnd = random.Random(seed)
    rows: list[tuple] = []
    for conv in range(n):
        for turn in range(rnd.choice([1, 2, 4, 7, 30])):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rnd.choice(["Yes.", "Go on!", "é ß 日本 😀?", "cut off", " \n\t", "", None, f"word {turn}."])
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += [rows[0], rows[0], (None, 1, "user", "Hi."), (None, None, None, None), (n + 1, 0, "user", "long " * 30_000 + ".")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, n long, rows string, key int, cost string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 3, "x", 4, "y") for r in rows], SCHEMA).repartition(4)


def found(spark, rows, **sizes):
    out = conversations.digests(conversations.repair(conversations.damage(frame(spark, rows)), **sizes)).collect()
    assert len(out) == len({r[0] for r in rows})
    return {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in out}


def test_repairs_equal_the_plain_version(spark):
    rows = turns()
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("segment", [1, 3, 512])
def test_long_conversations_by_segments(spark, monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    rows = turns(30, seed=8) + [(1000, i, random.Random(i).choice(["user", "assistant"]), f"said {i % 9}{'.' * (i % 4 > 0)}") for i in range(400)]
    assert found(spark, rows, long_rows=3) == plain(rows)


def test_long_texts_make_a_conversation_long(spark):
    rows = turns(6, seed=2)
    assert found(spark, rows, long_bytes=10) == plain(rows)


def test_search_of_all_short_patterns():
    role = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for n in range(1, 5):
        for letters in itertools.product("suoAX", repeat=n):
            faults = ["duplicate" if c == "X" else "truncated" if c.isupper() else "" for c in letters]
            cost, audit, _ = best([(role.get(c.lower(), "user"), str(i)) for i, c in enumerate(letters)], faults)
            assert conversations.solve("".join(letters))[:2] == (cost, audit)


def test_empty_table_gives_no_rows(spark):
    empty = conversations.repair(conversations.damage(frame(spark, []).limit(0)))
    assert conversations.digests(empty).collect() == []
