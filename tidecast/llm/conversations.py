"""Repair of conversation structure: the cheapest edits that leave well-formed turns.

After repair the initials of the roles must read ``(s?(ua)+)?``: an optional system turn, then pairs of
user and assistant, or nothing. A turn is kept (0), gets the role that fits (3) or is deleted (4); an empty
turn of either role may be put in anywhere (3); a truncated turn that stays adds 3. Blank and repeated
turns must go. The edits of a conversation are the edges of a lattice of (turns read, state of the
pattern). A bidirectional Dijkstra search solves it: one heap grows from the start, one from the accepted
ends, and when they have met, the search goes on until no crossing of equal cost is left; of those, the
least audit (the edits' initials in order) wins.

* Conversations of up to ``long_rows`` turns (and ``long_bytes`` of text) are one row each. Their turns
  become one letter each by SQL functions, and only these letters reach Python.
* Longer ones are cut into segments. A segment is solved for each pair of states at its rims. Edits before
  a turn belong to it, so audits of one segment end in the edit of its last turn, none is a proper prefix
  of another, and two chains of segments compare like the places of their parts in each segment's order.
  Segments are therefore joined by costs and places alone, first inside a partition, then over partitions.
  Equal turns are summed before they are sorted; copies can only be deleted, which every choice shares.

Turns are ordered by turn (nulls first), then role, then text. Null roles and texts are one space. A role that is empty has
no initial and cannot be kept. A null conversation id is a conversation. An empty table gives no rows.
Repeated rows are repeated turns. Columns other than the four named are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.staging import map_batches, small, stage, worker_store

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States of the pattern: nothing yet, after the system turn, after a user's, after an assistant's.
STATES = (0, 1, 2, 3)
ACCEPTED = (0, 3)
#: The state after the turn that fits, which is a user's but after a user's turn.
FIT = (2, 2, 3, 2)
#: States in which a turn of this initial may be kept.
KEPT_IN = {"s": (0,), "u": (0, 1, 3), "a": (2,)}
SPACES = " \t\n\x0b\x0c\r"
SEGMENT = 512
BROADCAST_ROWS = 100_000

REMEMBERED = 50_000
SOLVED = "cost long, audit string, places array<int>, roles array<string>"


def _turn_edges(turn: str) -> list[list[tuple[int, int, str]]]:
    """For each state: the edits of a turn as (state after, cost, initial)."""
    extra = TRUNCATED if turn.isupper() else 0
    out = []
    for state in STATES:
        edits = [(state, DELETE, "D")]
        if turn != "X":
            edits.append((FIT[state], REROLE + extra, "R"))
            if state in KEPT_IN.get(turn.lower(), ()):
                edits.append((1 if turn in "sS" else FIT[state], KEEP + extra, "K"))
        out.append(edits)
    return out


def _reversed(edges: list[list[tuple[int, int, str]]]) -> list[list[tuple[int, int, str]]]:
    return [[(a, cost, initial) for a in STATES for to, cost, initial in edges[a] if to == b] for b in STATES]


#: Edges of the lattice by side of the search, letter and state.
TURN = tuple({turn: fn(_turn_edges(turn)) for turn in "suaoSUAOX"} for fn in (list, _reversed))
PUT_IN = tuple(fn([[(FIT[state], INSERT, "I")] for state in STATES]) for fn in (list, _reversed))


def _steps(side: int, letters: str, i: int, state: int, trailing: bool) -> Iterator[tuple[int, int, int, str]]:
    """Edits from a node (side 0) or to it (side 1): the other node, the cost, the initial."""
    if trailing or i < len(letters):
        for to, cost, initial in PUT_IN[side][state]:
            yield i, to, cost, initial
    if side == 0 and i < len(letters):
        for to, cost, initial in TURN[0][letters[i]][state]:
            yield i + 1, to, cost, initial
    if side == 1 and i > 0:
        for to, cost, initial in TURN[1][letters[i - 1]][state]:
            yield i - 1, to, cost, initial


def search(letters: str, sources: tuple[int, ...], targets: tuple[int, ...], trailing: bool) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest way from the source states through all letters to the target states.

    Labels are (cost, audit); edits of cost 0 only go from one turn to the next, so nodes of equal cost are
    settled turn by turn and every label is final when its node is settled. A way of least cost has an edge
    from a node settled forward to one settled backward as soon as both heaps' tops add up to more.
    """
    n = len(letters)
    label = ({(0, s): (0, "") for s in sources}, {(n, s): (0, "") for s in targets})
    heap = ([(0, 0, node) for node in label[0]], [(0, 0, node) for node in label[1]])
    done: tuple[set, set] = (set(), set())
    best: tuple[int, str] | None = None
    while heap[0] or heap[1]:
        tops = [h[0][0] if h else 0 for h in heap]
        if best is not None and sum(tops) > best[0]:
            break
        side = 0 if heap[0] and (not heap[1] or tops[0] <= tops[1]) else 1
        cost, _, node = heapq.heappop(heap[side])
        if node in done[side]:
            continue
        done[side].add(node)
        audit = label[side][node][1]
        for i, state, price, initial in _steps(side, letters, *node, trailing):
            to = (i, state)
            if to in done[1 - side]:
                far, rest = label[1 - side][to]
                whole = (cost + price + far, audit + initial + rest if side == 0 else rest + initial + audit)
                best = whole if best is None else min(best, whole)
            new = (cost + price, audit + initial if side == 0 else initial + audit)
            if to not in done[side] and (to not in label[side] or new < label[side][to]):
                label[side][to] = new
                heapq.heappush(heap[side], (new[0], i if side == 0 else n - i, to))
    return best


def solve(letters: str) -> tuple[int, str, tuple[int, ...], tuple[str, ...]]:
    """Cost and audit of a whole conversation, and its repaired turns: the place of each (-1: put in) and its new role ('': kept)."""
    if not letters:
        return 0, "", (), ()
    cost, audit = search(letters, (0,), ACCEPTED, True)
    return cost, audit, *follow(letters, audit, 0)[:2]


def follow(letters: str, audit: str, state: int) -> tuple[tuple[int, ...], tuple[str, ...], int]:
    """The turns that an audit leaves, their new roles, and the state it ends in."""
    places, roles, at = [], [], 0
    for edit in audit:
        if edit != "D":
            places.append(-1 if edit == "I" else at)
            roles.append("" if edit == "K" else ("assistant" if state == 2 else "user"))
            state = 1 if edit == "K" and letters[at] in "sS" else FIT[state]
        at += edit != "I"
    return tuple(places), tuple(roles), state


def solve_segment(letters: str) -> tuple[tuple[int, int, int, int, str], ...]:
    """(state before, state after, cost, place in the order of this segment's audits, audit) of every way through a segment."""
    ways = [(a, b, search(letters, (a,), (b,), False)) for a in STATES for b in STATES]
    ways = [(a, b, *found) for a, b, found in ways if found]
    order = {audit: k for k, audit in enumerate(sorted({w[3] for w in ways}))}
    return tuple((a, b, cost, order[audit], audit) for a, b, cost, audit in ways)


def chain(parts: list[list[tuple[int, int, int, int]]], starts: tuple[int, ...] = STATES) -> dict[tuple[int, int], tuple[int, int, list[tuple[int, int]]]]:
    """Join parts given as (before, after, cost, rank): for each start and end the cost, the rank among all and the states of every part."""
    found = {}
    for start in starts:
        ways: dict[int, tuple[int, int, tuple | None]] = {start: (0, 0, None)}
        for cells in parts:
            new: dict[int, tuple] = {}
            for before, after, cost, rank in cells:
                if before in ways:
                    c, r, trail = ways[before]
                    way = (c + cost, (r, rank), (trail, (before, after)))
                    if after not in new or way[:2] < new[after][:2]:
                        new[after] = way
            order = {r: k for k, r in enumerate(sorted({w[1] for w in new.values()}))}
            ways = {state: (c, order[r], trail) for state, (c, r, trail) in new.items()}
        for state, (c, r, trail) in ways.items():
            steps = []
            while trail is not None:
                trail, step = trail
                steps.append(step)
            found[start, state] = (c, r, steps[::-1])
    return found


#: What is put in behind the last turn: cost and audit by the state before.
ENDING = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}


def finish(parts: list[list[tuple[int, int, int, int]]]) -> tuple[int, list[tuple[int, int]], str]:
    """Cost, states of every part and what is put in at the end, of the best way from nothing to an accepted state."""
    ends = chain(parts, (0,))
    best = min((c + ENDING[state][0], r, ENDING[state][1], state) for (_, state), (c, r, _) in ends.items())
    return best[0], ends[0, best[3]][2], best[2]


def damage(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with planted faults, picked by a checksum of ids: ``conv_id, turn, role, text, n``.

    ``n`` is how often the turn stands there; 0 means that it was dropped.
    """
    conv, at = F.col(conv_id), F.col(turn)
    key = F.concat_ws(":", F.coalesce(conv.cast("string"), F.lit(" ")), F.coalesce(at.cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    said, spoke = F.coalesce(F.col(text), F.lit(" ")), F.coalesce(F.col(role), F.lit(" "))
    said = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said)
    return turns.select(
        conv.alias("conv_id"), at.alias("turn"), F.when(kind == 4, "user").otherwise(spoke).alias("role"), said.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("n"),
    )


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def _letter(role: Column, text: Column, gone: Column) -> Column:
    """The letter of a turn: X if it must go, else its role's initial (o: none that fits), in capitals if truncated."""
    first = F.substring(role, 1, 1)
    plain = F.when(first.isin("s", "u", "a"), first).otherwise("o")
    cut = ~F.substring(_trimmed(text), -1, 1).isin(".", "!", "?")
    return F.when(gone, "X").when(cut, F.upper(plain)).otherwise(plain)


def _legal(before: Column, after: Column) -> Column:
    return F.concat(F.substring(before, 1, 1), F.lit(" "), F.substring(after, 1, 1)).isin("s u", "u a", "a u")


@dataclass
class Repaired:
    """``conversations``: one row each with counts, cost and audit, and the ``repaired`` turns of those that are not long
    (array of role and text). ``long_turns``: repaired turns of the long ones, ``conv_id, part, seq, sub, role, text`` in that order;
    None if there is none."""

    conversations: DataFrame
    long_turns: DataFrame | None


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def repair(turns: DataFrame, long_rows: int = 512, long_bytes: int = 1 << 24) -> Repaired:
    """Repair all conversations of ``turns(conv_id, turn, role, text, n)``."""
    sizes = turns.groupBy("conv_id").agg(F.sum("n").alias("rows"), F.sum(F.octet_length("text") * F.col("n")).alias("bytes"))
    big = stage(sizes.where((F.col("rows") > long_rows) | (F.col("bytes") > long_bytes)).select("conv_id"), "long")
    if not small(big, 0):
        few = F.broadcast(big) if small(big, BROADCAST_ROWS) else big
        picked = few.withColumnRenamed("conv_id", "_conv")
        same = F.col("conv_id").eqNullSafe(F.col("_conv"))
        whole, long_turns = _repair_long(turns.join(picked, same, "left_semi"))
        rest = _repair_short(turns.join(picked, same, "left_anti"))
        return Repaired(rest.unionByName(whole), long_turns)
    return Repaired(_repair_short(turns), None)


def _remembered(name: str, fn: Callable, letters: pd.Series, most: int) -> list:
    """``fn`` of each conversation's letters; few patterns make up most conversations, so a worker keeps what it has solved."""
    known = worker_store("conversations").setdefault(name, {})
    if len(known) > most:
        known.clear()
    for x in set(letters) - known.keys():
        known[x] = fn(x)
    return [known[x] for x in letters]


def _repair_short(turns: DataFrame) -> DataFrame:
    @F.pandas_udf(SOLVED)
    def solved(letters: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_remembered("conversations", solve, letters, REMEMBERED), columns=["cost", "audit", "places", "roles"])

    one = F.struct("turn", "role", "text", "n")
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("n") > 0, one))).alias("rows"))
    rows = rows.withColumn("rows", F.flatten(F.transform("rows", lambda r: F.array_repeat(r, r["n"]))))
    rows = rows.withColumn("said", F.transform("rows", lambda r: F.struct(r["role"], r["text"])))
    blank = lambda r: _trimmed(r["text"]) == ""
    again = lambda r, i: F.array_position("said", F.struct(r["role"], r["text"])) <= i
    letters = F.transform("rows", lambda r, i: F.when(blank(r), "B").otherwise(_letter(r["role"], r["text"], again(r, i))))
    rows = rows.withColumn("letters", F.array_join(letters, ""))
    numbered = F.filter(F.transform("rows", lambda r: r["turn"]), lambda t: t.isNotNull())
    n_of = lambda of: F.length(F.regexp_replace("letters", f"[^{of}]", "")).cast("long")
    after = F.transform("rows", lambda r, i: F.struct(F.get("rows", i - 1)["role"].alias("before"), r["role"].alias("after")))
    wrong = F.filter(after, lambda p: p["before"].isNotNull() & ~_legal(p["before"], p["after"]))
    rows = rows.select(
        "conv_id", "rows",
        F.coalesce(F.array_max(numbered) - F.array_min(numbered) + 1 - F.size(F.array_distinct(numbered)), F.lit(0)).cast("long").alias("gaps"),
        n_of("B").alias("blank"), n_of("X").alias("duplicate"), n_of("SUAO").alias("truncated"), F.size(wrong).cast("long").alias("illegal"),
        solved(F.replace("letters", F.lit("B"), F.lit("X"))).alias("best"),
    )

    def turn(place: Column, i: Column) -> Column:
        kept = F.get("rows", place)
        role = F.get("best.roles", i)
        return F.struct(F.when(role == "", kept["role"]).otherwise(role).alias("role"), F.coalesce(kept["text"], F.lit("")).alias("text"))

    return rows.select("conv_id", *COUNTS, "best.cost", "best.audit", F.transform("best.places", turn).alias("repaired"))


def _order_long(turns: DataFrame) -> DataFrame:
    """Turns of long conversations, each with its place: ``part`` and ``seq`` ascend, ``n`` counts equal turns.

    Places come from a range sort; written once, they hold for all later steps.
    """
    rows = turns.where("n > 0").groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    rows = rows.withColumn("key", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    rows = rows.withColumn("at", F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn")))
    firsts = rows.groupBy("conv_id", "key").agg(F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1")
    firsts = firsts.select(F.col("conv_id").alias("_conv"), F.col("key").alias("_key"), "first")
    rows = rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key")), "left")
    blank = _trimmed(F.col("text")) == ""
    again = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    letter = _letter(F.col("role"), F.col("text"), blank | again)
    rows = rows.select("conv_id", "turn", "role", "text", "n", letter.alias("letter"), blank.alias("blank"))
    rows = rows.repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "turns")
    rows = rows.withColumn("part", F.shiftright("at", 33)).withColumn("seq", F.col("at").bitwiseAND((1 << 33) - 1))
    return rows.withColumn("segment", F.floor(F.col("seq") / SEGMENT))


def _long_counts(rows: DataFrame) -> DataFrame:
    """The counts of long conversations; pairs of neighbours meet by segments and the rims between them."""
    gone = F.col("letter") == "X"
    part = Window.partitionBy("conv_id", "part", "segment").orderBy("seq")
    before, known = F.lag("role").over(part), F.col("turn").isNotNull()
    bad = lambda a, b: (~_legal(a, b)).cast("long")
    rows = rows.withColumn("wrong", F.coalesce(bad(before, F.col("role")), F.lit(0)) + (F.col("n") - 1) * bad(F.col("role"), F.col("role")))
    rows = rows.withColumn("new", (known & ~F.lag("turn").over(part).eqNullSafe(F.col("turn"))).cast("long"))
    rim = lambda fn: fn(F.struct("seq", "role", "turn"))
    segments = rows.groupBy("conv_id", "part", "segment").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - 1 + gone.cast("int"))).alias("duplicate"),
        F.sum(F.col("letter").isin("S", "U", "A", "O").cast("long")).alias("truncated"),
        F.sum("wrong").alias("illegal"), F.min("turn").alias("low"), F.max("turn").alias("high"), F.sum("new").alias("values"),
        F.sum(4 * (F.col("n") - 1)).alias("copies"), rim(F.min).alias("head"), rim(F.max).alias("tail"),
    )
    # Rims inside a partition first; then one row for each partition.
    sums = ("blank", "duplicate", "truncated", "illegal", "values", "copies")
    for keys, order in ((["conv_id", "part"], "segment"), (["conv_id"], "part")):
        last = F.lag("tail").over(Window.partitionBy(*keys).orderBy(order))
        segments = segments.withColumn("last", last)
        joined = F.coalesce(bad(F.col("last.role"), F.col("head.role")), F.lit(0))
        same = (F.col("last.turn") == F.col("head.turn")).cast("long")
        segments = segments.withColumn("illegal", F.col("illegal") + joined).withColumn("values", F.col("values") - F.coalesce(same, F.lit(0)))
        ends = [F.min_by("head", order).alias("head"), F.max_by("tail", order).alias("tail")]
        segments = segments.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], F.min("low").alias("low"), F.max("high").alias("high"), *ends)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("values"), F.lit(0)).cast("long")
    return segments.select("conv_id", gaps.alias("gaps"), *sums[:4], "copies")


def _repair_long(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = _order_long(turns)
    kind = turns.schema["conv_id"].dataType.simpleString()
    segments = rows.groupBy("conv_id", "part", "segment").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "letter"))), lambda r: r["letter"]), "").alias("letters"))

    @F.pandas_udf("array<struct<came: int, left: int, cost: long, rank: int, audit: string>>")
    def ways(letters: pd.Series) -> pd.Series:
        names = ("came", "left", "cost", "rank", "audit")
        return pd.Series([[dict(zip(names, way)) for way in found] for found in _remembered("segments", solve_segment, letters, 1000)])

    solved = stage(segments.select("conv_id", "part", "segment", "letters", ways("letters").alias("cells")), "segments")
    numbers = solved.select("conv_id", "part", "segment", F.transform("cells", lambda c: F.struct(c["came"], c["left"], c["cost"], c["rank"])).alias("cells"))
    cells = "cells array<struct<came: int, left: int, cost: long, rank: int>>"

    def of(group: pd.DataFrame, by: str) -> list:
        group = group.sort_values(by)
        return [[(c["came"], c["left"], c["cost"], c["rank"]) for c in cells] for cells in group["cells"]]

    def join_part(group: pd.DataFrame) -> pd.DataFrame:
        found = chain(of(group, "segment"))
        values = [{"came": a, "left": b, "cost": c, "rank": r} for (a, b), (c, r, _) in found.items()]
        return pd.DataFrame({"conv_id": group["conv_id"].iloc[:1].tolist(), "part": group["part"].iloc[:1].tolist(), "cells": [values]})

    def join_conversation(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        cost, steps, ending = finish(of(group, "part"))
        last = [""] * (len(group) - 1) + [ending]
        return pd.DataFrame({"conv_id": group["conv_id"], "part": group["part"], "came": [a for a, _ in steps], "left": [b for _, b in steps], "cost": cost, "ending": last})

    def pick(key: tuple, group: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("segment")
        one = chosen.iloc[0]
        steps = chain(of(group, "segment"), (int(one["came"]),))[int(one["came"]), int(one["left"])][2]
        return pd.DataFrame({"conv_id": group["conv_id"], "part": group["part"], "segment": group["segment"], "came": [a for a, _ in steps], "left": [b for _, b in steps]})

    parts = numbers.groupBy("conv_id", "part").applyInPandas(join_part, f"conv_id {kind}, part long, {cells}")
    chosen = stage(parts.groupBy("conv_id").applyInPandas(join_conversation, f"conv_id {kind}, part long, came int, left int, cost long, ending string"), "chosen")
    steps = numbers.groupBy("conv_id", "part").cogroup(chosen.groupBy("conv_id", "part")).applyInPandas(pick, f"conv_id {kind}, part long, segment long, came int, left int")
    keys = F.col("s.part").eqNullSafe(F.col("t.part")) & (F.col("s.segment") == F.col("t.segment"))
    picked = solved.alias("s").join(steps.alias("t"), keys & F.col("s.conv_id").eqNullSafe(F.col("t.conv_id")))
    audit = F.filter("cells", lambda c: (c["came"] == F.col("t.came")) & (c["left"] == F.col("t.left")))[0]["audit"]
    picked = picked.select("s.conv_id", "s.part", "s.segment", "letters", F.col("t.came").alias("came"), audit.alias("audit"))

    @F.pandas_udf("array<struct<places: array<int>, roles: array<string>, audit: string>>")
    def by_turn(letters: pd.Series, audit: pd.Series, came: pd.Series) -> pd.Series:
        return pd.Series([_split(x, a, s) for x, a, s in zip(letters, audit, came)])

    picked = picked.select("conv_id", "part", "segment", F.posexplode(by_turn("letters", "audit", "came")).alias("nth", "edit"))
    # A turn's place in its segment; the first segment of a conversation in a partition may begin inside.
    first = rows.groupBy("conv_id", "part", "segment").agg(F.min("seq").alias("first"))
    edits = picked.alias("p").join(first.alias("f"), (F.col("p.part") == F.col("f.part")) & (F.col("p.segment") == F.col("f.segment")) & F.col("p.conv_id").eqNullSafe(F.col("f.conv_id")))
    edits = edits.select("p.part", (F.col("first") + F.col("nth")).alias("seq"), "edit")
    done = stage(rows.join(edits, ["part", "seq"]).select("conv_id", "part", "seq", "segment", "role", "text", "n", "edit"), "edited")

    letters = done.select("conv_id", "part", "segment", "seq", F.concat("edit.audit", F.repeat(F.lit("D"), (F.col("n") - 1).cast("int"))).alias("a"))
    joined = lambda of, *by: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*by, of))), lambda r: r[of]), "").alias("a")
    audits = letters.groupBy("conv_id", "part", "segment").agg(joined("a", "seq")).groupBy("conv_id").agg(joined("a", "part", "segment"))
    ends = chosen.groupBy("conv_id").agg(F.max("cost").alias("cost"), F.max("ending").alias("ending"))
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    whole = _long_counts(rows).alias("c").join(ends.alias("e"), same("c", "e")).join(audits.alias("a"), same("c", "a"))
    whole = whole.select("c.conv_id", *COUNTS, (F.col("cost") + F.col("copies")).alias("cost"), F.concat("a", "ending").alias("audit"), F.lit(None).cast("array<struct<role: string, text: string>>").alias("repaired"))

    turned = done.select("conv_id", "part", "seq", "role", "text", F.posexplode("edit.places").alias("sub", "place"), F.col("edit.roles").alias("roles"))
    new = F.get("roles", F.col("sub"))
    turned = turned.select("conv_id", "part", "seq", "sub", F.when(new == "", F.col("role")).otherwise(new).alias("role"), F.when(F.col("place") < 0, "").otherwise(F.col("text")).alias("text"))
    tail = chosen.where("ending != ''").select("conv_id", "part", F.lit((1 << 33) - 1).alias("seq"), F.posexplode(F.when(F.length("ending") == 2, F.array(F.lit("user"), F.lit("assistant"))).otherwise(F.array(F.lit("assistant")))).alias("sub", "role"), F.lit("").alias("text"))
    return whole, turned.unionByName(tail)


def _split(letters: str, audit: str, state: int) -> list[dict]:
    """The edits of a segment by turn: those before the turn and its own."""
    places, roles, _ = follow(letters, audit, state)
    out, at, place, own = [], 0, 0, ""
    kept: list[tuple[int, str]] = []
    for edit in audit:
        own += edit
        if edit != "D":
            kept.append((places[place], roles[place]))
            place += 1
        if edit != "I":
            out.append({"places": [-1 if p < 0 else 0 for p, _ in kept], "roles": [r for _, r in kept], "audit": own})
            at, own, kept = at + 1, "", []
    return out


def digests(found: Repaired) -> DataFrame:
    """Conversations with ``repaired_sha256`` of their repaired ``role:text``, joined by newlines.

    The hash of a long conversation is one sequential function, so its turns pass in order through one
    task; it reads them as a stream and keeps no more than the state of the hash.
    """
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    rows = found.conversations.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)).drop("repaired")
    if found.long_turns is None:
        return rows
    turns = found.long_turns
    order = ["conv_id", "part", "seq", "sub"]
    turns = turns.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", F.concat("role", F.lit(":"), "text").alias("line"))
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, column = None, None, None
        for batch in batches:
            column = batch.column(0).type
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                if state is None or conv != now:
                    if state is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], column), pa.array([state.hexdigest()])], names=["conv_id", "sha"])
                    now, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.as_buffer())
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], column), pa.array([state.hexdigest()])], names=["conv_id", "sha"])

    hashed = map_batches(turns, run, f"conv_id {kind}, sha string")
    rows = rows.alias("r").join(hashed.alias("h"), F.col("r.conv_id").eqNullSafe(F.col("h.conv_id")), "left")
    empty = hashlib.sha256().hexdigest()
    return rows.select("r.conv_id", *COUNTS, "cost", "audit", F.coalesce("r.repaired_sha256", "h.sha", F.lit(empty)).alias("repaired_sha256"))
