"""Best-fit packing of tokenized documents into sequences of a fixed length.

The plan works on the histogram of piece lengths, which has at most ``capacity`` entries whatever the
size of the corpus. Its configuration linear program (as few sequences as cover every length) is solved by multiplicative weights: lengths that the chosen
configurations cover least get the highest price, and a knapsack dynamic program, bounded by the counts, finds the configuration
of the highest total price. It stops when the covering is close to the dual bound. Few lengths are solved as they are and the solution is
rounded down. Many lengths are grouped for it; the dual prices of the groups, or those by size if their bound is greater, then price
the single lengths, and whole numbers of the configurations that are tight for these prices are taken while prices go on
to fall with coverage. The last few pieces are placed best fit, longest first, in classes of equal
sequences. Spark ranks the pieces of each length, and a rank names its place in the plan.

Null text is empty, so such a document is one piece that holds the end id. Repeated rows are packed as
often as they occur; equal rows are interchangeable, so their places may be swapped but not lost. An
empty table gives no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm import words
from tidecast.llm.staging import map_batches, stage
from tidecast.llm.tokens import SLICE_BYTES, encoder

#: Buckets that the pieces of one length are dealt over for ranking.
RANK_BUCKETS = 256


def cut_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
    doc_id: str = "doc_id", text: str = "text", with_ids: bool = False, remembered: int | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids``.

    ``remembered`` bounds the pieces of text whose ids a worker keeps; it trades memory for time.
    """
    kind = docs.schema[doc_id].dataType
    fields = [T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, remembered)
        for batch in batches:
            data, offsets = words.buffers(batch.column(1))
            for low, high in words.slices(offsets, SLICE_BYTES):
                ids, bounds = enc.encode(data[offsets[low] : offsets[high]], offsets[low : high + 1], end_id)
                sizes = np.diff(bounds)
                n = -(-sizes // capacity)
                row = np.repeat(np.arange(high - low), n)
                piece = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, sizes[row] - start)
                raw = memoryview(ids.astype("<u4").tobytes())
                first = (bounds[row] + start) * 4
                parts = [raw[a:b] for a, b in zip(first.tolist(), (first + length * 4).tolist())]
                columns = [
                    batch.column(0).take(pa.array(row + low)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([bytes(p) for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return map_batches(docs.select(F.col(doc_id), F.col(text)), run, T.StructType(fields))


def best_configuration(lengths: np.ndarray, prices: np.ndarray, bounds: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """How many of each length, at most ``bounds``, the sequence of the highest total price holds, and that price.

    Knapsack dynamic program over the room left; a bound of n is split into items of 1, 2, 4, ... pieces.
    """
    best = np.zeros(capacity + 1)
    items = []
    for i, (length, bound) in enumerate(zip(lengths.tolist(), np.minimum(bounds, capacity // lengths).tolist())):
        many = 1
        while bound > 0:
            many = min(many, bound)
            room = many * length
            value = best[:-room] + many * prices[i]
            better = value > best[room:]
            best[room:] = np.where(better, value, best[room:])
            items.append((i, many, room, better))
            bound -= many
            many *= 2
    counts, left = np.zeros(len(lengths), np.int64), capacity
    for i, many, room, better in reversed(items):
        if left >= room and better[left - room]:
            counts[i] += many
            left -= room
    return counts, float(best[capacity])


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int, rate: float, gap: float) -> tuple[list[tuple[np.ndarray, float]], float, np.ndarray]:
    """Multiplicative weights for the covering program: configurations with their fractional numbers, the best dual bound and its prices.

    A length's weight starts in proportion to it, which makes the dual bound the number of full sequences, and falls with the share that
    is covered. Ends when the covering is within ``gap`` of the dual bound.
    """
    covered = np.zeros(len(lengths))
    taken: dict[bytes, list] = {}
    bound, dual, total = 0.0, lengths / capacity, 0.0
    for _ in range(rounds):
        prices = lengths * np.exp(-rate * (covered - covered.min()))
        config, value = best_configuration(lengths, prices, counts, capacity)
        if (prices * counts).sum() / value > bound:
            bound, dual = float((prices * counts).sum() / value), prices / value
        used = config > 0
        step = float((counts[used] / config[used]).min())
        covered[used] += step * config[used] / counts[used]
        total += step
        taken.setdefault(config.tobytes(), [config, 0.0])[1] += step
        if covered.min() > 0 and total <= (1 + gap) * bound * covered.min():
            break
    scale = 1 / max(covered.min(), 1e-9) if covered.min() > 0 else 1 / max(1.0, float(np.median(covered)))
    return sorted(((c, x * scale) for c, x in taken.values()), key=lambda p: (-p[1], p[0].tobytes())), bound, dual


def starting_prices(lengths: np.ndarray, counts: np.ndarray, capacity: int, groups: int, rounds: int, rate: float, gap: float) -> np.ndarray:
    """Prices of many lengths: their size, or the dual of the program over groups of them if its bound on the sequences is greater."""
    mass = np.cumsum(lengths * counts)
    group = np.minimum((groups * mass - 1) // max(1, mass[-1]), groups - 1)
    last = np.flatnonzero(np.append(group[1:] != group[:-1], True))
    sums = np.diff(np.append(0, np.cumsum(counts)[last]))
    dual = solve(lengths[last], sums, capacity, rounds, rate, gap)[2]
    prices = np.interp(lengths, np.append(0, lengths[last]), np.append(0, dual))
    value = best_configuration(lengths, prices, counts, capacity)[1]
    return prices / value if (prices * counts).sum() / value > 1.005 * (lengths * counts).sum() / capacity else lengths / capacity


Configurations = list[tuple[np.ndarray, int]]


def round_by_prices(lengths: np.ndarray, counts: np.ndarray, prices: np.ndarray, capacity: int, rate: float, least: int = 200) -> Iterator[tuple[np.ndarray, int]]:
    """Whole numbers of configurations that are tight for the prices, till every piece has a place.

    Prices fall with the share of a length that has a place, as in the program. Each configuration is taken as often as its
    pieces last. Pricing looks at the ``least`` lengths that are covered least; at all of them if those leave room.
    """
    left = counts.copy()
    while left.any():
        live = np.flatnonzero(left)
        covered = 1 - left[live] / counts[live]
        weight = prices[live] * np.exp(-rate * (covered - covered.mean()))
        config = np.zeros(len(lengths), np.int64)
        some = np.sort(np.lexsort((-lengths[live], np.round(covered, 1)))[:least])
        some = some if len(some) < len(live) else np.arange(len(live))
        config[live[some]] = best_configuration(lengths[live[some]], weight[some], left[live[some]], capacity)[0]
        if len(some) < len(live) and (config * lengths).sum() < capacity:
            config[live] = best_configuration(lengths[live], weight, left[live], capacity)[0]
        used = config > 0
        many = int((left[used] // config[used]).min())
        left = left - many * config
        yield config, many


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, on counted lengths; equal sequences form one class."""
    rooms: dict[int, list[list]] = {}
    for length in sorted(left, reverse=True):
        n = left[length]
        room = length
        while n and room <= capacity:
            classes = rooms.get(room)
            if not classes:
                room += 1
                continue
            content, many = classes.pop()
            fit = room // length
            if n >= fit * many or fit > n:
                each, use = min(fit, n), min(many, max(1, n // fit))
            else:
                each, use = fit, n // fit
            rooms.setdefault(room - each * length, []).append([content | {length: each}, use])
            if many > use:
                classes.append([content, many - use])
            n -= each * use
        fit = capacity // length
        if n >= fit:
            rooms.setdefault(capacity - fit * length, []).append([{length: fit}, n // fit])
            n %= fit
        if n:
            rooms.setdefault(capacity - n * length, []).append([{length: n}, 1])
    return [(content, many) for room in sorted(rooms) for content, many in rooms[room]]


def make_plan(
    histogram: dict[int, int], capacity: int = 2048, rounds: int = 2000, rate: float = 0.1, gap: float = 0.01, groups: int = 64, program: float = 0.5
) -> tuple[list[tuple[dict[int, int], int]], int]:
    """Sequence contents ``{length: number}`` and how many sequences have each, and how many of the plan's entries the program made.

    Up to ``groups`` different lengths, the program's solution is rounded down, largest first. What is left, or everything if
    there are more lengths, is rounded by its prices. From where the program has placed the share ``program`` of all tokens on, the rest may
    be placed best fit; the plan ends where that takes fewest sequences.
    """
    left = {k: v for k, v in sorted(histogram.items()) if v}
    plan: list[tuple[dict[int, int], int]] = []
    if capacity in left:
        plan.append(({capacity: 1}, left.pop(capacity)))
    if not left:
        return plan, 0
    lengths, have = np.array(list(left), np.int64), np.array(list(left.values()), np.int64)
    total, first = int((lengths * have).sum()), len(plan)

    def add(config: np.ndarray, many: int) -> None:
        used = config > 0
        plan.append(({int(k): int(a) for k, a in zip(lengths[used], config[used])}, many))

    if len(lengths) <= groups:
        found, _, prices = solve(lengths, have, capacity, rounds, rate, gap)
        for config, x in found:
            used = config > 0
            many = min(int(x), int((have[used] // config[used]).min()))
            if many:
                have = have - many * config
                add(config, many)
    else:
        prices = starting_prices(lengths, have, capacity, groups, rounds, rate, gap)
    if not have.any():
        return plan, len(plan) - first
    ends: list[tuple[int, int, list]] = []
    used_up = sum(many for _, many in plan)
    shares = iter([*np.arange(1 - program, 0, -0.05), 0.0])
    share = next(shares)
    steps = round_by_prices(lengths, have, prices, capacity, rate)
    while True:
        if (have * lengths).sum() <= share * total:
            rest = best_fit({k: v for k, v in zip(lengths.tolist(), have.tolist()) if v}, capacity)
            ends.append((used_up + sum(many for _, many in rest), -len(plan), rest))
            share = next(shares, -1.0)
            while share > 0 and (have * lengths).sum() <= share * total:
                share = next(shares, -1.0)
        config, many = next(steps, (None, 0))
        if config is None:
            break
        have = have - many * config
        used_up += many
        add(config, many)
    ends.append((used_up, -len(plan), []))
    _, upto, rest = min(ends, key=lambda e: e[:2])
    return plan[:-upto] + rest, -upto - first


def place(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each length, which ranks go to which sequences, and where in them."""
    rows, used, sequence = [], {}, 0
    for content, many in plan:
        at = 0
        for length, each in sorted(content.items(), reverse=True):
            first = used.get(length, 0)
            rows.append((length, first, sequence, each, at))
            used[length] = first + each * many
            at += length * each
        sequence += many
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "each", "offset"), table.T.copy()))


def pack(pieces: DataFrame, capacity: int = 2048, rounds: int = 2000, rate: float = 0.1) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of :func:`cut_pieces`; nothing is cut further."""
    pieces = stage(pieces, "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = place(make_plan(histogram, capacity, rounds, rate)[0])
    bucketed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_BUCKETS)).cast("int"))
    sizes = bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        bucketed.withColumn("_row", F.row_number().over(inside).cast("long") - 1)
        .join(firsts, ["length", "_bucket"])
        .withColumn("_rank", F.col("_first") + F.col("_row"))
        .select(*pieces.columns, "_rank")
    )
    at_length, at_rank = pieces.columns.index("length"), len(pieces.columns)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (at_length, at_rank))
            low = np.searchsorted(slots["length"], length)
            many = np.searchsorted(slots["length"], length, side="right")
            order = slots["length"] * (1 << 44) + slots["first"]
            slot = np.searchsorted(order, length * (1 << 44) + rank, side="right") - 1
            assert ((slot >= low) & (slot < many)).all()
            rank = rank - slots["first"][slot]
            each = slots["each"][slot]
            columns = [batch.column(i) for i in range(at_rank)]
            columns.append(pa.array(slots["sequence"][slot] + rank // each))
            columns.append(pa.array(slots["offset"][slot] + rank % each * length))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(ranked, run, schema)
