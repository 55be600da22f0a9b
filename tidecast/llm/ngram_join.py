"""Exact Jaccard self-join of word n-gram sets by partitioning the universe of n-grams.

Two sets whose Jaccard similarity reaches the threshold differ in at most ``U`` elements, where ``U``
follows from their sizes. The elements of a set are dealt into ``U + 1 + E`` segments, so linked sets
agree in at least ``E + 1`` of them. Sizes fall into bands; a set emits one signature for each segment of
its own band, and of the next band if a larger partner may be there.

* Universe. N-grams that many documents have (common passages, large groups of near copies) go to
  segments of their own, the others to the rest, both by hash. Which n-grams are common is counted on a
  sample; it moves work between segments and has no influence on the result.
* Subsets. A set may leave out ``E`` segments: empty ones first, then those whose signatures are in the
  largest buckets, by one order for all sets. Of the ``E + 1`` or more segments that two linked sets agree
  in, the cheapest is left out by neither. Sets that share only a passage leave its segments out and
  don't meet; copies of one text leave the empty ones out and meet in the common ones.
* Allocation. A cost model weighs signatures against chance agreements and gives every band its number
  of segments and its slack ``E``. Bands of short sets may instead get fewer segments, of which the first
  also emits its one-deletion neighbourhood and then counts for two.
* Equal sets are one class throughout; classes are joined, not documents.
* Large buckets. Candidates are verified in stars around the most typical class first. What has become
  connected needs no more comparison. Small buckets then compare the pairs that are not connected yet. In
  large ones classes are compared by their differences from the group's consensus: two classes can only
  link if both are close to it, and then to the closest of all, or if they share rare differences. This
  finds the same components as comparing all pairs.

Verification compares the whole sets of 64-bit n-gram hashes.

A null or empty text has no n-grams and no links. A text of fewer words than ``n`` is one n-gram. A null
id takes part in nothing: its component is null. Rows that repeat an id belong to the component of
either text. An empty table gives no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm import words
from tidecast.llm.components import components
from tidecast.llm.staging import map_batches, small, stage, worker_store

SLICE_BYTES = 2_000_000
#: Least ratio of the largest sizes of neighbouring bands.
BAND_RATIO = 1.4
#: N-grams that a set is taken to share with unrelated ones, beside a tenth of all, for the cost model.
PASSAGE = 50
#: What comparing two sets costs, in signatures.
PAIR_COST = 4
#: Rows up to which the ids of the classes to be verified are broadcast.
BROADCAST_CLASSES = 200_000
STAR_ROUNDS = 3
#: Classes in a bucket up to which all pairs are compared; larger ones are compared by their edits.
SMALL_BUCKET = 32
#: Width of the levels of ``f`` next to 0.
LEVEL = 4
#: Bound on the rounding errors of ``f``.
ROUNDING = 1e-6
#: Groups up to which the consensus sets are broadcast.
BROADCAST_HUBS = 500
#: Bits of a block of Spark's bitmaps, bits for each edit that classes share, and the most of all (4 MB).
BLOCK_BITS, EDIT_BITS, MOST_BITS = 1 << 15, 16, 1 << 25
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


@dataclass(frozen=True)
class Band:
    """Sizes up to ``high``: segments of rare and of common elements, and the slack.

    With ``deletion`` segment 0 has a one-deletion neighbourhood, and common elements are like others.
    """

    high: int
    rare: int
    common: int
    slack: int
    deletion: bool = False

    @property
    def segments(self) -> int:
        return self.rare + self.common


def bands(percent: int, many: int, largest: int = 1 << 31) -> list[Band]:
    """Bands up to the size ``largest`` for about ``many`` sets in each."""
    out, high = [], 6
    while True:
        most = (100 - percent) * 2 * high // (100 + percent)
        size = 0.85 * high
        own = size * max(0.3, 0.9 - PASSAGE / size)
        options = []
        for extra in sorted({0, *(-(-(most + 1) * k // 8) for k in (1, 2, 3, 4))}):
            # All segments of either kind can be left out: by sets that have only elements of the other.
            band = Band(high, most + 1 + extra, most + 1, most + 1 + extra)
            # Segments of rare elements agree if neither set has an element of its own there.
            chance = math.exp(-2 * own / band.rare)
            options.append((band.rare + PAIR_COST * many * _at_least(extra + 1, band.rare, chance), band))
        if 1 <= most <= 2:
            chance = math.exp(-2 * own / most) * (1 + size / most)
            options.append((most + 1 + size / most + PAIR_COST * many * _at_least(1, most, chance), Band(high, most, 0, 0, True)))
        out.append(min(options, key=lambda o: o[0])[1])
        if high >= largest:
            return out
        # A linked partner is in the same band or the next one.
        high = max(high + 6, int(high * BAND_RATIO), 100 * high // percent)


def _at_least(k: int, m: int, chance: float) -> float:
    """A bound on the chance of k or more agreements among m segments (Chernoff)."""
    x = min(k / m, 1 - 1e-9)
    if chance >= x:
        return 1.0
    chance = max(chance, 1e-300)
    return math.exp(-m * (x * math.log(x / chance) + (1 - x) * math.log((1 - x) / (1 - chance))))


def common_items(docs: DataFrame, n: int, doc_id: str, text: str, sample: int = 8000, least: int = 6, most: int = 500_000) -> np.ndarray:
    """Hashes of n-grams that ``least`` or more of about ``sample`` documents have, sorted.

    Only costs depend on it. Of very many, the ``most`` frequent are taken.
    """
    total = max(1, docs.count())
    share = min(1.0, max(sample, total / 500) / total)
    picked = F.pmod(F.xxhash64(doc_id, F.lit(17)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.buffers(batch.column(0))
            for low, high in words.slices(offsets, SLICE_BYTES):
                sets, _ = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1], n)
                items, count = np.unique(sets, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(_signed(items)), pa.array(count)], names=["item", "n"])

    counts = map_batches(docs.where(picked).select(F.col(text)), run, "item long, n long").groupBy("item").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "item").limit(most).select("item").collect()
    return np.sort(np.array([r.item for r in rows], np.int64).view(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row's word n-grams, sorted, and the bounds of the rows."""
    data = words.LOWER[data]
    starts, lengths, rows = words.spans(data, offsets)
    hashed = words.hashes(data, starts, lengths)
    n_rows = len(offsets) - 1
    count = np.bincount(rows, minlength=n_rows)
    first = np.cumsum(count) - count
    grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    bounds = np.append(0, np.cumsum(grams))
    row = np.repeat(np.arange(n_rows), grams)
    at = np.arange(int(bounds[-1])) - bounds[row] + first[row]
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        have = k < count[row]
        place = np.minimum(at + k, max(0, len(hashed) - 1))
        out = words.mix(out + np.where(have, hashed[place] if len(hashed) else 0, 0).astype(np.uint64) * _ODD[k % 4] + np.uint64(k + 1) * have)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out[a:b].sort()
    new = np.ones(len(out), dtype=bool)
    new[1:] = out[1:] != out[:-1]
    new[bounds[:-1][grams > 0]] = True
    sizes = np.bincount(row[new], minlength=n_rows)
    return out[new], np.append(0, np.cumsum(sizes))


def class_keys(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each whole set."""
    out = []
    for salt in (_ODD[1], _ODD[3]):
        total = np.append(np.uint64(0), np.cumsum(words.mix(sets ^ salt)))
        out.append(words.mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64) * salt))
    return out[0], out[1]


def _in_band(values: np.ndarray, number: int) -> np.ndarray:
    """Signatures name their band in the lowest six bits."""
    return words.mix(values) & np.uint64(2**64 - 64) | np.uint64(number)


def signatures(sets: np.ndarray, bounds: np.ndarray, plan: list[Band], percent: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of each set in its own band, and in the next one if a partner may be there, with bounds.

    Also how many of them it may leave out in either band; empty segments have used up some of the slack.
    """
    sizes = np.diff(bounds)
    spare = np.zeros((len(sizes), 2), np.int32)
    highs = np.array([b.high for b in plan])
    own = np.searchsorted(highs, sizes)
    is_common = np.zeros(len(sets), dtype=bool)
    if len(common):
        is_common = common[np.minimum(np.searchsorted(common, sets), len(common) - 1)] == sets
    keys, owners = [], []
    for step in (0, 1):
        for number in np.unique(own + step).tolist():
            if not 0 <= number < len(plan):
                continue
            band = plan[number]
            mine = (own + step == number) & (sizes > 0)
            if step:
                mine &= 100 * sizes >= percent * (highs[number - 1] + 1)
            rows = np.flatnonzero(mine)
            if not len(rows):
                continue
            n = sizes[rows]
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[rows], n)
            element = words.mix(sets[at] ^ np.uint64(0x5851F42D4C957F2D + number))
            segment = (element >> np.uint64(33)).astype(np.int64)
            if band.common:
                segment = np.where(is_common[at], band.rare + segment % band.common, segment % band.rare)
            else:
                segment %= band.rare
            element = words.mix(element)
            slot = np.repeat(np.arange(len(rows)) * band.segments, n) + segment
            total = np.zeros(len(rows) * band.segments, np.uint64)
            np.add.at(total, slot, element)
            filled = np.bincount(slot, minlength=len(total)).reshape(-1, band.segments) > 0
            # Empty segments are the dearest: a set leaves out as many as its slack allows.
            empty = ~filled
            spare[rows, step] = np.maximum(0, band.slack - empty.sum(axis=1))
            emit = filled | (np.cumsum(empty, axis=1) > band.slack) & empty
            kept = np.flatnonzero(emit.ravel())
            name = words.mix((np.arange(band.segments) + (number << 40)).astype(np.uint64))
            keys.append(_in_band(total[kept] ^ name[kept % band.segments], number))
            owners.append(rows[kept // band.segments])
            if band.deletion:
                drop = np.flatnonzero(segment == 0)
                keys.append(_in_band((total[slot[drop]] - element[drop]) ^ name[0], number))
                owners.append(rows[slot[drop] // band.segments])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), spare
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return key[order], np.append(0, np.cumsum(np.bincount(owner, minlength=len(sizes)))), spare


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def sketch(docs: DataFrame, n: int, percent: int, plan: list[Band], common: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """``doc_id, n_shingles, key, key2, spare, spare_next, signatures`` of every document."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_shingles", T.LongType()),
        T.StructField("key", T.LongType()), T.StructField("key2", T.LongType()),
        T.StructField("spare", T.IntegerType()), T.StructField("spare_next", T.IntegerType()),
        T.StructField("signatures", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("ngram_join")  # what another operator has left goes
        for batch in batches:
            data, offsets = words.buffers(batch.column(1))
            for low, high in words.slices(offsets, SLICE_BYTES):
                sets, bounds = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1], n)
                key, key2 = class_keys(sets, bounds)
                signs, at, spare = signatures(sets, bounds, plan, percent, common)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low), pa.array(np.diff(bounds)), pa.array(_signed(key)), pa.array(_signed(key2)),
                        pa.array(spare[:, 0].copy()), pa.array(spare[:, 1].copy()),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(_signed(signs))),
                    ],
                    names=schema.names,
                )

    return map_batches(docs.select(F.col(doc_id), F.col(text)), run, schema)


def class_sets(docs: DataFrame, wanted: DataFrame, n: int, doc_id: str, text: str) -> DataFrame:
    """``key, items`` of the classes in ``wanted(doc_id, key)``, from the text of one document each."""
    side = F.broadcast(wanted) if small(wanted, BROADCAST_CLASSES) else wanted
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(side, "doc_id").select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.buffers(batch.column(1))
            want = batch.column(0).to_numpy()
            for low, high in words.slices(offsets, SLICE_BYTES):
                sets, bounds = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1], n)
                key = _signed(class_keys(sets, bounds)[0])
                # A repeated id may bring texts of other classes.
                rows = np.flatnonzero(key == want[low:high]).tolist()
                items = [sets[bounds[i] : bounds[i + 1]].tobytes() for i in rows]
                yield pa.RecordBatch.from_arrays([pa.array(key[rows]), pa.array(items, pa.binary())], names=["key", "items"])

    return map_batches(found, run, "key long, items binary")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among ``pairs(u, v)``, by the sizes of the intersections of the whole sets."""
    left = sets.select(F.col("key").alias("u"), F.col("items").alias("a"))
    right = sets.select(F.col("key").alias("v"), F.col("items").alias("b"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
                common = 0
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    at = np.searchsorted(x, y)
                    common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                ok.append(100 * common >= percent * (len(x) + len(y) - common) and common > 0)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return map_batches(both, run, "u long, v long")


def distinct_classes(sketches: DataFrame) -> DataFrame:
    """The sketches without further copies: one row for each class of equal sets.

    Copies are found by keys and row numbers alone, so signatures are not shuffled for it.
    """
    own = sketches.where("doc_id is not null and n_shingles > 0")
    first = own.groupBy("key").agg(F.min("row").alias("_first"))
    copies = stage(own.select("key", "row").join(first, "key").where("row != _first").select("row"), "copies")
    return own.join(F.broadcast(copies) if small(copies, BROADCAST_CLASSES) else copies, "row", "left_anti")


def _by_bucket(rows: DataFrame, *facts: Column) -> DataFrame:
    """The rows with facts of their bucket, which are combined before the shuffle; a join spreads the rows of a hot bucket."""
    return rows.join(rows.groupBy("bucket").agg(*facts), "bucket")


def members(classes: DataFrame, plan: list[Band]) -> DataFrame:
    """``bucket, key, weight``: signatures that classes share, without the dearest ones of each class.

    ``weight`` grows with the buckets that a class is in, so it is largest for the typical class of a group.
    """
    # All but a few signatures have one class only; this pass keeps those of several, with 16 bytes for each.
    by = Window.partitionBy("bucket")
    rows = classes.select("key", F.explode(F.array_distinct("signatures")).alias("bucket"))
    rows = rows.select("key", "bucket", F.min("key").over(by).alias("_low"), F.max("key").over(by).alias("_high"))
    shared = stage(rows.where("_low != _high").select("bucket", "key"), "shared")
    shared = shared.join(classes.select("key", "n_shingles", "spare", "spare_next"), "key")
    shared = _by_bucket(shared, F.count("*").alias("many"), F.max("n_shingles").alias("largest"))
    band = F.col("bucket").bitwiseAND(63).cast("int")
    lows = F.array(*[F.lit(b.high) for b in [Band(0, 0, 0, 0), *plan[:-1]]])
    # Without a set of the band itself, its smaller partners meet in their own band.
    rows = shared.withColumn("band", band).where(F.col("largest") > F.get(lows, "band"))
    slack = F.when(F.col("n_shingles") > F.get(lows, "band"), F.col("spare")).otherwise(F.col("spare_next"))
    dear = Window.partitionBy("key", "band").orderBy(F.col("many").desc(), "bucket")
    rows = rows.withColumn("_nth", F.row_number().over(dear)).where(F.col("_nth") > slack)
    rows = stage(rows.select("bucket", "key"), "dear")
    rows = _by_bucket(rows, F.count("*").alias("many")).where("many > 1")
    weight = F.sum("many").over(Window.partitionBy("key"))
    return stage(rows.select("bucket", "key", weight.alias("weight")), "members")


def join_components(
    docs: DataFrame, n: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    Documents link when ``100 * intersection >= percent * union``; ``component_id`` is the smallest id
    that can be reached by links.
    """
    plan = bands(percent, max(1000, docs.count() // 16))
    common = common_items(docs, n, doc_id, text)
    sketches = stage(sketch(docs, n, percent, plan, common, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "sketches")
    labels = linked_classes(docs, sketches, plan, n, percent, doc_id, text)
    classes = sketches.drop("signatures", "spare", "spare_next", "row").join(labels.select(F.col("node").alias("key"), "component"), "key", "left")
    # Without links a class is its own component; the second hash and the size keep chance equals apart.
    alone = F.col("component").isNull()
    name = F.struct(
        F.coalesce("component", "key").alias("c"),
        F.when(alone, F.col("key2")).alias("k"), F.when(alone, F.col("n_shingles")).alias("n"),
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).alias("d"),
    )
    classes = stage(classes.select("doc_id", "n_shingles", F.xxhash64(name).alias("_h"), name.alias("_name")), "classes")
    least = classes.groupBy("_h", "_name").agg(F.min("doc_id").alias("component_id"))
    least = least.select("_h", F.col("_name").alias("_other"), "component_id")
    same = F.col("_name").eqNullSafe(F.col("_other"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return classes.join(least, ["_h"]).where(same).select("doc_id", "n_shingles", component.alias("component_id"))


def keep_one(docs: DataFrame, n: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those linked, directly or not, to one of a smaller id; all columns.

    Rows that repeat an id are one document: the one with the least text stays. Rows without id stay.
    """
    linked = join_components(docs, n, percent, doc_id, text).where("component_id != doc_id")
    linked = stage(linked.select(F.col("doc_id").alias(doc_id)).distinct(), "duplicates")
    kept = docs.join(linked, doc_id, "left_anti")
    again = docs.groupBy(doc_id).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).dropna(subset=[doc_id]).select(doc_id)
    again = stage(again, "repeated")
    if again.isEmpty():
        return kept
    nth = F.row_number().over(Window.partitionBy(doc_id).orderBy(text))
    several = kept.join(again, doc_id, "left_semi").select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), nth.alias("nth"))
    return kept.join(again, doc_id, "left_anti").unionByName(several.where("nth = 1").select("row.*"))


def linked_classes(docs: DataFrame, sketches: DataFrame, plan: list[Band], n: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """``node, component`` of all classes that link with another one."""
    classes = distinct_classes(sketches)
    rows = members(classes, plan)
    one = stage(classes.select("key", "doc_id").join(rows.select("key").distinct(), "key", "left_semi"), "chosen")
    # Rows that repeat an id with its text bring the same set again; its edits would count several times.
    sets = stage(class_sets(docs, one, n, doc_id, text).dropDuplicates(["key"]), "sets")
    tested = links = labels = None
    open_rows = rows.withColumn("part", F.col("key"))
    # Stars around typical classes, then around the middles of large buckets, then whatever pairs are left.
    turn, last = 0, STAR_ROUNDS + 1
    while True:
        if turn < STAR_ROUNDS:
            pairs = _stars(open_rows, turn)
        else:
            large = stage(_large(open_rows), "large")
            edits = None if large.isEmpty() else stage(_edits(large, sets, percent), "edits")
            if turn == STAR_ROUNDS:
                pairs = _middles(edits).unionByName(_edit_stars(edits)).distinct() if edits is not None else None
            else:
                pairs = _across(_small(open_rows))
                if edits is not None:
                    # The groups that are left have another consensus, with which other classes are close.
                    pairs = pairs.unionByName(_middles(edits)).unionByName(_sharing_edits(edits)).distinct()
        none = pairs is None
        if pairs is not None:
            if tested is not None:
                pairs = pairs.join(tested, ["u", "v"], "left_anti")
            pairs = stage(pairs, "pairs")
            tested = pairs if tested is None else tested.unionByName(pairs)
            found = stage(verify(pairs, sets, percent), "verified")
            links = found if links is None else links.unionByName(found)
            none = found.isEmpty()
        if labels is None or not none:
            labels = stage(components(links), "labels")
        if turn == last:
            return labels
        parts = rows.join(labels.select(F.col("node").alias("key"), "component"), "key", "left")
        parts = parts.select("bucket", "key", "weight", F.coalesce("component", "key").alias("part"))
        facts = F.min("part").alias("_low"), F.max("part").alias("_high"), F.count("*").alias("many")
        open_rows = stage(_by_bucket(parts, *facts).where("_low != _high").drop("_low", "_high"), "open")
        if open_rows.isEmpty():
            return labels
        # Stars that connect nothing any more leave the rest to what follows.
        turn = STAR_ROUNDS if none and turn < STAR_ROUNDS else turn + 1


def _stars(rows: DataFrame, turn: int) -> DataFrame:
    """Pairs of the most typical class of each bucket with the members that are not connected with it.

    Each turn leaves out the part of the middle before, which has been compared with the others.
    """
    middle = F.max(F.struct("weight", "key", "part")).alias("_m")
    for _ in range(turn + 1):
        rows = _by_bucket(rows, middle).where("key = _m.key or part != _m.part")
        stars, rows = rows, rows.where("part != _m.part").drop("_m")
    pairs = stars.where("part != _m.part")
    return pairs.select(F.least("key", "_m.key").alias("u"), F.greatest("key", "_m.key").alias("v")).distinct()


def _small(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("many") <= SMALL_BUCKET)


def _across(rows: DataFrame) -> DataFrame:
    """All pairs of classes that share one of these buckets but are not connected."""
    rows = rows.select("bucket", "key", "part")
    other = rows.select("bucket", F.col("key").alias("v"), F.col("part").alias("other"))
    pairs = rows.select("bucket", F.col("key").alias("u"), "part").join(other, "bucket").where("u < v and part != other")
    return pairs.select("u", "v").distinct()


def _large(rows: DataFrame) -> DataFrame:
    """``hub, key, part``: members of large buckets, all of a bucket in one group.

    A bucket's group is named by its most typical class, or by the most typical one that this class meets
    in any bucket, so the buckets of one large family of texts make one group.
    """
    rows = _by_bucket(rows.where(F.col("many") > SMALL_BUCKET), F.max(F.struct("weight", "key")).alias("_top"))
    above = stage(rows.groupBy("key").agg(F.max("_top")["key"].alias("_above")), "above")
    grouped = rows.select(F.col("_top.key").alias("hub"), "key", "part").distinct()
    for _ in range(2):
        up = above.select(F.col("key").alias("hub"), "_above")
        grouped = grouped.join(up, "hub").select(F.col("_above").alias("hub"), "key", "part").distinct()
    return grouped


def _edits(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``hub, key, part, items, f``: how each class differs from the consensus of its group.

    The consensus holds what more than half of the group has. A class's edits are the elements that it has
    beyond it, and the complements of those that it lacks. Two classes differ in as many elements as they
    have edits, less twice the edits that they share; so with ``f`` = edits - size * (1 - t) / (1 + t)
    they link if and only if they share ``(f + f') / 2`` edits or more. ``items`` are the edits without those
    that no other class of the group has; a few of these stay, as shared ones are known by a bitmap.
    """
    members_ = large.join(sets, "key")

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hubs = batch.column(0).to_numpy()
            for hub in np.unique(hubs).tolist():
                mine = [np.frombuffer(batch.column(1)[i].as_buffer(), np.int64) for i in np.flatnonzero(hubs == hub).tolist()]
                item, n = np.unique(np.concatenate(mine), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(item), hub)), pa.array(item), pa.array(n)], names=["hub", "item", "n"])

    counts = map_batches(members_.select("hub", "items"), elements, "hub long, item long, n long").groupBy("hub", "item").agg(F.sum("n").alias("n"))
    sizes = large.groupBy("hub").agg(F.count("*").alias("many"))
    counts = stage(counts.where("n > 1").join(sizes, "hub"), "counts")
    most = 2 * F.col("n") > F.col("many")
    usual = stage(counts.where(most).groupBy("hub").agg(F.collect_list("item").alias("usual")), "consensus")
    edit = F.when(most, F.bitwise_not("item")).otherwise(F.col("item"))
    shared = _bitmap(counts.where(~most | (F.col("many") - F.col("n") > 1)).select("hub", edit.alias("item")))
    side = F.broadcast(usual) if small(usual, BROADCAST_HUBS) else usual
    rows = members_.join(side, "hub", "left").select("hub", "key", "part", "items", "usual")

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, f = [], []
            for hub, own, common in zip(batch.column(0).to_numpy(), batch.column(3), batch.column(4)):
                x = np.frombuffer(own.as_buffer(), np.int64)
                y = common.values.to_numpy() if common.is_valid else np.zeros(0, np.int64)
                edit = np.concatenate([np.setdiff1d(x, y), ~np.setdiff1d(y, x)])
                at = (edit ^ hub) & (8 * len(shared) - 1)
                out.append(edit[(shared[at >> 3] >> (at & 7)) & 1 == 1])
                f.append(len(edit) - (100 - percent) * len(x) / (100 + percent))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(out, pa.list_(pa.int64())), pa.array(f, pa.float64())], names=["hub", "key", "part", "items", "f"]
            )

    return map_batches(rows, differ, "hub long, key long, part long, items array<long>, f double")


def _bitmap(shared: DataFrame) -> np.ndarray:
    """Bytes of a bitmap that has the bit of every row of ``shared(hub, item)``; its size is bounded, and other edits may meet a bit."""
    many, bits = shared.count(), BLOCK_BITS
    while bits < min(EDIT_BITS * many, MOST_BITS):
        bits *= 2
    place = shared.select(F.col("item").bitwiseXOR(F.col("hub")).bitwiseAND(F.lit(bits - 1)).alias("at"))
    block = F.shiftright("at", BLOCK_BITS.bit_length() - 1).alias("block")
    blocks = place.groupBy(block).agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("long")).alias("bits"))
    out = np.zeros((bits // BLOCK_BITS, BLOCK_BITS // 8), np.uint8)
    for row in blocks.collect():
        out[row.block] = np.frombuffer(row.bits, np.uint8)
    return out.ravel()


def _middles(edits: DataFrame) -> DataFrame:
    """Pairs of each group's class of least ``f`` with the others.

    If two classes link without sharing an edit (f + f' <= 0), both link with this one.
    """
    middle = edits.groupBy("hub").agg(F.min(F.struct("f", "key", "part")).alias("_m"))
    pairs = edits.select("hub", "key", "part", "f").join(middle, "hub").where((F.col("part") != F.col("_m.part")) & (F.col("f") + F.col("_m.f") <= ROUNDING))
    return pairs.select(F.least("key", "_m.key").alias("u"), F.greatest("key", "_m.key").alias("v")).distinct()


def _spread(edits: DataFrame) -> DataFrame:
    """``hub, item, key, part, f, reach``: the edits of each class that others share and that a partner may have to be found by.

    A class that has fewer edits than it would have to share with the class of least ``f`` links with none. Linked classes share at least ``(f + f') / 2`` edits. If a class has ``r`` edits from here on, rarest first, then
    the rarest one that it shares with a partner is here only if ``f' <= 2 r - f``, which is the edit's ``reach``. One order holds for all
    classes of a group, so the rarest shared edit is the same for both.
    """
    least = edits.groupBy("hub").agg(F.min("f").alias("_least"))
    side = F.broadcast(least) if small(least, BROADCAST_CLASSES) else least
    rows = edits.join(side, "hub").where(2 * F.size("items") >= F.col("f") + F.col("_least") - ROUNDING)
    rows = rows.select("hub", "key", "part", "f", F.explode("items").alias("item"))
    counts = rows.groupBy("hub", "item").agg(F.count("*").alias("_n"))
    rows = rows.join(counts, ["hub", "item"])
    left = F.row_number().over(Window.partitionBy("hub", "key").orderBy(F.desc("_n"), F.desc("item")))
    rows = rows.withColumn("reach", 2 * left - F.col("f") + ROUNDING)
    return rows.where("_n > 1").drop("_n")


def _edit_stars(edits: DataFrame) -> DataFrame:
    """Pairs of the class of least ``f`` among those that share an edit with the others, as far as its edit's reach goes."""
    rows = stage(_spread(edits), "spread")
    middle = rows.groupBy("hub", "item").agg(F.min(F.struct("f", "key", "part")).alias("_m"))
    pairs = rows.join(middle, ["hub", "item"]).where((F.col("part") != F.col("_m.part")) & (F.col("_m.f") <= F.col("reach")))
    return pairs.select(F.least("key", "_m.key").alias("u"), F.greatest("key", "_m.key").alias("v")).distinct()


def _sharing_edits(edits: DataFrame) -> DataFrame:
    """Pairs of a group that share an edit within the reach of both and are not connected.

    Each class is once under each edit. Classes are put into levels of ``f`` whose width grows with its distance from 0, so
    they are few; a class meets those of its own level and of every lower one that its edit reaches.
    """
    rows = stage(_spread(edits), "spread")
    rows = rows.withColumn("level", _level(F.col("f"))).withColumn("last", F.least("level", _level(F.col("reach"))))
    own = rows.where("last = level").select("hub", "item", F.col("level").alias("at"), F.col("key").alias("v"), F.col("part").alias("other"), F.col("f").alias("g"), F.col("reach").alias("far"))
    levels = own.groupBy("hub", "item").agg(F.collect_set("at").alias("levels"))
    met = F.explode(F.filter("levels", lambda at: at <= F.col("last"))).alias("at")
    asks = rows.join(levels, ["hub", "item"]).select("hub", "item", "key", "part", "f", "reach", "level", met)
    near = (F.col("g") <= F.col("reach")) & (F.col("f") <= F.col("far"))
    pairs = asks.join(own, ["hub", "item", "at"]).where("part != other and (level > at or key < v)").where(near)
    return pairs.select(F.least("key", "v").alias("u"), F.greatest("key", "v").alias("v")).distinct()


def _level(f: Column) -> Column:
    """A step function that never falls: steps widen by half from one to the next, on either side of 0."""
    steps = F.floor(F.log(F.greatest(F.abs(f), F.lit(LEVEL)) / LEVEL) / math.log(1.5))
    return F.when(f >= LEVEL, steps + 1).when(f >= 0, 0).otherwise(-1 - steps).cast("int")
