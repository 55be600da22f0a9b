"""Approximate nearest neighbours by inner product on robust-pruned directed graphs.

Distinct vectors are dealt into bands of lengths, each up to twice the one before, and inside a band by hash into shards of a bounded size.
Each shard builds one graph: points are added in batches, a greedy beam search over the graph so far proposes neighbours, and relaxed pruning
keeps a proposal only if no kept neighbour is clearly nearer to it. An extra coordinate makes all lengths
in a shard equal, so the nearest point is the one with the largest inner product; as lengths differ by a factor of two at most, it never
drowns the others. Every query searches every shard with a beam, many queries in step, and the shards' best are merged.

Equal vectors are one point that knows its smallest ids; with ``k + 1`` of them no answer is lost, since
ties go to smaller ids. Scores are inner products of the original vectors in double precision.

Rows whose vector is null, zero, of another length than most, or holds a null or non-finite component,
and rows without id, take no part. Rows that share a query's id count as the query's own; of queries with
one id, the least vector asks. An empty table
gives no rows. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.staging import stage

#: Points in a shard, as few and as many (large tables have larger shards, so queries visit fewer).
SHARD_POINTS, MOST_POINTS, SHARDS = 8192, 65_536, 64
#: Neighbours of a point, beam widths, relaxation of pruning.
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 48, 64, 128, 1.2
#: Queries or points handled in step, and points added in one batch.
IN_STEP, BATCH = 256, 1024
#: Queries that one task searches a shard with.
QUERY_BLOCK = 65_536


def scaled(x: np.ndarray) -> np.ndarray:
    """The vectors over the power of two next to their largest component, so that no product overflows."""
    most = np.abs(x).max(initial=0)
    return np.ldexp(x, -int(np.frexp(most)[1])) if most else x


def lifted(x: np.ndarray) -> np.ndarray:
    """Scaled vectors with a coordinate that makes their lengths equal."""
    x = scaled(x)
    norms = (x * x).sum(axis=1)
    return np.concatenate([x, np.sqrt(np.maximum(0, norms.max() - norms))[:, None]], axis=1)


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int, expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The best points found for each query, nearest first, and their inner products; -1 fills up."""
    n, rows = len(queries), np.arange(len(queries))[:, None]
    ids = np.full((n, beam), -1)
    near = np.full((n, beam), -np.inf)
    done = np.ones((n, beam), dtype=bool)
    seen = np.zeros((n, len(x)), dtype=bool)
    ids[:, 0], near[:, 0], done[:, 0], seen[:, entry] = entry, queries @ x[entry], False, True
    while not done.all():
        # Positions are sorted by nearness, so the first open ones are the best.
        at = np.argsort(done, axis=1, kind="stable")[:, :expand]
        at_open = ~np.take_along_axis(done, at, axis=1)
        np.put_along_axis(done, at, True, axis=1)
        found = graph[np.take_along_axis(ids, at, axis=1)]
        found[~at_open] = -1
        found = found.reshape(n, -1)
        found[seen[rows, found] | (found < 0)] = -1
        # A point that two of the expanded ones propose counts once.
        order = np.argsort(found, axis=1, kind="stable")
        ranked = np.take_along_axis(found, order, axis=1)
        ranked[:, 1:][ranked[:, 1:] == ranked[:, :-1]] = -1
        fresh = ranked >= 0
        width = int(fresh.sum(axis=1).max(initial=0))
        if not width:
            continue
        found = -np.sort(-ranked, axis=1)[:, :width]
        fresh = found >= 0
        r, c = np.nonzero(fresh)
        seen[r, found[r, c]] = True
        score = np.full(found.shape, -np.inf)
        score[r, c] = np.einsum("ij,ij->i", x[found[r, c]], queries[r])
        ids, near = np.concatenate([ids, found], axis=1), np.concatenate([near, score], axis=1)
        done = np.concatenate([done, ~fresh], axis=1)
        best = np.argsort(-near, axis=1, kind="stable")[:, :beam]
        ids, near, done = (np.take_along_axis(a, best, axis=1) for a in (ids, near, done))
    return ids, near


def robust_prune(x: np.ndarray, points: np.ndarray, proposals: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` of each point's proposals: the nearest first, none close to one kept before."""
    length = float((x[0] * x[0]).sum())
    proposals = np.where(proposals == points[:, None], -1, proposals)
    order = np.argsort(proposals, axis=1, kind="stable")
    ranked = np.take_along_axis(proposals, order, axis=1)
    ranked[:, 1:][ranked[:, 1:] == ranked[:, :-1]] = -1
    around = x[ranked]
    far = 2 * length - 2 * np.einsum("bcd,bd->bc", around, x[points])
    alive = ranked >= 0
    far[~alive] = np.inf
    out = np.full((len(points), degree), -1)
    rows = np.arange(len(points))
    for k in range(degree):
        pick = np.where(alive, far, np.inf).argmin(axis=1)
        ok = alive[rows, pick]
        if not ok.any():
            break
        out[ok, k] = ranked[rows, pick][ok]
        between = 2 * length - 2 * np.einsum("bcd,bd->bc", around, around[rows, pick])
        alive &= ~(ok[:, None] & (alpha * alpha * between <= far))
        alive[rows[ok], pick[ok]] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 5) -> tuple[np.ndarray, int]:
    """Neighbours of every point (-1 fills up) and the point where searches begin."""
    n = len(x)
    order = np.random.default_rng(seed).permutation(n)
    middle = int(np.argmax(x @ x.mean(axis=0)))
    order = np.append(middle, order[order != middle])
    graph = np.full((n, degree), -1)
    at = 1
    while at < n:
        # Batches are no larger than the graph so far.
        batch = order[at : at + min(at, BATCH)]
        for low in range(0, len(batch), IN_STEP):
            part = batch[low : low + IN_STEP]
            found, _ = beam_search(x, graph, middle, x[part], beam)
            graph[part] = robust_prune(x, part, found, degree, alpha)
        source = np.repeat(batch, degree)
        target = graph[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        while len(target):
            points, first, count = np.unique(target, return_index=True, return_counts=True)
            nth = np.arange(len(target)) - np.repeat(first, count)
            now = nth < degree
            incoming = np.full((len(points), degree), -1)
            incoming[np.repeat(np.arange(len(points)), count)[now], nth[now]] = source[now]
            for low in range(0, len(points), IN_STEP):
                part = points[low : low + IN_STEP]
                both = np.concatenate([graph[part], incoming[low : low + IN_STEP]], axis=1)
                have = -np.sort(-both, axis=1)
                fits = (have >= 0).sum(axis=1) <= degree
                graph[part[fits]] = have[fits, :degree]
                if not fits.all():
                    graph[part[~fits]] = robust_prune(x, part[~fits], both[~fits], degree, alpha)
            source, target = source[~now], target[~now]
        at += len(batch)
    return graph, middle


def search_shard(x: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, wanted: int, beam: int) -> np.ndarray:
    """Points found for each query, nearest first by the lifted vectors; all of a shard that is small."""
    if len(x) <= max(beam, wanted):
        return np.broadcast_to(np.arange(len(x)), (len(queries), len(x)))
    most = np.abs(queries).max(axis=1, initial=0, keepdims=True)
    lifted_queries = np.concatenate([np.ldexp(queries, -np.frexp(most)[1]), np.zeros((len(queries), 1))], axis=1)
    parts = [beam_search(x, graph, entry, lifted_queries[i : i + IN_STEP], beam)[0] for i in range(0, len(queries), IN_STEP)]
    return np.concatenate(parts)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def valid_rows(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, vector`` (doubles) of the rows that take part."""
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.where(finite & F.exists("vector", lambda v: v != 0))
    usual = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    return rows.where(F.size("vector") == F.lit(usual["n"] if usual else 0))


def build_index(rows: DataFrame, k: int = 20, shard_points: int = SHARD_POINTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The index: ``shard, point, ids, vector, neighbours, entry``, one row per distinct vector."""
    rows = valid_rows(rows, vec_id, vector)
    # Zeros of either sign are one value.
    rows = rows.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0)))
    rows = rows.withColumns({"_a": F.xxhash64("vector"), "_b": F.xxhash64(F.lit(1), "vector")})
    rows = rows.dropDuplicates(["vec_id", "_a", "_b"])
    nth = F.row_number().over(Window.partitionBy("_a", "_b").orderBy("vec_id"))
    rows = rows.withColumn("_nth", nth).where(F.col("_nth") <= k + 1)
    points = rows.groupBy("_a", "_b").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = stage(points, "points")
    most = F.array_max(F.transform("vector", F.abs))
    squares = F.aggregate(F.transform("vector", lambda v: F.pow(v / most, 2)), F.lit(0.0), lambda a, v: a + v)
    banded = points.withColumn("band", F.floor(F.log2(most) + F.log2(squares) / 2).cast("int"))
    # At most one band for each exponent of a double.
    bands = sorted((r.band, r.n) for r in banded.groupBy("band").agg(F.count("*").alias("n")).collect())
    shard_points = min(MOST_POINTS, max(shard_points, sum(n for _, n in bands) // SHARDS))
    places, shards = [], 0
    for band, n in bands:
        places.append((band, shards, -(-n // shard_points)))
        shards += places[-1][2]
    places = points.sparkSession.createDataFrame(places, "band int, first int, many int")

    def build(table: pa.Table) -> pa.Table:
        x = _matrix(table["vector"])
        graph, entry = build_graph(lifted(x))
        n, width = graph.shape
        neighbours = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width), pa.int32()), pa.array(graph.ravel(), pa.int32()))
        return pa.table({
            "shard": table["shard"], "point": pa.array(np.arange(n), pa.int32()), "ids": table["ids"], "vector": table["vector"],
            "neighbours": neighbours, "entry": pa.array(np.full(n, entry), pa.int32()),
        })

    shard = (F.col("first") + F.pmod("_a", F.col("many"))).cast("int")
    dealt = banded.join(F.broadcast(places), "band").select(shard.alias("shard"), "ids", "vector")
    schema = "shard int, point int, ids array<bigint>, vector array<double>, neighbours array<int>, entry int"
    return stage(dealt.groupBy("shard").applyInArrow(build, schema), "index")


def search(index: DataFrame, queries: DataFrame, k: int = 20, beam: int = SEARCH_BEAM, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest rows of every query."""
    queries = valid_rows(queries, vec_id, vector).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))
    queries = queries.groupBy("query_id").agg(F.min("query").alias("query"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    shards = index.agg(F.max("shard")).first()[0]
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards or 0))))
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(points: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not len(points) or not len(asked):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        points = points.sort_by("point")
        x, q, own = _matrix(points["vector"]), _matrix(asked["query"]), asked["query_id"].to_numpy()
        if x.shape[1] != q.shape[1]:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        graph = _matrix(points["neighbours"])
        found = search_shard(lifted(x), graph, points["entry"][0].as_py(), q, k + 1, beam)
        ids = points["ids"].combine_chunks()
        first, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        out: list[np.ndarray] = []
        for i in range(len(q)):
            at = found[i][found[i] >= 0]
            score = (x[at] * q[i]).sum(axis=1)
            many = first[at + 1] - first[at]
            ident = flat[np.repeat(first[at], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)]
            score = np.repeat(score, many)
            keep = ident != own[i]
            ident, score = ident[keep], score[keep]
            best = np.lexsort((ident, -score))[:k]
            out.append(np.stack([np.full(len(best), i), ident[best], score[best].view(np.int64)]))
        table = np.concatenate(out, axis=1)
        return pa.table([pa.array(own[table[0]]), pa.array(table[1]), pa.array(table[2].copy().view(np.float64))], names=names)

    found = copies.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(answer, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
