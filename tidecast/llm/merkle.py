"""Merkle manifest of a table: hash trees per group, a root over them, and a proof for every row.

A leaf is the SHA-256 of a row's fields. The leaves of a group ascend by id; every two consecutive nodes
become their hash, an odd last one is hashed alone, until one is left, the group's subroot. The
subroots in order of their groups make up the top tree in the same way; its last node is the root.

Levels are built ``STRIDE`` at a time: a group of at most ``2**STRIDE`` neighbours is one row, whose levels are
folded by SQL functions, so building takes a shuffle for each ``STRIDE`` levels. What is stored is one row for each
node at the foot of such a step: its siblings on the way and a link to the parent row, which is in the next
step or, from a subroot, in the top tree. :func:`climb` is a recursive query over these rows: each leaf follows its
parent links, appends the siblings that it passes and folds its own hash with them. A node that many leaves pass is
stored in several equal copies, of which a leaf takes one by its hash, so no join key holds more than about ``SHARE`` rows.

Order: group null first, then bytewise; in a group null ids first, then ascending, rows of one id by their leaf. Equal rows
are interchangeable leaves. An empty table has no rows and no root. A group of one row is its own subroot, and of one group its
subroot is the root. Columns other than those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.staging import small, stage

STRIDE = 12
#: Leaves that share one copy of a node, and the most copies of a node.
SHARE, COPIES = 1 << 16, 256
BROADCAST_ROWS = 100_000
#: Node rows of at most STRIDE siblings that every executor may hold, about 500 bytes each.
BROADCAST_NODES = 20_000
TOP = ""


def field_text(column: str | Column) -> Column:
    """A field as hashed: UTF-8 byte count, colon, value; ``-`` if null."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*columns: str | Column) -> Column:
    """Lowercase hex SHA-256 of the fields."""
    return F.sha2(F.concat(*[field_text(c) for c in columns]), 256)


@dataclass
class Manifest:
    """``leaves``: the node rows of the leaves, with their table row as ``row``; ``nodes``: all others; ``subroots``: ``tree, subroot``."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``idx`` (from 0) and ``size`` by tree; ties of all order columns are split by a seeded number."""
    order = ["tree", *order, "_tie"]
    rows = rows.withColumn("_tie", F.rand(5)).repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    rows = stage(rows.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    runs = rows.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("size", F.sum("_n").over(tree)).drop("_n")
    # One run for each tree and each border between range partitions.
    runs = F.broadcast(runs) if small(runs, BROADCAST_ROWS) else runs
    rows = rows.join(runs, ["tree", "_part"]).withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before"))
    return rows.drop("_at", "_part", "_first", "_before")


#: Digests are kept as 32 bytes and hashed as hex text.
_PAIR = "unhex(sha2(concat(lower(hex(below[2 * j])), coalesce(lower(hex(get(below, 2 * j + 1))), '')), 256))"
_LEVELS = f"""
case when steps = 0 then array(transform(members, m -> m.digest)) else
aggregate(sequence(1, steps), array(transform(members, m -> m.digest)), (built, k) -> concat(built,
    transform(array(element_at(built, -1)), below -> transform(sequence(0, shiftright(size(below) - 1, 1)), j -> {_PAIR})))) end
"""
_SIBLINGS = """
case when steps = 0 then cast(array() as array<binary>)
else transform(sequence(0, steps - 1), k -> get(levels[k], shiftright(j, k) ^ 1)) end
"""


def _build(rows: DataFrame, extra: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Steps of groups from ``tree, idx, digest, weight, size`` and the last nodes of all trees as ``tree, digest, weight``."""
    most = rows.agg(F.max("size")).first()[0] or 0
    groups, ends = [], []
    while most > 0:
        group = rows.groupBy("tree", F.shiftright("idx", STRIDE).alias("group")).agg(
            F.first("size").alias("size"), F.sum("weight").alias("weight"), F.sort_array(F.collect_list(F.struct("idx", "digest", "weight", *extra))).alias("members")
        )
        steps = F.when(F.col("size") > 1, F.least(F.lit(STRIDE), F.length(F.bin(F.col("size") - 1)))).otherwise(0)
        group = stage(group.withColumn("steps", steps).withColumn("levels", F.expr(_LEVELS)), "levels")
        groups.append(group)
        digest = F.element_at(F.element_at("levels", -1), 1).alias("digest")
        ends.append(group.where(F.col("size") <= 1 << STRIDE).select("tree", digest, "weight"))
        left = F.shiftright(F.col("size") + ((1 << STRIDE) - 1), STRIDE).alias("size")
        rows = group.where(F.col("size") > 1 << STRIDE).select("tree", F.col("group").alias("idx"), digest, "weight", left)
        most, extra = (most + (1 << STRIDE) - 1 >> STRIDE) if most > 1 << STRIDE else 0, []
    last = rows.select("tree", "digest", "weight").limit(0) if not ends else ends[0]
    for end in ends[1:]:
        last = last.unionByName(end)
    return groups, last


def _copies(weight: Column) -> Column:
    return F.least(F.lit(COPIES), F.ceil(weight / SHARE)).cast("int")


def _node_rows(group: DataFrame, step: int, parents: DataFrame | None) -> DataFrame:
    """Node rows of one step; a tree's last step links to ``parents(tree, top_idx)`` if given, else to nothing."""
    ended = F.col("size") <= 1 << STRIDE
    if parents is None:
        group = group.withColumn("top_idx", F.lit(None).cast("long"))
    else:
        group = group.join(parents, "tree", "left")
    members = F.expr(f"transform(members, (m, j) -> named_struct('m', m, 'siblings', {_SIBLINGS}))")
    top = F.when(F.col("top_idx").isNotNull(), F.lit(TOP))
    rows = group.select(
        "tree", F.lit(step).alias("step"), F.when(ended, top).otherwise(F.col("tree")).alias("parent_tree"), F.when(ended, 0).otherwise(step + 1).alias("parent_step"),
        F.when(ended, F.col("top_idx")).otherwise(F.col("group")).alias("parent_idx"), _copies(F.col("weight")).alias("parent_copies"), F.explode(members).alias("row"),
    )
    return rows.select(*rows.columns[:-1], "row.m.*", "row.siblings")


def build_manifest(rows: DataFrame, group: Column, doc_id: str = "doc_id", leaf_digest: str = "leaf") -> Manifest:
    """Build all trees over ``rows``; ``group`` and the columns named say what their tree, order and hash are."""
    tree = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != leaf_digest]).alias("row"), tree.alias("tree"), F.unhex(leaf_digest).alias("digest"), F.lit(1).cast("long").alias("weight"), F.col(doc_id).alias("at"))
    lower, ends = _build(_numbered(rows, ["at", "digest"]), ["row"])
    ends = stage(ends, "subroots")
    top = _numbered(ends.withColumnRenamed("tree", "name").withColumn("tree", F.lit(TOP)), ["name"])
    upper, last = _build(top, ["name"])
    root = last.first()
    links = top.select(F.col("name").alias("tree"), F.col("idx").alias("top_idx"))
    columns = ["tree", "step", "idx", "salt", "siblings", "parent_tree", "parent_step", "parent_idx", "parent_copies"]
    inner = [_node_rows(g, k, links) for k, g in enumerate(lower) if k] + [_node_rows(g, k, None) for k, g in enumerate(upper)]
    leaves = _node_rows(lower[0], 0, links) if lower else rows.limit(0)
    nodes = None
    for part in inner:
        part = part.withColumn("salt", F.explode(F.sequence(F.lit(0), _copies(F.col("weight")) - 1))).select(*columns)
        nodes = part if nodes is None else nodes.unionByName(part)
    subroots = ends.select("tree", F.lower(F.hex("digest")).alias("subroot"))
    if root is None:
        return Manifest(leaves, leaves, subroots, None)
    return Manifest(stage(leaves.drop("weight"), "leaves"), stage(nodes, "nodes"), subroots, bytes(root.digest).hex())


def _fold(start: str, siblings: str, idx: str) -> str:
    """SQL that folds a digest with siblings: on the left where the bit of the place is 1, alone where there is none."""
    near = f"coalesce(lower(hex({siblings}[k])), '')"
    odd = f"(shiftright({idx}, k) & 1) = 1"
    return f"""case when size({siblings}) = 0 then {start} else unhex(aggregate(sequence(0, size({siblings}) - 1), lower(hex({start})), (h, k) ->
        sha2(concat(if({odd}, {near}, ''), h, if({odd}, '', {near})), 256))) end"""


def _flat(siblings: str) -> str:
    return f"aggregate({siblings}, X'', (a, s) -> concat(a, coalesce(s, X'')))"


def climb(manifest: Manifest, candidate: str, keep: list[str]) -> DataFrame:
    """Ascend from every leaf with the digest in column ``candidate`` (hex; null: its own): ``keep, tree, digest, proof_sha256, folded_root``.

    ``proof_sha256`` is the hash of all siblings from leaf to root. The query's rows are written before it
    returns, since its row limit has to be off while it runs.
    """
    spark = manifest.leaves.sparkSession
    start = manifest.leaves.selectExpr(f"named_struct({', '.join(f'{c!r}, row.`{c}`' for c in keep)}) as kept", "digest as own", "tree as home", "xxhash64(tree, idx) as h", "idx as at", f"coalesce(unhex(row.`{candidate}`), digest) as start", "siblings as around", "parent_tree", "parent_step", "parent_idx", "parent_copies")
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    hint = "/*+ broadcast(n) */" if small(manifest.nodes, BROADCAST_NODES) else ""
    try:
        done = spark.sql(
            f"""
            with recursive climb(kept, own, home, h, tree, step, idx, salt, folded, proof) as (
              select kept, own, home, h, parent_tree, parent_step, parent_idx, cast(pmod(h, parent_copies) as int), {_fold("start", "around", "at")}, {_flat("around")} from {{start}}
              union all
              select {hint} c.kept, c.own, c.home, c.h, n.parent_tree, n.parent_step, n.parent_idx, cast(pmod(c.h, n.parent_copies) as int),
                {_fold("c.folded", "n.siblings", "n.idx")}, concat(c.proof, {_flat("n.siblings")})
              from climb c join {{nodes}} n on c.tree = n.tree and c.step = n.step and c.idx = n.idx and c.salt = n.salt)
            select kept.*, home as tree, lower(hex(own)) as digest, sha2(lower(hex(proof)), 256) as proof_sha256, lower(hex(folded)) as folded_root
            from climb where tree is null
            """,
            start=start, nodes=manifest.nodes,
        )
        return stage(done, "climbed")
    finally:
        spark.conf.set(limit, before)


def verify(rows: DataFrame, group: Column, candidate: str, doc_id: str = "doc_id", leaf_digest: str = "leaf") -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: whether ``candidate`` folds to the root that the leaves have."""
    changed = F.when(F.col(candidate) != F.col(leaf_digest), F.col(candidate))
    manifest = build_manifest(rows.select(F.col(doc_id).alias("doc_id"), group.alias("group"), F.col(leaf_digest).alias("leaf"), changed.alias("candidate")), F.col("group"))
    schema = f"doc_id {rows.schema[doc_id].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if manifest.root is None:
        return rows.sparkSession.createDataFrame([], schema)
    climbed = climb(manifest, "candidate", ["doc_id"])
    subroots = F.broadcast(manifest.subroots) if small(manifest.subroots, BROADCAST_ROWS) else manifest.subroots
    return climbed.join(subroots, "tree").select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(manifest.root).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(manifest.root)).alias("verified"),
    )
