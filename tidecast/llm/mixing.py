"""Mixing sources to target weights by weighted fair queueing, in SQL functions only.

Documents of a source wait in a shuffled queue that is passed through ``max_repeats`` times. A copy that
ends ``w`` words into its source's queue gets the virtual finish time ``w / target``, so at time 1 every
source has given exactly its target. The copies of all sources are sorted by that time and cut at the
budget. All sums over a queue are taken in two steps: totals of small buckets first, then within a
bucket, so neither a large source nor the global order ends up in one task.

A document's size is the number of its words ``[^\\x20\\x09-\\x0D]+``; null or empty text has size 0 and
is never taken. Null is a source of its own, the last one. Rows that repeat a document id queue
separately. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.staging import small, stage

WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which the table of sources is broadcast; beyond that it is joined by a shuffle.
BROADCAST_SOURCES = 20_000
#: Queue buckets are prefixes of the shuffle key of so many hexadecimal digits.
KEY_DIGITS = 3
#: Equal slices of virtual time up to 1; the logarithm of later times is cut alike, so there are few.
TIME_SLICES = 4096


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size`` of every document."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"))


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, max_repeats: int) -> DataFrame:
    """``source, source_size, target`` with the excess over ``max_repeats`` sizes shared out again.

    Sources are filled in the order in which they reach their limits, so the level that the others
    stop at is a running sum.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("_w", F.element_at(F.lit(list(weights)), (nth % len(weights) + 1).cast("int")))
    per = per.withColumn("_limit", (F.col("source_size") * max_repeats).cast("double"))
    order = Window.orderBy(F.col("_limit") / F.col("_w"), F.col("source").asc_nulls_last())
    filled = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.withColumn("_level", (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("_limit").over(filled), F.lit(0.0)))
                         / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(filled), F.lit(0.0))))
    # The level rises with every source that its limit stops and falls after the first that it doesn't.
    per = per.withColumn("_stop", F.max("_level").over(everything))
    target = F.least(F.col("_limit"), F.col("_stop") * F.col("_w"))
    return per.select("source", "source_size", target.alias("target"), F.sum("source_size").over(everything).alias("_total"))


def with_targets(df: DataFrame, per: DataFrame) -> DataFrame:
    """Join on the source, null included."""
    side = per.withColumnRenamed("source", "_source")
    if small(per, BROADCAST_SOURCES):
        side = F.broadcast(side)
    return df.join(side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def running(group: list[str | Column], bucket: str, order: list[str], value: str) -> tuple[Column, Column]:
    """Sum within a bucket up to a row, and the window of the buckets before it."""
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return F.sum(value).over(inside), F.coalesce(F.sum("_n").over(before), F.lit(0))


def queue(
    docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, max_repeats: int = 2, seed: int = 7,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """All documents with size and target, and the mix: ``doc_id, source, repeat, finish, position``.

    ``position`` counts the words of the mix before a copy; copies in its order are the training order.
    """
    sizes = stage(sized(docs, doc_id, text, source), "sizes")
    per = stage(targets(sizes, weights, share, max_repeats), "targets")
    every = with_targets(sizes, per)
    key = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(str(seed))).cast("binary"))
    waiting = every.where("size > 0").withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, KEY_DIGITS))
    inside, before = running(["source"], "_bucket", ["_key", "doc_id", "size"], "size")
    starts = waiting.groupBy("source", "_bucket").agg(F.sum("size").alias("_n")).withColumn("_first", before)
    starts = starts.select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), "_first")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b"))
    queued = waiting.withColumn("_end", inside).join(starts, same)
    queued = queued.withColumn("end", F.col("_end") + F.col("_first"))
    copies = queued.select("doc_id", "source", "size", "end", "target", "source_size", "_total",
                           F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("repeat"))
    finish = (F.col("end") + F.col("repeat") * F.col("source_size")) / F.col("target")
    # At time 1 all sources have given their targets; the slices of later times get longer and longer.
    late = TIME_SLICES + F.floor(F.log2(F.greatest(F.col("finish"), F.lit(1.0))) * TIME_SLICES)
    slices = F.when(F.col("finish") < 1, F.floor(F.col("finish") * TIME_SLICES)).otherwise(late)
    copies = copies.withColumn("finish", finish).withColumn("_slice", slices)
    copies = stage(copies, "copies")
    inside, before = running([], "_slice", ["finish", "source", "end", "doc_id"], "size")
    offsets = copies.groupBy("_slice").agg(F.sum("size").alias("_n")).select(F.col("_slice").alias("_t"), before.alias("_first"))
    ordered = copies.withColumn("_in", inside).join(F.broadcast(offsets), F.col("_slice") == F.col("_t"))
    ordered = ordered.withColumn("_upto", F.col("_in") + F.col("_first"))
    mix = ordered.where(F.col("_upto") <= F.floor(F.col("_total") * share))
    return every, mix.select("doc_id", "source", "size", "repeat", "finish", (F.col("_upto") - F.col("size")).alias("position"), "end")


_SAME = ("doc_id", "source", "size")


def copies(mix: DataFrame) -> DataFrame:
    """``_d, _s, _z, _nth, _n``: the copies that the mix takes of the ``_nth`` document of an id, source and size.

    A document is known by its source and its place in that queue, so repeated ids stay apart; those of
    equal id, source and size are interchangeable, and the first of them gets the most.
    """
    counts = mix.groupBy("doc_id", "source", "end").agg(F.count("*").alias("_n"), F.first("size").alias("size"))
    nth = F.row_number().over(Window.partitionBy(*_SAME).orderBy(F.col("_n").desc(), "end"))
    return counts.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"), nth.alias("_nth"), "_n")


def _with_copies(docs: DataFrame, got: DataFrame, how: str) -> DataFrame:
    numbered = docs.withColumn("_k", F.row_number().over(Window.partitionBy(*_SAME).orderBy(F.lit(0))))
    same = (F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s"))
            & (F.col("size") == F.col("_z")) & (F.col("_k") == F.col("_nth")))
    return numbered.join(got, same, how)


def taken(every: DataFrame, mix: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every document."""
    amount = F.coalesce(F.col("_n") * F.col("size"), F.lit(0))
    rows = _with_copies(every, copies(mix), "left")
    return rows.select("doc_id", "source", "size", "source_size", "target", amount.alias("taken"))


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it."""
    _, mix = queue(docs, doc_id=doc_id, text=text, source=source, **settings)
    own = docs.select(
        F.struct("*").alias("_row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    rows = _with_copies(own, stage(copies(mix), "mix"), "inner")
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select("_row.*")
