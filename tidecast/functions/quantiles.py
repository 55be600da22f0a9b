"""Exact linear-interpolated quantiles that never hold a group in one aggregation buffer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n): combined on the map side, so repeated values shrink before the shuffle."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _bucket(value: Column) -> Column:
    """An order-preserving whole number: 64 steps for each doubling of the magnitude."""
    return F.floor(F.signum(value) * F.log2(1 + F.abs(value)) * 64)


def _values_at(counts: DataFrame, keys: list[str], ranks: list[Callable[[Column], Column]]) -> DataFrame:
    """(keys, n_rows, at_0, at_1, ...): the values at ranks (from 0), each a function of the key's number of rows.

    Values are counted by ranges first. The running count over a key's ranges tells in which of them the
    wanted ranks lie, and only those are ranked value by value. So no task sorts all values of a key;
    Spark's ``percentile`` would even keep them all in memory.
    """
    placed = counts.select(*keys, "value", "n", _bucket(F.col("value")).alias("_bucket"))
    by_key = Window.partitionBy(*keys)
    running = by_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (
        placed.groupBy(*keys, "_bucket")
        .agg(F.sum("n").alias("_size"))
        .withColumn("_upto", F.sum("_size").over(running))
        .withColumn("total", F.sum("_size").over(by_key))
        .withColumn("_before", F.col("_upto") - F.col("_size"))
    )
    wanted = F.array(*[rank(F.col("total")) for rank in ranks])
    holds = F.exists(wanted, lambda r: (F.col("_before") <= r) & (r < F.col("_upto")))
    ranges = ranges.where(holds).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_bucket").alias("_wanted"), "_before", "total")
    same = F.col("_bucket") == F.col("_wanted")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.join(ranges, same).select(
        *keys, "value", (F.col("_before") + F.sum("n").over(inside)).alias("upto"), "total"
    )
    picks = [F.min(F.when(F.col("upto") > rank(F.col("total")), F.col("value"))).alias(f"at_{i}") for i, rank in enumerate(ranks)]
    return ranked.groupBy(*keys).agg(F.first("total").alias("n_rows"), *picks)


def quantiles(counts: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """(keys, n_rows, quantiles array) from ``value_counts``, interpolated between neighbouring values."""
    ranks = [lambda total, p=p, f=f: f((total - 1) * F.lit(float(p))) for p in probs for f in (F.floor, F.ceil)]

    def interpolated(i: int, p: float):
        rank = (F.col("n_rows") - 1) * F.lit(float(p))
        low, high = F.col(f"at_{2 * i}"), F.col(f"at_{2 * i + 1}")
        return low + (high - low) * (rank - F.floor(rank))

    return _values_at(counts, keys, ranks).select(
        *keys,
        "n_rows",
        F.array(*[interpolated(i, p) for i, p in enumerate(probs)]).alias("quantiles"),
    )


def scaled_quantiles(counts: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """(keys, n_rows, quantiles array): the edges of ``parts`` equal parts, each times ``parts``.

    A rank (n - 1) * i / parts is split by whole-number division, so for whole values the scaled edges are whole
    and a value on an edge is told exactly: ``parts * value >= edge``.
    """
    place = lambda total, i: (total - 1) * F.lit(i)
    low = [lambda total, i=i: ((place(total, i) - place(total, i) % parts) / parts).cast("long") for i in range(parts + 1)]
    ranks = [rank for first in low for rank in (first, lambda total, f=first: F.least(f(total) + 1, total - 1))]

    def edge(i: int):
        low, high = F.col(f"at_{2 * i}"), F.col(f"at_{2 * i + 1}")
        return low * parts + (high - low) * (place(F.col("n_rows"), i) % parts)

    return _values_at(counts, keys, ranks).select(*keys, "n_rows", F.array(*[edge(i) for i in range(parts + 1)]).alias("quantiles"))
