"""Data drift (population stability index) and performance drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.config import SETTINGS
from tidecast.functions.quantiles import scaled_quantiles, value_counts

BINS = 10
FLOOR = 1e-6


def population_stability(
    new: DataFrame,
    baseline: DataFrame,
    value: str = "orders",
    key: str = "city",
    threshold: float = SETTINGS.psi_threshold,
) -> DataFrame:
    """PSI per series over the baseline's deciles: (key, psi, drifted).

    Both sides shrink to value counts before they meet; a series missing on one side is skipped.
    """
    base_counts = value_counts(baseline, [key], value)
    new_counts = value_counts(new, [key], value)
    # Edges times BINS: whole for whole values, so a value on an edge is never off by a rounding error.
    deciles = scaled_quantiles(base_counts, [key], BINS)
    edges = deciles.select(key, F.array_distinct("quantiles").alias("edges"))
    both = base_counts.withColumn("is_new", F.lit(False)).unionByName(
        new_counts.withColumn("is_new", F.lit(True))
    )
    degenerate = F.size("edges") < 2
    inner = F.expr("slice(edges, 2, greatest(size(edges) - 2, 0))")
    placed = both.join(edges, key).select(
        key,
        "is_new",
        "n",
        F.when(degenerate, F.lit(1)).otherwise(F.size("edges") - 1).alias("bins"),
        # A constant baseline has the single bin [0, inf): negatives fall out of it.
        F.when(degenerate, F.when(F.col("value") >= 0, F.lit(0)))
        .otherwise(F.size(F.filter(inner, lambda e: e <= BINS * F.col("value"))))
        .alias("bin"),
    )

    def count(side: bool, b: int | None):
        hit = F.col("is_new") == side
        if b is not None:
            hit = hit & (F.col("bin") == b)
        return F.sum(F.when(hit, F.col("n")).otherwise(0))

    aggs = [F.first("bins").alias("bins")]
    for side, name in ((False, "base"), (True, "new")):
        aggs.append(count(side, None).alias(f"{name}_total"))
        aggs += [count(side, b).alias(f"{name}_{b}") for b in range(BINS)]
    tallied = placed.groupBy(key).agg(*aggs).where((F.col("base_total") > 0) & (F.col("new_total") > 0))
    psi = F.lit(0.0)
    for b in range(BINS):
        p = F.greatest(F.col(f"base_{b}") / F.col("base_total"), F.lit(FLOOR))
        q = F.greatest(F.col(f"new_{b}") / F.col("new_total"), F.lit(FLOOR))
        psi = psi + F.when(F.col("bins") > b, (q - p) * F.ln(q / p)).otherwise(0.0)
    return tallied.select(key, psi.alias("psi")).withColumn("drifted", F.col("psi") > threshold)


def performance_drift(
    rolling: DataFrame,
    threshold: float = SETTINGS.drift_threshold,
    streak: int = SETTINGS.drift_streak,
    ts: str = "date",
) -> DataFrame:
    """One row (days, min_mape, drift): the newest ``streak`` values all above the threshold."""
    newest = rolling.orderBy(F.desc(ts)).limit(streak)
    facts = newest.agg(F.count(F.lit(1)).alias("days"), F.min("rolling_mape").alias("min_mape"))
    all_over = (F.col("days") >= streak) & (F.col("min_mape") > threshold)
    return facts.withColumn("drift", F.coalesce(all_over, F.lit(False)))


def drift_history(
    rolling: DataFrame,
    threshold: float = SETTINGS.drift_threshold,
    streak: int = SETTINGS.drift_streak,
    key: str | None = None,
    ts: str = "date",
) -> DataFrame:
    """For every day whether a breach streak is complete. Input: one row per day (and series)."""
    window = Window.partitionBy(*([key] if key else [])).orderBy(ts).rowsBetween(-(streak - 1), 0)
    return (
        rolling.withColumn("_n", F.count("rolling_mape").over(window))
        .withColumn("_m", F.min("rolling_mape").over(window))
        .withColumn("drift", (F.col("_n") >= streak) & (F.col("_m") > threshold))
        .drop("_n", "_m")
    )
