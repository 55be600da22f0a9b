"""Isolation forest on one numeric column.

A tree on one column is a step function of the value, so the whole forest is one step function:
at most ``trees * (sample_size - 1)`` breakpoints, whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EULER_GAMMA = 0.5772156649015329
#: A draw of about twice the wanted sample is ranked to get exactly ``sample_size`` rows.
OVERDRAW = 2.0


def expected_depth(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


@dataclass
class IsolationForest:
    """Right-closed steps: ``score[i]`` holds for values in (edges[i-1], edges[i]]."""

    edges: np.ndarray
    scores: np.ndarray
    offset: float

    def transform(self, df: DataFrame, value: str, out: str = "forest_score") -> DataFrame:
        """Add the decision score; negative means anomalous."""
        edges, scores, offset = self.edges, self.scores, self.offset

        @F.pandas_udf("double")
        def decide(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                x = batch.to_numpy(dtype=float)
                step = np.searchsorted(edges, x, side="left")
                yield pd.Series(np.where(np.isnan(x), np.nan, scores[step] - offset))

        return df.withColumn(out, F.nanvl(decide(F.col(value).cast("double")), F.lit(None).cast("double")))

    def steps_frame(self, spark: SparkSession) -> DataFrame:
        pdf = pd.DataFrame({"edge": np.append(self.edges, np.inf), "score": self.scores})
        return spark.createDataFrame(pdf, "edge double, score double")

    @classmethod
    def from_steps(cls, steps: DataFrame, offset: float) -> IsolationForest:
        pdf = steps.toPandas().sort_values("edge")  # bounded by trees * sample_size
        return cls(pdf["edge"].to_numpy()[:-1], pdf["score"].to_numpy(), offset)


def _uniform(*columns: Column) -> Column:
    """Hash of the columns as a number in [0, 1)."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 53)) / F.lit(float(1 << 53))


def tree_samples(
    df: DataFrame,
    identity: tuple[str, ...],
    value: str,
    trees: int,
    sample_size: int,
    seed: int,
    rows: int | None = None,
) -> DataFrame:
    """(tree, value): ``sample_size`` rows per tree, drawn without replacement by seeded hashes.

    Every row draws for every tree, and is copied only to the trees that drew it: about ``OVERDRAW``
    times the sample of each, whatever the size of the data.
    """
    ident = [F.col(c).cast("string") for c in identity]
    known = df.where(F.col(value).isNotNull())
    n = known.count() if rows is None else rows
    keep = min(1.0, OVERDRAW * sample_size / max(n, 1))
    row = F.xxhash64(*ident)
    drew = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: _uniform(F.col("row"), tree, F.lit(seed)) < keep)
    drawn = (
        known.select(F.col(value).cast("double").alias("value"), row.alias("row"))
        .withColumn("tree", F.explode(drew))
        .withColumn("draw", _uniform(F.col("row"), F.col("tree"), F.lit(seed)))
    )
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("draw", "row"))
    return drawn.withColumn("rank", rank).where(F.col("rank") <= sample_size).select("tree", "value")


def _grow(values: np.ndarray, rng: np.random.Generator) -> list[tuple[float, float]]:
    """Steps (right edge, path length) of one random tree."""
    limit = int(np.ceil(np.log2(max(len(values), 2))))
    steps: list[tuple[float, float]] = []
    todo = [(np.sort(values), 0, np.inf)]
    while todo:
        points, depth, right = todo.pop()
        if depth >= limit or len(points) <= 1 or points[0] == points[-1]:
            steps.append((right, depth + expected_depth(len(points))))
            continue
        cut = rng.uniform(points[0], points[-1])
        at = np.searchsorted(points, cut, side="right")
        todo.append((points[at:], depth + 1, right))
        todo.append((points[:at], depth + 1, cut))
    return steps


def fit(
    df: DataFrame,
    identity: tuple[str, ...],
    value: str,
    trees: int,
    sample_size: int,
    contamination: float,
    seed: int,
    rows: int | None = None,
) -> IsolationForest:
    """Grow the trees in parallel, merge their steps, and place the offset at the contamination."""

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["value"].to_numpy()
        steps = _grow(values, np.random.default_rng([seed, int(key[0])]))
        out = pd.DataFrame(steps, columns=["edge", "length"])
        return out.assign(tree=int(key[0]), norm=expected_depth(len(values)))

    samples = tree_samples(df, identity, value, trees, sample_size, seed, rows)
    grown = samples.groupBy("tree").applyInPandas(
        grow, "edge double, length double, tree int, norm double"
    )
    steps = grown.toPandas()  # at most trees * sample_size rows
    if steps.empty:
        raise ValueError("no values to fit an isolation forest on")
    edges = np.unique(steps["edge"].to_numpy())
    edges = edges[np.isfinite(edges)]
    length = np.zeros(len(edges) + 1)
    norm, grown_trees = 0.0, 0
    for _, tree in steps.groupby("tree"):
        tree = tree.sort_values("edge")
        at = np.searchsorted(tree["edge"].to_numpy(), np.append(edges, np.inf), side="left")
        length += tree["length"].to_numpy()[at]
        norm += tree["norm"].iloc[0]
        grown_trees += 1
    mean_norm = max(norm / grown_trees, 1e-12)
    forest = IsolationForest(edges, -np.exp2(-(length / grown_trees) / mean_norm), 0.0)
    forest.offset = _contamination_offset(forest, df, value, contamination)
    return forest


def _contamination_offset(
    forest: IsolationForest, df: DataFrame, value: str, contamination: float
) -> float:
    """Exact interpolated percentile of the scores; they take at most one value per step."""
    scored = forest.transform(df.where(F.col(value).isNotNull()).select(value), value, "score")
    counts = scored.groupBy("score").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("score")
    upto = counts["n"].cumsum().to_numpy()
    scores = counts["score"].to_numpy()
    rank = contamination * (upto[-1] - 1)
    low = scores[np.searchsorted(upto, np.floor(rank), side="right")]
    high = scores[np.searchsorted(upto, np.ceil(rank), side="right")]
    return float(low + (high - low) * (rank - np.floor(rank)))
