"""Boosted trees on the pinball loss: conditional quantiles of residuals.

A round fits one small tree per quantile to the gradient of the pinball loss, and then gives every leaf the
exact quantile of what is left in it, as boosting on that loss does. Trees are grown by Spark; a leaf's
quantile comes from counts by ranges, so no task holds the rows of a leaf. What is kept of a model is its
nodes, at most rounds * 2^(depth + 1) for each quantile, as expressions for Spark or as arrays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.config import SETTINGS, TREE_FEATURES
from tidecast.functions.quantiles import quantiles, value_counts
from tidecast.operators import trees

NODE_SCHEMA = "alpha double, tree int, id int, left int, right int, feature int, threshold double, value double"


@dataclass
class QuantileTrees:
    """Nodes of all trees: (alpha, tree, id, left, right, feature, threshold, value); leaves have -1 for the first three links."""

    alphas: tuple[float, ...]
    rows: list[tuple] = field(default_factory=list)

    def _trees(self, alpha: float) -> list[dict[int, tuple]]:
        found: dict[int, dict[int, tuple]] = {}
        for a, tree, *node in self.rows:
            if a == alpha:
                found.setdefault(tree, {})[node[0]] = tuple(node)
        return [found[t] for t in sorted(found)]

    def column(self, alpha: float) -> Column:
        """The correction as an expression over the feature columns; a missing value counts as 0."""

        def walk(nodes: dict[int, tuple], at: int) -> Column:
            _, left, right, feature, threshold, value = nodes[at]
            if left < 0:
                return F.lit(float(value))
            x = F.coalesce(F.col(TREE_FEATURES[feature]).cast("double"), F.lit(0.0))
            return F.when(x <= F.lit(float(threshold)), walk(nodes, left)).otherwise(walk(nodes, right))

        total = F.lit(0.0)
        for nodes in self._trees(alpha):
            total = total + walk(nodes, 0)
        return total

    def scorer(self, alpha: float) -> Callable[[np.ndarray], np.ndarray]:
        """The correction as a function of feature rows, for use inside tasks."""
        parts = self._trees(alpha)
        if not parts:
            return lambda x: np.zeros(len(x))
        first = np.cumsum([0, *(len(p) for p in parts)])
        table = np.array([n for p in parts for _, n in sorted(p.items())], dtype=float)
        base = np.repeat(first[:-1], np.diff(first))
        leaf = table[:, 1] < 0
        link = [np.where(leaf, -1, table[:, k].astype(int) + base) for k in (1, 2)]
        nodes = trees.Nodes(first[:-1], *link, table[:, 3].astype(int), table[:, 4], table[:, 5], np.ones(len(table)))
        return nodes.score

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, NODE_SCHEMA)

    @classmethod
    def of(cls, table: DataFrame, alphas: tuple[float, ...]) -> QuantileTrees:
        return cls(alphas, [tuple(r) for r in table.collect()])


def _nodes(model) -> list[list]:
    """[id, left, right, feature, threshold, value] of a fitted tree, parents before children, and leaves from left to right."""
    out: list[list] = []

    def visit(node) -> int:
        at = len(out)
        if node.getClass().getSimpleName() == "LeafNode":
            out.append([at, -1, -1, -1, 0.0, 0.0])
            return at
        split = node.split()
        out.append([at, 0, 0, int(split.featureIndex()), float(split.threshold()), 0.0])
        out[at][1], out[at][2] = visit(node.leftChild()), visit(node.rightChild())
        return at

    visit(model._java_obj.rootNode())
    return out


def fit_quantile_trees(
    df: DataFrame,
    alphas: tuple[float, ...],
    store: Callable[[DataFrame], DataFrame],
    residual: str = "residuals",
    start: str = "quantiles",
    rounds: int = SETTINGS.band_rounds,
    step: float = SETTINGS.band_step,
    depth: int = SETTINGS.band_depth,
    min_rows: int = 20,
    seed: int = SETTINGS.random_seed,
) -> QuantileTrees:
    """Corrections to the quantiles in the array column ``start`` that bring them to those of ``residual`` given the features.

    ``store`` writes a frame and reads it back; every round reads what the one before has left. Leaves have at least ``min_rows`` rows.
    Without rows there are no corrections.
    """
    left = [(F.col(residual) - F.col(start)[i]).alias(f"_r{i}") for i in range(len(alphas))]
    rows = store(trees.assemble(df.where(F.col(residual).isNotNull())).select(trees.VECTOR, *left))
    model = QuantileTrees(tuple(alphas))
    if rows.isEmpty():
        return model

    def grow(job: tuple[int, int]) -> tuple[int, list[list], DataFrame]:
        i, turn = job
        slope = F.lit(alphas[i]) - (F.col(f"_r{i}") < 0).cast("double")
        tree = DecisionTreeRegressor(
            featuresCol=trees.VECTOR, labelCol="_g", leafCol="_leaf", predictionCol="_p", maxDepth=depth,
            minInstancesPerNode=min_rows, seed=seed + turn,
        ).fit(rows.select(trees.VECTOR, slope.alias("_g")))
        placed = tree.transform(rows.select(trees.VECTOR, f"_r{i}")).select("_leaf", f"_r{i}")
        found = quantiles(value_counts(placed, ["_leaf"], f"_r{i}"), ["_leaf"], [alphas[i]])
        values = {int(r["_leaf"]): step * r["quantiles"][0] for r in found.collect()}
        nodes = _nodes(tree)
        leaves = [n for n in nodes if n[1] < 0]
        for k, node in enumerate(leaves):
            node[5] = values.get(k, 0.0)
        return i, nodes, tree

    with ThreadPool(len(alphas)) as pool:
        for turn in range(rounds):
            for i, nodes, tree in pool.map(grow, [(i, turn) for i in range(len(alphas))]):
                model.rows += [(float(alphas[i]), turn, *node) for node in nodes]
                value = F.lit(0.0)
                for k, node in enumerate(n for n in nodes if n[1] < 0):
                    value = F.when(F.col(f"_leaf{i}") == k, node[5]).otherwise(value)
                rows = tree.setLeafCol(f"_leaf{i}").transform(rows).drop("_p")
                rows = rows.withColumn(f"_r{i}", F.col(f"_r{i}") - value).drop(f"_leaf{i}")
            if turn + 1 < rounds:
                rows = store(rows)
    return model
