"""Pooled boosted trees: distributed fit, batch scoring, and the node table of a fitted model."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.config import SERIES_FEATURES, SETTINGS, TREE_FEATURES
from tidecast.session import ensure_checkpoint_dir, scratch_path

VECTOR = "_features"


def _values(columns: list[str]) -> list[Column]:
    absent = set(SERIES_FEATURES) - set(columns)
    return [F.lit(0.0) if c in absent else F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in TREE_FEATURES]


def assemble(df: DataFrame) -> DataFrame:
    """Feature vector of ``TREE_FEATURES``; a missing value counts as 0, and so does a series feature that is not there."""
    ready = df.withColumns({f"_x_{c}": x for c, x in zip(TREE_FEATURES, _values(df.columns))})
    names = [f"_x_{c}" for c in TREE_FEATURES]
    return VectorAssembler(inputCols=names, outputCol=VECTOR).transform(ready).drop(*names)


def fit_trees(
    df: DataFrame,
    target: str = "orders",
    rounds: int = SETTINGS.boosting_rounds,
    step: float = SETTINGS.boosting_step,
    depth: int = SETTINGS.tree_depth,
    seed: int = SETTINGS.random_seed,
) -> GBTRegressionModel:
    """One model over all series. The encoding and the series features tell the series apart.

    The rows are read a few times to find split candidates and to bin the values; the rounds then
    run on the binned rows, which the estimator keeps itself. Best given a stored feature table.
    """
    ensure_checkpoint_dir(df.sparkSession)
    train = assemble(df.where(F.col(target).isNotNull())).select(
        VECTOR, F.col(target).cast("double").alias("_label")
    )
    return GBTRegressor(
        featuresCol=VECTOR,
        labelCol="_label",
        predictionCol="tree_pred",
        maxIter=rounds,
        stepSize=step,
        maxDepth=depth,
        seed=seed,
        checkpointInterval=10,
    ).fit(train)


def predict_trees(model: GBTRegressionModel, df: DataFrame) -> DataFrame:
    """Add ``tree_pred``."""
    return model.transform(assemble(df)).drop(VECTOR)


def node_table(spark: SparkSession, model: GBTRegressionModel) -> DataFrame:
    """(tree, weight, id, left, right, feature, threshold, value, rows) of every node.

    Read from the model's saved form. Its size is bounded by rounds * 2^(depth + 1) rows.
    """
    path = scratch_path(spark, "trees")
    model.save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").select(
        F.col("_1").alias("treeID"), F.col("_3").alias("weight")
    )
    node = spark.read.parquet(f"{path}/data").join(weights, "treeID")
    return node.select(
        F.col("treeID").alias("tree"),
        "weight",
        "nodeData.id",
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.rawCount").alias("rows"),
    )


@dataclass
class Nodes:
    """The node table as arrays, small enough to travel with a Python function."""

    roots: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    @classmethod
    def of(cls, table: DataFrame) -> Nodes:
        pdf = table.toPandas().sort_values(["tree", "id"], ignore_index=True)
        sizes = pdf.groupby("tree").size()
        start = sizes.cumsum() - sizes
        offset = pdf["tree"].map(start).to_numpy()
        leaf = (pdf["left"] < 0).to_numpy()
        return cls(
            roots=start.to_numpy(),
            left=np.where(leaf, -1, pdf["left"].to_numpy() + offset),
            right=np.where(leaf, -1, pdf["right"].to_numpy() + offset),
            feature=np.where(leaf, -1, pdf["feature"].to_numpy()),
            threshold=pdf["threshold"].fillna(0.0).to_numpy(),
            value=(pdf["value"] * pdf["weight"]).to_numpy(),
            rows=pdf["rows"].to_numpy(dtype=float),
        )

    def score(self, x: np.ndarray) -> np.ndarray:
        """Sum of the reached leaves for every row of x."""
        at = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        while (inner := self.left[at] >= 0).any():
            go_left = x[row, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(inner, np.where(go_left, self.left[at], self.right[at]), at)
        return self.value[at].sum(axis=1)

    def leaves(self) -> Iterator[tuple[float, dict[int, list[float]]]]:
        """Every leaf: its value and per split feature [low, high, share of training rows kept]."""
        todo = [(int(r), {}) for r in self.roots]
        while todo:
            at, path = todo.pop()
            if self.left[at] < 0:
                yield float(self.value[at]), path
                continue
            f, cut = int(self.feature[at]), float(self.threshold[at])
            low, high, share = path.get(f, [-np.inf, np.inf, 1.0])
            left, right = int(self.left[at]), int(self.right[at])
            todo.append((left, {**path, f: [low, min(high, cut), share * self.rows[left] / self.rows[at]]}))
            todo.append((right, {**path, f: [max(low, cut), high, share * self.rows[right] / self.rows[at]]}))


def attribute(nodes: Nodes, x: np.ndarray) -> tuple[np.ndarray, float]:
    """Shapley values of the tree ensemble for every row of x, and the expected prediction.

    A leaf contributes its value when every split feature on its path lets the row pass; a feature
    that is left out passes with the share of training rows that took the path. For d features the
    Shapley weight of a coalition of k others is k! (d-k-1)! / d!, and the sum over coalitions of one
    size is a coefficient of the product of (share_j + pass_j t).
    """
    phi = np.zeros((len(x), len(TREE_FEATURES)))
    base = 0.0
    for value, path in nodes.leaves():
        used = list(path)
        share = np.array([path[f][2] for f in used])
        base += value * share.prod()
        d = len(used)
        if d == 0:
            continue
        passes = np.stack([(x[:, f] > path[f][0]) & (x[:, f] <= path[f][1]) for f in used], axis=1).astype(float)
        weight = np.ones(d)
        for k in range(1, d):
            weight[k] = weight[k - 1] * k / (d - k)
        weight /= d
        for i, f in enumerate(used):
            coeff = np.zeros((len(x), d))
            coeff[:, 0] = 1.0
            for j in range(d):
                if j != i:
                    shifted = np.zeros_like(coeff)
                    shifted[:, 1:] = coeff[:, :-1] * passes[:, [j]]
                    coeff = coeff * share[j] + shifted
            phi[:, f] += value * (passes[:, i] - share[i]) * (coeff @ weight)
    return phi, base


def with_attributions(df: DataFrame, nodes: Nodes, batch_rows: int = 4096) -> DataFrame:
    """Add ``attributions`` (array aligned with TREE_FEATURES) and ``base_value``."""
    base = float(attribute(nodes, np.zeros((1, len(TREE_FEATURES))))[1])

    @F.pandas_udf("array<double>")
    def explain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if len(batch) == 0:
                yield pd.Series([], dtype=object)
                continue
            x = np.stack(batch.to_numpy())
            parts = [attribute(nodes, x[i : i + batch_rows])[0] for i in range(0, len(x), batch_rows)]
            yield pd.Series(list(np.concatenate(parts)))

    values = F.array(*_values(df.columns))
    return df.withColumn("attributions", explain(values)).withColumn("base_value", F.lit(base))
