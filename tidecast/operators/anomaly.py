"""Residual anomalies: baseline, z-score, isolation signal, severity, class and evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.config import SETTINGS
from tidecast.operators import isolation


def add_residuals(df: DataFrame, actual: str = "orders", pred: str = "pred_orders") -> DataFrame:
    return df.withColumn("residuals", F.col(actual).cast("double") - F.col(pred))


def residual_baseline(
    df: DataFrame, by: list[str] | None = None, residual: str = "residuals"
) -> DataFrame:
    """Mean and population standard deviation (at least 1e-6) of the residuals, pooled or per group."""
    return df.groupBy(*(by or [])).agg(
        F.avg(residual).alias("res_mean"),
        F.greatest(F.stddev_pop(residual), F.lit(1e-6)).alias("res_std"),
    )


def with_zscore(
    df: DataFrame, baseline: DataFrame, by: list[str] | None = None, residual: str = "residuals"
) -> DataFrame:
    """Add ``z_score``. The pooled baseline is one scalar; a grouped one is joined on its key."""
    if by:
        return (
            df.join(baseline, by, "left")
            .withColumn("z_score", F.abs((F.col(residual) - F.col("res_mean")) / F.col("res_std")))
            .drop("res_mean", "res_std")
        )
    fitted = baseline.select(F.struct("res_mean", "res_std").alias("b")).scalar()
    return (
        df.withColumn("_b", fitted)
        .withColumn("z_score", F.abs((F.col(residual) - F.col("_b.res_mean")) / F.col("_b.res_std")))
        .drop("_b")
    )


def combine_signals(z_flag: Column, forest_flag: Column | None, strict: bool) -> Column:
    """Strict: both signals; otherwise either one."""
    if forest_flag is None:
        return z_flag
    return (z_flag & forest_flag) if strict else (z_flag | forest_flag)


def anomaly_type(flag: Column, residual: Column) -> Column:
    return F.when(flag & (residual >= 0), "surge").when(flag, "dip").otherwise("normal")


def detect_zscore(
    df: DataFrame,
    baseline: DataFrame | None = None,
    threshold: float = SETTINGS.z_threshold,
    by: list[str] | None = None,
    residual: str = "residuals",
) -> DataFrame:
    """Detector without the isolation signal: z_score, is_anomaly, anomaly_type."""
    baseline = residual_baseline(df, by, residual) if baseline is None else baseline
    flag = F.coalesce(F.col("z_score") >= threshold, F.lit(False))
    return (
        with_zscore(df, baseline, by, residual)
        .withColumn("is_anomaly", flag)
        .withColumn("anomaly_type", anomaly_type(F.col("is_anomaly"), F.col(residual)))
    )


@dataclass
class HybridDetector:
    """Z-score and isolation forest on residuals. The fitted state is two small tables."""

    contamination: float = SETTINGS.contamination
    z_threshold: float = SETTINGS.z_threshold
    strict: bool = False
    seed: int = SETTINGS.random_seed
    trees: int = 100
    sample_size: int = 256
    baseline: DataFrame | None = None
    forest: isolation.IsolationForest | None = None

    def _fitted(self) -> None:
        if self.baseline is None or self.forest is None:
            raise RuntimeError("fit or load the detector before using it")

    def fit(
        self, df: DataFrame, identity: tuple[str, ...] = ("city", "date"), residual: str = "residuals"
    ) -> HybridDetector:
        """Fit on residual rows; ``identity`` names the columns that identify a row."""
        facts = df.agg(
            F.avg(residual).alias("mean"), F.stddev_pop(residual).alias("std"), F.count(residual).alias("n")
        ).first()
        if not facts.n:
            raise ValueError("no residuals to fit on")
        # One row; as a literal table it cannot drift when the input is read again.
        self.baseline = df.sparkSession.createDataFrame(
            [(facts.mean, max(facts.std, 1e-6))], "res_mean double, res_std double"
        )
        self.forest = isolation.fit(
            df,
            identity,
            residual,
            self.trees,
            self.sample_size,
            self.contamination,
            self.seed,
            facts.n,
        )
        return self

    def transform(self, df: DataFrame, residual: str = "residuals") -> DataFrame:
        """Add z_score, forest_score, is_anomaly, anomaly_score and anomaly_type."""
        self._fitted()
        scored = self.forest.transform(with_zscore(df, self.baseline, residual=residual), residual)
        flag = combine_signals(
            F.coalesce(F.col("z_score") >= self.z_threshold, F.lit(False)),
            F.coalesce(F.col("forest_score") < 0, F.lit(False)),
            self.strict,
        )
        severity = 0.6 * F.col("z_score") + 0.4 * F.greatest(
            F.lit(0.0), -10.0 * F.col("forest_score")
        )
        return (
            scored.withColumn("is_anomaly", flag)
            .withColumn("anomaly_score", severity)
            .withColumn("anomaly_type", anomaly_type(F.col("is_anomaly"), F.col(residual)))
        )

    def save(self, path: str) -> None:
        self._fitted()
        spark = self.baseline.sparkSession
        settings = [
            (
                self.contamination,
                self.z_threshold,
                self.strict,
                self.seed,
                self.trees,
                self.sample_size,
                self.forest.offset,
            )
        ]
        spark.createDataFrame(
            settings,
            "contamination double, z_threshold double, strict boolean, seed int, trees int, sample_size int, "
            "offset double",
        ).write.mode("overwrite").parquet(f"{path}/settings")
        self.baseline.write.mode("overwrite").parquet(f"{path}/baseline")
        self.forest.steps_frame(spark).write.mode("overwrite").parquet(f"{path}/steps")

    @classmethod
    def load(cls, spark, path: str) -> HybridDetector:
        """Read a saved detector; a missing path is an error."""
        s = spark.read.parquet(f"{path}/settings").first()
        steps = spark.read.parquet(f"{path}/steps")
        return cls(
            contamination=s.contamination,
            z_threshold=s.z_threshold,
            strict=s.strict,
            seed=s.seed,
            trees=s.trees,
            sample_size=s.sample_size,
            baseline=spark.read.parquet(f"{path}/baseline"),
            forest=isolation.IsolationForest.from_steps(steps, s.offset),
        )


def resolve_flags(df: DataFrame, detector: HybridDetector | None = None) -> DataFrame:
    """A frame with ``is_anomaly``: kept, or detected from orders - pred_orders, or from residuals."""
    if "is_anomaly" in df.columns:
        return df
    if detector is not None and {"orders", "pred_orders"} <= set(df.columns):
        return detector.transform(add_residuals(df))
    if detector is not None and "residuals" in df.columns:
        return detector.transform(df)
    raise ValueError("no is_anomaly column and nothing to detect anomalies from")


def join_labels(
    scored: DataFrame, labels: DataFrame, key: str = "city", ts: str = "date"
) -> DataFrame:
    """Predicted and true flags of the rows both sides know."""
    pred = scored.select(
        F.col(ts).cast("date").alias(ts), key, F.col("is_anomaly").cast("int").alias("is_anomaly_pred")
    )
    true = labels.select(
        F.col(ts).cast("date").alias(ts), key, F.col("is_anomaly").cast("int").alias("is_anomaly_true")
    )
    return pred.join(true, [ts, key])


def evaluate_flags(joined: DataFrame, key: str = "city") -> DataFrame:
    """Precision, recall, F1 overall and per series; a zero denominator gives 0."""
    p, t = F.col("is_anomaly_pred") == 1, F.col("is_anomaly_true") == 1
    per_key = joined.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(t).alias("n_true"),
        F.count_if(p).alias("n_predicted"),
        F.count_if(p & t).alias("hits"),
    )
    names = ("n_samples", "n_true", "n_predicted", "hits")
    sums = per_key.groupingSets([[], [F.col(key)]], F.col(key)).agg(
        F.grouping_id().alias("_level"), *[F.sum(c).alias(c) for c in names]
    )
    overall = F.col("_level") == 1
    precision = F.coalesce(F.try_divide("hits", "n_predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "n_true"), F.lit(0.0))
    f1 = F.coalesce(
        F.try_divide(2.0 * F.col("hits"), F.col("n_predicted") + F.col("n_true")), F.lit(0.0)
    )
    return sums.where(F.col("n_samples") > 0).select(
        F.when(overall, "overall").otherwise("series").alias("scope"),
        F.when(overall, "ALL").otherwise(F.col(key)).alias(key),
        "n_samples",
        "n_true",
        "n_predicted",
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
    )


def threshold_sweep(
    df: DataFrame, baseline: DataFrame, thresholds: list[float], residual: str = "residuals"
) -> DataFrame:
    """Flag counts by z threshold in one aggregate: (z_threshold, flagged, surges, dips, flag_rate)."""
    scored = with_zscore(df, baseline, residual=residual)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, level in enumerate(thresholds):
        hit = F.col("z_score") >= level
        aggs.append(F.count_if(hit).alias(f"f{i}"))
        aggs.append(F.count_if(hit & (F.col(residual) >= 0)).alias(f"s{i}"))
    cells = [
        F.struct(
            F.lit(float(level)).alias("z_threshold"),
            F.col(f"f{i}").alias("flagged"),
            F.col(f"s{i}").alias("surges"),
            (F.col(f"f{i}") - F.col(f"s{i}")).alias("dips"),
            F.try_divide(f"f{i}", "rows").alias("flag_rate"),
        )
        for i, level in enumerate(thresholds)
    ]
    return scored.agg(*aggs).select(F.inline(F.array(*cells)))


def anomaly_rows(scored: DataFrame, ts: str = "date", key: str = "city") -> DataFrame:
    """Flagged rows, newest first."""
    return scored.where("is_anomaly").orderBy(F.desc(ts), key)
