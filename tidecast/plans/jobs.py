"""Jobs: walk-forward evaluation, historical scoring and the end-to-end training run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.config import SETTINGS
from tidecast.operators import anomaly, backtest, drift, registry, reports
from tidecast.operators.features import apply_target_encoding, build_features, fit_target_encoding
from tidecast.operators.forecast import DemandForecaster
from tidecast.operators.metrics import rolling_accuracy
from tidecast.session import scratch_path
from tidecast.sources import panel as panel_io
from tidecast.sources.exports import write_csv

#: Days that the drift step compares with all days before.
DRIFT_DAYS = 90


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the plan, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def walk_forward_predictions(
    df: DataFrame, n_splits: int = SETTINGS.folds, segment_rows: int | None = None, **model_options
) -> DataFrame:
    """Validation rows of all folds with ``pred_model`` (fitted on earlier dates) and ``pred_baseline``.

    Features are computed once and look back only. The target encoding, the one feature that could
    carry later values, is fitted anew on the training dates of every fold. The folds don't depend on
    each other, so all are fitted at the same time.
    """
    feats = build_features(df, fill="none", segment_rows=segment_rows).drop("city_target_enc")
    feats = materialize(backtest.assign_folds(feats, n_splits), "folds")

    def validate(fold: int) -> DataFrame:
        train, val = feats.where(F.col("fold") < fold), feats.where(F.col("fold") == fold)
        encoding = fit_target_encoding(train)
        model = DemandForecaster(**model_options).fit(
            apply_target_encoding(train, encoding), intervals=False
        )
        scored = model.predict(apply_target_encoding(val, model.encoding))
        return scored.select(
            "fold",
            "date",
            "city",
            "orders",
            F.col("pred_orders").alias("pred_model"),
            F.coalesce("orders_lag_7", F.lit(0.0)).alias("pred_baseline"),
        )

    with ThreadPool(n_splits) as pool:
        parts = pool.map(validate, range(1, n_splits + 1))
    return materialize(reduce(DataFrame.unionByName, parts), "fold-predictions")


def evaluate_walk_forward(
    df: DataFrame, n_splits: int = SETTINGS.folds, segment_rows: int | None = None, **model_options
) -> DataFrame:
    """Fold metrics of the forecaster against the lag-7 baseline."""
    return backtest.fold_metrics(
        walk_forward_predictions(df, n_splits, segment_rows, **model_options)
    )


def score_history(
    df: DataFrame, model: DemandForecaster, detector: anomaly.HybridDetector
) -> DataFrame:
    """Full history with predictions, bands, residuals, flags and ``year_month``, stored once."""
    scored = detector.transform(anomaly.add_residuals(model.predict_intervals(df)))
    return materialize(scored.withColumn("year_month", F.date_format("date", "yyyy-MM")), "scored")


@dataclass
class JobResult:
    forecaster: DemandForecaster
    detector: anomaly.HybridDetector
    summary: DataFrame
    evaluation: DataFrame | None
    drift: DataFrame
    performance: DataFrame
    card: DataFrame
    paths: dict[str, str] = field(default_factory=dict)


def run_daily_job(
    spark: SparkSession,
    orders_path: str,
    out_dir: str,
    labels_path: str | None = None,
    n_splits: int = SETTINGS.folds,
    as_of: dt.date | None = None,
    segment_rows: int | None = None,
    tag: str = "daily",
    now: dt.datetime | None = None,
    **model_options,
) -> JobResult:
    """Load and validate, build features, backtest, fit, detect, evaluate; all artefacts below ``out_dir``.

    The forecaster learns from features that look back only; the stored feature table is the filled one.
    The detector learns from the residuals of the backtest, which the models had not seen. Data drift compares
    the newest 90 days with the days before. Performance drift is the rolling error of the backtest, day by day, with
    its alarm. The forecaster is registered under ``tag``, and the card reads its age and state from the manifest as of ``now``.

    Args:
        segment_rows: run row windows per segment of that many rows instead of per series; for panels
            with series too long for one task.
    """
    out = out_dir.rstrip("/")
    paths = {
        "features": f"{out}/features.parquet",
        "metrics": f"{out}/backtest_metrics",
        "forecaster": f"{out}/forecaster",
        "detector": f"{out}/detector",
        "scored": f"{out}/scored.parquet",
        "drift": f"{out}/drift.parquet",
        "performance": f"{out}/performance.parquet",
        "registry": f"{out}/registry",
        "card": f"{out}/model_card.parquet",
    }
    orders = materialize(panel_io.read_orders(spark, orders_path, as_of), "orders")
    panel_io.write_features(build_features(orders, segment_rows=segment_rows), paths["features"])

    folds = walk_forward_predictions(orders, n_splits, segment_rows, **model_options)
    metrics = materialize(backtest.fold_metrics(folds), "metrics")
    write_csv(metrics, paths["metrics"], single_file=True)

    forecaster = DemandForecaster(segment_rows=segment_rows, **model_options).fit(orders)
    forecaster.save(paths["forecaster"])
    unseen = anomaly.add_residuals(folds.withColumnRenamed("pred_model", "pred_orders"))
    detector = anomaly.HybridDetector().fit(unseen)
    detector.save(paths["detector"])
    score_history(orders, forecaster, detector).write.mode("overwrite").parquet(paths["scored"])

    newest = orders.agg(F.date_sub(F.max("date"), DRIFT_DAYS)).first()[0]
    recent = F.col("date") > F.lit(newest)
    psi = drift.population_stability(orders.where(recent), orders.where(~recent))
    psi.write.mode("overwrite").parquet(paths["drift"])
    seen = folds.select("date", "city", "orders", F.col("pred_model").alias("pred_orders"))
    history = drift.drift_history(rolling_accuracy(seen))
    history.write.mode("overwrite").parquet(paths["performance"])

    versions = registry.ModelRegistry(spark, paths["registry"])
    versions.register(forecaster, tag, "daily job", now)
    moment = now or dt.datetime.now(dt.timezone.utc)
    card = reports.model_card(spark.read.parquet(paths["scored"]), versions.age_days(tag, moment), is_fitted=True)
    card.write.mode("overwrite").parquet(paths["card"])

    evaluation = None
    if labels_path is not None:
        labels = panel_io.read_labels(spark, labels_path)
        scored = spark.read.parquet(paths["scored"])
        evaluation = anomaly.evaluate_flags(anomaly.join_labels(scored, labels))
    drifted, errors, card = (spark.read.parquet(paths[p]) for p in ("drift", "performance", "card"))
    return JobResult(forecaster, detector, backtest.fold_summary(metrics), evaluation, drifted, errors, card, paths)
