"""Walk-forward folds, the seasonal-naive baseline and fold metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.config import SETTINGS
from tidecast.operators.features import lag_features
from tidecast.operators.metrics import error_ratios, error_sums


def naive_baseline(
    df: DataFrame,
    lag: int = 7,
    key: str = "city",
    ts: str = "date",
    target: str = "orders",
    segment_rows: int | None = None,
) -> DataFrame:
    """Add ``pred_orders``: the target ``lag`` rows earlier in the series."""
    if segment_rows is None:
        window = Window.partitionBy(key).orderBy(ts)
        return df.withColumn("pred_orders", F.lag(F.col(target).cast("double"), lag).over(window))
    lagged = lag_features(df, (lag,), key, ts, target, segment_rows)
    return lagged.withColumnRenamed(f"orders_lag_{lag}", "pred_orders")


def fold_starts(df: DataFrame, n_splits: int = SETTINGS.folds, ts: str = "date") -> Column:
    """First validation date of each fold, and the day after the last, as one array value.

    Equal test blocks at the end of the distinct dates; the distinct dates of a daily panel are
    bounded by the calendar. Fails when there are fewer than ``n_splits + 2`` dates.
    """
    dates = df.select(F.col(ts).cast("date").alias("d")).distinct()
    ordered = dates.agg(F.array_sort(F.collect_list("d")).alias("d")).select(
        "d", F.size("d").alias("n")
    )
    block = F.floor(F.col("n") / (n_splits + 1))
    starts = [
        F.element_at("d", (F.col("n") - (n_splits - f + 1) * block + 1).cast("int"))
        for f in range(1, n_splits + 1)
    ]
    message = F.format_string(
        f"Insufficient distinct calendar dates (%d) for {n_splits} folds.", F.col("n")
    )
    return ordered.select(
        F.when(F.col("n") < n_splits + 2, F.raise_error(message).cast("array<date>"))
        .otherwise(F.array(*starts, F.date_add(F.array_max("d"), 1)))
        .alias("starts")
    ).scalar()


def assign_folds(df: DataFrame, n_splits: int = SETTINGS.folds, ts: str = "date") -> DataFrame:
    """Add ``fold``: the fold a row validates, 0 for rows that only ever train.

    Fold f trains on all rows with a smaller fold number. No join and no shuffle of the rows.
    """
    starts = fold_starts(df, n_splits, ts)
    day = F.col(ts).cast("date")
    return (
        df.withColumn("_starts", starts)
        .withColumn("fold", F.size(F.filter("_starts", lambda s: s <= day)))
        .drop("_starts")
    )


def fold_table(df: DataFrame, n_splits: int = SETTINGS.folds, ts: str = "date") -> DataFrame:
    """One row per fold: validation range and the sizes of the train and validation date sets."""
    dates = assign_folds(df.select(F.col(ts).cast("date").alias(ts)).distinct(), n_splits, ts)
    per_fold = dates.groupBy("fold").agg(
        F.min(ts).alias("val_start"), F.max(ts).alias("val_end"), F.count(F.lit(1)).alias("val_dates")
    )
    # n_splits + 1 rows reach this window.
    earlier = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_fold.withColumn("train_dates", F.sum("val_dates").over(earlier))
        .withColumn("train_end", F.max("val_end").over(earlier))
        .where(F.col("fold") > 0)
    )


def fold_split(df: DataFrame, fold: int, n_splits: int = SETTINGS.folds, ts: str = "date"):
    """(train, validation) frames of one fold."""
    folded = assign_folds(df, n_splits, ts)
    return (
        folded.where(F.col("fold") < fold).drop("fold"),
        folded.where(F.col("fold") == fold).drop("fold"),
    )


def fold_metrics(
    predictions: DataFrame, model: str = "pred_model", baseline: str = "pred_baseline"
) -> DataFrame:
    """Model and baseline errors per fold out of one table of validation predictions."""
    sums = predictions.groupBy("fold").agg(
        *error_sums(pred=model, prefix="m_"), *error_sums(pred=baseline, prefix="b_")
    )
    return sums.select(
        "fold", *error_ratios("m_", "_model"), *error_ratios("b_", "_baseline")
    )


def fold_summary(metrics: DataFrame) -> DataFrame:
    """Unweighted means over the folds, and whether the model beats the baseline on MAPE."""
    names = [f"{m}_{s}" for s in ("model", "baseline") for m in ("mape", "rmse", "mae")]
    means = metrics.agg(*[F.avg(c).alias(c) for c in names])
    return means.withColumn("beats_naive", F.col("mape_model") < F.col("mape_baseline"))
