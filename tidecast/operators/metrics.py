"""Error metrics, benchmark tables and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.columns import absolute_percentage_error
from tidecast.functions.quantiles import quantiles, value_counts


def error_sums(actual: str = "orders", pred: str = "pred_orders", prefix: str = "") -> list[Column]:
    """Additive parts of the error metrics: they can be summed again to any coarser level."""
    err = F.col(actual).cast("double") - F.col(pred)
    return [
        F.count(err).alias(f"{prefix}n"),
        F.sum(F.abs(err)).alias(f"{prefix}sum_abs"),
        F.sum(err * err).alias(f"{prefix}sum_sq"),
        F.sum(absolute_percentage_error(actual, pred)).alias(f"{prefix}sum_ape"),
    ]


def error_ratios(prefix: str = "", suffix: str = "") -> list[Column]:
    """MAPE, RMSE and MAE out of (re-summed) ``error_sums`` columns."""
    n = F.col(f"{prefix}n")
    return [
        F.try_divide(f"{prefix}sum_ape", n).alias(f"mape{suffix}"),
        F.sqrt(F.try_divide(f"{prefix}sum_sq", n)).alias(f"rmse{suffix}"),
        F.try_divide(f"{prefix}sum_abs", n).alias(f"mae{suffix}"),
    ]


def _resum(prefix: str = "") -> list[Column]:
    return [F.sum(f"{prefix}{c}").alias(f"{prefix}{c}") for c in ("n", "sum_abs", "sum_sq", "sum_ape")]


def error_metrics(
    df: DataFrame, by: list[str] | None = None, actual: str = "orders", pred: str = "pred_orders"
) -> DataFrame:
    """MAPE, RMSE, MAE over all rows or per group."""
    by = by or []
    sums = df.groupBy(*by).agg(*error_sums(actual, pred))
    return sums.select(*by, "n", *error_ratios())


def scoped_metrics(
    df: DataFrame, key: str = "city", actual: str = "orders", pred: str = "pred_orders"
) -> DataFrame:
    """Global and per-series metrics in one pass: (scope, key, n, mape, rmse, mae).

    Rows are summed per series once; the grouping sets then run on one row per series.
    """
    per_key = df.groupBy(key).agg(*error_sums(actual, pred))
    sums = per_key.groupingSets([[], [F.col(key)]], F.col(key)).agg(
        F.grouping_id().alias("_level"), *_resum()
    )
    is_global = F.col("_level") == 1
    return sums.select(
        F.when(is_global, "global").otherwise("series").alias("scope"),
        F.when(is_global, "ALL").otherwise(F.col(key)).alias(key),
        "n",
        *error_ratios(),
    )


def interval_coverage(
    df: DataFrame,
    actual: str = "orders",
    low: str = "pred_p10",
    high: str = "pred_p90",
    target: float = 0.80,
) -> DataFrame:
    """Share of rows inside the band; 0 for an empty frame."""
    inside = F.coalesce(F.col(actual).between(F.col(low), F.col(high)), F.lit(False))
    return df.agg(
        F.coalesce(F.avg(inside.cast("double")), F.lit(0.0)).alias("coverage"),
        F.lit(target).alias("target_coverage"),
    )


def kpi_panel(df: DataFrame) -> DataFrame:
    """MAPE, RMSE, flagged days and volume of a scored slice."""
    sums = df.agg(
        *error_sums(),
        F.coalesce(F.sum(F.col("is_anomaly").cast("long")), F.lit(0)).alias("anomalies"),
        F.coalesce(F.sum("orders"), F.lit(0)).cast("long").alias("volume"),
    )
    mape, rmse, _ = error_ratios()
    return sums.select(mape, rmse, "anomalies", "volume")


def city_benchmark(df: DataFrame, key: str = "city") -> DataFrame:
    """Per-series summary of a scored table, with the relative bubble size of the map."""
    sums = df.groupBy(key).agg(
        *error_sums(),
        F.sum("orders").alias("total"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("is_anomaly").cast("long")).alias("flagged"),
    )
    mape, rmse, _ = error_ratios()
    table = sums.select(
        key,
        (F.col("total") / F.col("rows")).cast("int").alias("avg_daily_orders"),
        F.col("total").cast("long").alias("total_volume"),
        F.bround(mape, 2).alias("mape"),
        F.bround(rmse, 1).alias("rmse"),
        F.bround(100.0 * F.col("flagged") / F.col("rows"), 2).alias("anomaly_pct"),
    )
    largest = table.agg(F.max("avg_daily_orders").alias("m")).scalar()
    return table.withColumn(
        "marker_size", F.try_divide(F.col("avg_daily_orders").cast("double"), largest) * 40.0
    )


def mape_by_month(
    df: DataFrame, months: int = 12, key: str = "city", ts: str = "date"
) -> DataFrame:
    """Series x month MAPE for the newest months in the data; a month without rows is NULL."""
    monthly = df.groupBy(key, F.date_format(ts, "yyyy-MM").alias("year_month")).agg(*error_sums())
    # Distinct months are bounded by the calendar, so they fit one small array.
    newest = monthly.agg(
        F.slice(F.sort_array(F.collect_set("year_month"), asc=False), 1, months).alias("m")
    ).scalar()
    grid = monthly.select(key).distinct().withColumn("year_month", F.explode(newest))
    mape, _, _ = error_ratios()
    cells = monthly.select(key, "year_month", F.bround(mape, 2).alias("mape"))
    return grid.join(cells, [key, "year_month"], "left")


def pivot_months(tidy: DataFrame, months: list[str], key: str = "city") -> DataFrame:
    """Wide form of ``mape_by_month`` for a given list of months."""
    return tidy.groupBy(key).pivot("year_month", months).agg(F.first("mape"))


def describe_by_city(df: DataFrame, value: str = "orders", key: str = "city") -> DataFrame:
    """count, mean, std, min, quartiles, max per series."""
    basics = df.groupBy(key).agg(
        F.count(value).alias("count"),
        F.avg(F.col(value).cast("double")).alias("mean"),
        F.stddev_samp(F.col(value).cast("double")).alias("std"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
    )
    quarts = quantiles(value_counts(df, [key], value), [key], [0.25, 0.5, 0.75])
    return basics.join(quarts, key, "left").select(
        key,
        "count",
        "mean",
        "std",
        "min",
        F.col("quantiles")[0].alias("p25"),
        F.col("quantiles")[1].alias("p50"),
        F.col("quantiles")[2].alias("p75"),
        "max",
    )


def flag_uplift(
    df: DataFrame, flags: tuple[str, ...] = ("is_rainy", "promo_active"), target: str = "orders"
) -> DataFrame:
    """Mean target by each flag separately: (flag, value, n, mean_orders)."""
    cells = df.groupBy(*flags).agg(
        F.count(target).alias("n"), F.sum(F.col(target).cast("double")).alias("s")
    )
    tall = cells.select(
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).cast("int").alias("value")) for f in flags])
        ).alias("f"),
        "n",
        "s",
    )
    return tall.groupBy("f.flag", "f.value").agg(
        F.sum("n").alias("n"), F.try_divide(F.sum("s"), F.sum("n")).alias("mean_orders")
    )


def label_share(df: DataFrame, labels: DataFrame, key: str = "city", ts: str = "date") -> DataFrame:
    """Rows, labelled anomalies and their share after a left join with the labels."""
    joined = df.select(ts, key).join(labels.select(ts, key, "is_anomaly"), [ts, key], "left")
    total = joined.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col("is_anomaly").cast("long")), F.lit(0)).alias("anomalies"),
    )
    return total.withColumn("anomaly_pct", F.try_divide(100.0 * F.col("anomalies"), F.col("rows")))


def panel_profile(df: DataFrame, key: str = "city", ts: str = "date") -> DataFrame:
    """First and last day, rows and distinct days per series."""
    # Counting days first keeps the distinct count in ordinary partial aggregates.
    per_day = df.groupBy(key, ts).agg(F.count(F.lit(1)).alias("n"))
    return per_day.groupBy(key).agg(
        F.min(ts).alias("first_date"),
        F.max(ts).alias("last_date"),
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("distinct_dates"),
    )


def weight_sweep(
    df: DataFrame,
    weights: list[float],
    tree: str = "tree_pred",
    additive: str = "additive_pred",
    actual: str = "orders",
) -> DataFrame:
    """Metrics of the blend for every tree weight, in one aggregate without copying rows."""
    aggs: list[Column] = []
    for i, w in enumerate(weights):
        blend = F.greatest(F.lit(w) * F.col(tree) + F.lit(1.0 - w) * F.col(additive), F.lit(0.0))
        err = F.col(actual).cast("double") - blend
        safe = F.greatest(F.col(actual).cast("double"), F.lit(1.0))
        aggs += [
            F.avg(F.abs(err) / safe * 100.0).alias(f"mape_{i}"),
            F.sqrt(F.avg(err * err)).alias(f"rmse_{i}"),
            F.avg(F.abs(err)).alias(f"mae_{i}"),
        ]
    cells = [
        F.struct(
            F.lit(float(w)).alias("tree_weight"),
            F.col(f"mape_{i}").alias("mape"),
            F.col(f"rmse_{i}").alias("rmse"),
            F.col(f"mae_{i}").alias("mae"),
        )
        for i, w in enumerate(weights)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def rolling_accuracy(
    df: DataFrame, window_days: int = 30, key: str | None = None, ts: str = "date"
) -> DataFrame:
    """Mean APE per day, averaged over the last ``window_days`` days: (date, rolling_mape).

    The window runs on one row per day (and series when ``key`` is given), never on the input rows.
    """
    by = [key] if key else []
    if not {ts, "orders", "pred_orders", *by} <= set(df.columns):
        return df.sparkSession.createDataFrame([], f"{ts} date, rolling_mape double")
    daily = df.groupBy(*by, F.col(ts).cast("date").alias(ts)).agg(
        F.avg(absolute_percentage_error()).alias("ape")
    )
    day_no = F.datediff(F.col(ts), F.lit("1970-01-01").cast("date"))
    window = Window.partitionBy(*by).orderBy(day_no).rangeBetween(-(window_days - 1), 0)
    return daily.select(*by, ts, F.avg("ape").over(window).alias("rolling_mape"))
