"""Attribution tables: linear attributions, top drivers, weather share, global importance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.config import FEATURE_COLUMNS, TREE_FEATURES, WEATHER_ATTRIBUTION_FEATURES


def _values(df: DataFrame) -> Column:
    return F.array(*[F.col(c).cast("double") for c in FEATURE_COLUMNS])


def fit_linear_effects(df: DataFrame, target: str = "orders") -> DataFrame:
    """One row (slopes, means): per feature its simple regression slope, 0 for a constant feature.

    Features become rows of one small aggregate with map-side combine; 46 times four aggregates in
    one row would be too wide to compile.
    """
    tall = df.select(F.col(target).cast("double").alias("y"), F.posexplode(_values(df)).alias("i", "x"))
    effects = tall.groupBy("i").agg(
        # The slope of a constant feature differs between engines, so it is 0 by definition.
        F.when(F.max("x") > F.min("x"), F.regr_slope("y", "x")).otherwise(0.0).alias("slope"),
        F.avg("x").alias("mean"),
    )
    ordered = effects.agg(F.array_sort(F.collect_list(F.struct("i", "slope", "mean"))).alias("e"))
    return ordered.select(F.col("e.slope").alias("slopes"), F.col("e.mean").alias("means"))


def linear_attributions(df: DataFrame, effects: DataFrame) -> DataFrame:
    """Add ``attributions``: slope * (value - mean) per feature."""
    fitted = effects.select(F.struct("slopes", "means").alias("e")).scalar()
    centred = F.zip_with(_values(df), F.col("_e.means"), lambda x, m: x - m)
    parts = F.zip_with(F.col("_e.slopes"), centred, lambda s, d: s * d)
    return df.withColumn("_e", fitted).withColumn("attributions", parts).drop("_e")


def top_drivers(df: DataFrame, n: int = 5) -> DataFrame:
    """Add ``drivers``: the n largest attributions of each row as {feature, attribution}.

    Sorting happens inside the row, so nothing is shuffled. Ties keep the feature order.
    """
    names = F.array(*[F.lit(c) for c in TREE_FEATURES])
    items = F.transform(
        "attributions",
        lambda v, i: F.struct((-F.abs(v)).alias("rank"), i.alias("i"), v.alias("attribution")),
    )
    best = F.slice(F.array_sort(items), 1, n)
    named = F.transform(
        best,
        lambda d: F.struct(
            F.get(names, d["i"]).alias("feature"), d["attribution"].alias("attribution")
        ),
    )
    return df.withColumn("drivers", named)


def drivers_long(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rank, feature, attribution) from ``drivers``."""
    return df.select(*keys, F.posexplode("drivers").alias("pos", "d")).select(
        *keys, (F.col("pos") + 1).alias("rank"), "d.feature", "d.attribution"
    )


def weather_attribution(df: DataFrame) -> DataFrame:
    """Add ``weather_attribution``: the sum over the weather-related features."""
    total: Column = F.lit(0.0)
    for name in WEATHER_ATTRIBUTION_FEATURES:
        total = total + F.col("attributions")[TREE_FEATURES.index(name)]
    return df.withColumn("weather_attribution", total)


def global_importance(df: DataFrame, n: int = 15) -> DataFrame:
    """The n features with the largest mean absolute attribution."""
    names = F.array(*[F.lit(c) for c in TREE_FEATURES])
    means = (
        df.select(F.posexplode("attributions").alias("i", "v"))
        .groupBy("i")
        .agg(F.avg(F.abs("v")).alias("mean_abs_attribution"))
    )
    largest = means.orderBy(F.desc("mean_abs_attribution"), "i").limit(n)
    return largest.select(F.get(names, F.col("i")).alias("feature"), "mean_abs_attribution")


def anomaly_drilldown(df: DataFrame, n: int = 3) -> DataFrame:
    """Flagged rows, newest first, with their top drivers."""
    return top_drivers(df.where("is_anomaly"), n).orderBy(F.desc("date"), "city")
