"""Batch prediction requests: JSON rows with defaults, joined to stored history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.config import LAGS, ROLLING_WINDOWS
from tidecast.functions.columns import (
    calendar_columns,
    interaction_columns,
    ratio_columns,
    weather_columns,
)
from tidecast.operators.features import apply_target_encoding, last_rows

REQUEST_SCHEMA = (
    "date date, city string, orders_lag_1 double, orders_lag_7 double, temperature_c double, "
    "rainfall_mm double, is_rainy boolean, promo_active int, is_holiday int, festival_flag int"
)
# Defaults of a request row.
REQUEST_DEFAULTS = {
    "temperature_c": 15.0,
    "rainfall_mm": 0.0,
    "is_rainy": False,
    "promo_active": 0,
    "is_holiday": 0,
    "festival_flag": 0,
}


def parse_requests(df: DataFrame, column: str = "request") -> DataFrame:
    """Request rows out of JSON text; absent fields get their defaults, lags stay NULL."""
    rows = df.select(F.from_json(column, REQUEST_SCHEMA).alias("r")).select("r.*")
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in REQUEST_DEFAULTS.items()})


def _squares(values: Column, mean: Column) -> Column:
    return F.aggregate(F.transform(values, lambda v: (v - mean) * (v - mean)), F.lit(0.0), lambda s, v: s + v)


def request_features(
    requests: DataFrame, history: DataFrame, encoding: DataFrame, tail: int = 40
) -> DataFrame:
    """One row of features per request row, behind the newest ``tail`` rows of its series.

    The stored tail of a series is one array, and a request takes its lags from the part of it before
    its own day; requests don't see each other, so repeated ones and those of later days get what each
    would get alone. Supplied lags win over computed ones. A series without history has no lags.
    """
    past = last_rows(history.select("city", "date", "orders"), tail)
    day = F.struct(F.col("date").cast("date").alias("d"), F.col("orders").cast("double").alias("y"))
    past = past.groupBy("city").agg(F.array_sort(F.collect_list(day)).alias("_tail"))
    known = F.transform(F.filter("_tail", lambda r: r["d"] < F.col("date")), lambda r: r["y"])
    rows = (
        requests.withColumn("is_rainy", F.col("is_rainy").cast("int"))
        .join(past, "city", "left")
        .withColumn("_y", F.coalesce(known, F.array().cast("array<double>")))
    )
    lags = {f"orders_lag_{n}": F.get("_y", F.size("_y") - n) for n in LAGS}
    given = {c: F.coalesce(F.col(c), v) for c, v in lags.items() if c in requests.columns}
    rolling: dict[str, Column] = {}
    for size in ROLLING_WINDOWS:
        first = F.greatest(F.size("_y") - size, F.lit(0))
        values = F.filter(F.slice("_y", first + 1, F.lit(size)), lambda v: v.isNotNull())
        mean = F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.nullif(F.size(values), F.lit(0))
        spread = _squares(values, mean)
        rolling[f"rolling_mean_{size}"] = mean
        rolling[f"rolling_std_{size}"] = F.when(F.size(values) > 1, F.sqrt(spread / (F.size(values) - 1))).otherwise(0.0)
        rolling[f"rolling_min_{size}"] = F.array_min(values)
        rolling[f"rolling_max_{size}"] = F.array_max(values)
    out = apply_target_encoding(rows.withColumns(lags | given | rolling).drop("_tail", "_y"), encoding)
    return out.withColumns(
        calendar_columns() | weather_columns(requests.columns) | interaction_columns(requests.columns) | ratio_columns()
    )
