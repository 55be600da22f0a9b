"""What tells a series apart inside a pooled model: its weekday pattern and its spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.config import SERIES_FEATURES


def _weekday(ts: str) -> Column:
    return F.weekday(F.col(ts).cast("date"))


def fit_series_profiles(df: DataFrame, key: str = "city", target: str = "orders", ts: str = "date") -> DataFrame:
    """Sums per series and weekday: (key, n, total, squares, day_n, day_total), the last two by weekday from Monday.

    Sums are combined on the map side, so a long series costs no more than a short one after that.
    """
    y = F.col(target).cast("double")
    known = df.where(y.isNotNull() & F.col(ts).isNotNull())
    days = known.groupBy(key, _weekday(ts).alias("_d")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(y).alias("_t"), F.sum(y * y).alias("_s")
    )

    def by_day(column: str) -> Column:
        cells = [F.coalesce(F.sum(F.when(F.col("_d") == d, F.col(column))), F.lit(0).cast("double")) for d in range(7)]
        return F.array(*cells)

    return days.groupBy(key).agg(
        F.sum("_n").cast("double").alias("n"),
        F.sum("_t").alias("total"),
        F.sum("_s").alias("squares"),
        by_day("_n").alias("day_n"),
        by_day("_t").alias("day_total"),
    )


def apply_series_profiles(
    df: DataFrame,
    profiles: DataFrame,
    leave_out: bool = False,
    prior: float = 7.0,
    key: str = "city",
    target: str = "orders",
    ts: str = "date",
) -> DataFrame:
    """Add ``SERIES_FEATURES``: how far the weekday's mean lies from the series' mean, and the series' standard deviation.

    The weekday's mean is drawn to the series' mean as by ``prior`` more days of that level. With ``leave_out`` a row's own target is taken out of the sums, which is what a
    model has to learn from: else it would see its answer. An unseen series gets 0 for both.
    """
    packed = profiles.select(key, F.struct("n", "total", "squares", "day_n", "day_total").alias("_profile"))
    own = F.col(target).cast("double") if leave_out else F.lit(None).cast("double")
    once, y = own.isNotNull().cast("double"), F.coalesce(own, F.lit(0.0))
    p = F.col("_profile")
    day = _weekday(ts)
    mean = (p["total"] - y) / F.greatest(p["n"] - once, F.lit(1.0))
    level = (F.get(p["day_total"], day) - y + prior * mean) / F.greatest(F.get(p["day_n"], day) - once + prior, F.lit(1.0))
    whole = p["total"] / p["n"]
    spread = F.sqrt(F.greatest(p["squares"] / p["n"] - whole * whole, F.lit(0.0)))
    names = dict(zip(SERIES_FEATURES, (level - mean, spread)))
    joined = df.drop(*SERIES_FEATURES).join(packed, key, "left")
    return joined.withColumns({c: F.coalesce(v, F.lit(0.0)) for c, v in names.items()}).drop("_profile")
