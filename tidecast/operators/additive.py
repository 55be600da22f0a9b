"""Per-series additive model: piecewise trend, weekly and yearly seasonality, regressors.

The design vector is one Spark expression, used for fitting and scoring alike. A fit turns every
series into one row of coefficients; scoring is a join and a dot product.

Trend changes have a Laplace prior, so most of the possible change points stay unused. Its mode is found by
ridge regressions whose penalties follow the sizes of the changes, all on the same summed normal equations.
Behind the history the trend goes on changing as often and as much as it did: the variance of the sum of
such changes grows with the third power of the days ahead, and the bands widen with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.config import ADDITIVE_REGRESSORS

WEEKLY_ORDER, YEARLY_ORDER = 3, 10
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
#: Scale of the Laplace prior of the trend changes, in units of the target's root mean square.
CHANGE_SCALE = 0.05
#: Ridge penalty of the seasonal and regressor terms; reweighted fits; changes below this share of the root mean square are none.
SEASON_PENALTY, REWEIGHTS, LEAST_CHANGE = 1e-3, 50, 1e-4
PARAMS_SCHEMA = "origin date, span double, coef array<double>, sigma double, change double"


def design(ts: str, origin: Column, span: Column, available: list[str]) -> Column:
    """Array of the model's terms for one row."""
    day = F.col(ts).cast("date")
    t = F.datediff(day, origin) / span
    number = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("double")
    terms = [F.lit(1.0), t]
    for k in range(1, CHANGEPOINTS + 1):
        knot = CHANGEPOINT_RANGE * k / (CHANGEPOINTS + 1)
        terms.append(F.greatest(F.lit(0.0), t - F.lit(knot)))
    for period, order in ((7.0, WEEKLY_ORDER), (365.25, YEARLY_ORDER)):
        for m in range(1, order + 1):
            angle = F.lit(2.0 * np.pi * m / period) * number
            terms += [F.sin(angle), F.cos(angle)]
    for name in ADDITIVE_REGRESSORS:
        terms.append(
            F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in available else F.lit(0.0)
        )
    return F.array(*terms)


def _penalties() -> np.ndarray:
    season = 2 * (WEEKLY_ORDER + YEARLY_ORDER) + len(ADDITIVE_REGRESSORS)
    return np.array([1e-9, 1e-6] + [0.0] * CHANGEPOINTS + [SEASON_PENALTY] * season)


def solve_sparse(gram: np.ndarray, moment: np.ndarray, square: float, n: int) -> tuple[np.ndarray, float]:
    """Coefficients and residual deviation for normal equations, with a Laplace prior on the trend changes.

    A change c costs |c| / scale. From a fit with changes c, the cost is bounded by that of a ridge penalty
    variance / (scale |c|), so solving with these penalties and taking them anew never raises the cost.
    """
    changes = slice(2, 2 + CHANGEPOINTS)
    size = max(float(np.sqrt(square / max(n, 1))), 1e-12)
    least = LEAST_CHANGE * size
    variance, change = size * size, np.full(CHANGEPOINTS, CHANGE_SCALE * size)
    for _ in range(REWEIGHTS):
        penalty = _penalties()
        penalty[changes] = variance / (CHANGE_SCALE * size * np.maximum(np.abs(change), 0.1 * least))
        coef = np.linalg.solve(gram + np.diag(penalty), moment)
        change = coef[changes]
        variance = max(float(square - 2 * coef @ moment + coef @ gram @ coef) / max(n, 1), (1e-6 * size) ** 2)
    kept = np.ones(len(coef), dtype=bool)
    kept[changes] = np.abs(change) >= least
    coef = np.zeros(len(coef))
    coef[kept] = np.linalg.solve((gram + np.diag(penalty))[np.ix_(kept, kept)], moment[kept])
    left = float(square - 2 * coef @ moment + coef @ gram @ coef)
    return coef, float(np.sqrt(max(left, 0.0) / max(n, 1)))


def fit_additive(
    df: DataFrame, key: str = "city", ts: str = "date", target: str = "orders"
) -> DataFrame:
    """(key, origin, span, coef, sigma, change): one regression per series; ``change`` is the mean size of a trend change.

    The normal equations add up, so they are formed per (series, year) and summed per series: no
    task holds more rows than a year of one series, however long or uneven the series are. Time runs
    from the first to the last day of the whole frame.
    """
    rows = df.where(F.col(target).isNotNull())
    bounds = rows.agg(
        F.struct(F.min(ts).cast("date").alias("lo"), F.max(ts).cast("date").alias("hi")).alias("b")
    ).scalar()
    used = [c for c in ADDITIVE_REGRESSORS if c in df.columns]
    span = F.greatest(F.datediff("_b.hi", "_b.lo"), F.lit(1)).cast("double")
    yearly = (
        rows.select(key, F.col(ts).cast("date").alias(ts), target, *used)
        .withColumn("_year", F.year(ts))
        # Shuffle the few input columns; the design vector is formed behind the shuffle.
        .repartition(key, "_year")
        .withColumn("_b", bounds)
        .select(
            key,
            "_year",
            F.col("_b.lo").alias("origin"),
            span.alias("span"),
            design(ts, F.col("_b.lo"), span, used).alias("x"),
            F.col(target).cast("double").alias("y"),
        )
    )
    size = len(_penalties())

    def form(part: pa.Table) -> pa.Table:
        y = part["y"].to_numpy()
        x = np.concatenate([c.flatten().to_numpy() for c in part["x"].chunks]).reshape(-1, size)
        return pa.table(
            {
                **{c: part[c].slice(0, 1) for c in (key, "origin", "span")},
                "gram": pa.array([(x.T @ x).ravel()], pa.list_(pa.float64())),
                "moment": pa.array([x.T @ y], pa.list_(pa.float64())),
                "square": [float(y @ y)],
                "n": [len(y)],
            }
        )

    def solve(parts: pa.Table) -> pa.Table:
        gram = np.sum([g.values.to_numpy() for g in parts["gram"]], axis=0).reshape(size, size)
        moment = np.sum([m.values.to_numpy() for m in parts["moment"]], axis=0)
        coef, sigma = solve_sparse(gram, moment, parts["square"].to_numpy().sum(), parts["n"].to_numpy().sum())
        return pa.table(
            {
                **{c: parts[c].slice(0, 1) for c in (key, "origin", "span")},
                "coef": pa.array([coef], pa.list_(pa.float64())),
                "sigma": [sigma],
                "change": [float(np.abs(coef[2 : 2 + CHANGEPOINTS]).mean())],
            }
        )

    equations = yearly.groupBy(key, "_year").applyInArrow(
        form,
        f"`{key}` string, origin date, span double, gram array<double>, moment array<double>, "
        "square double, n bigint",
    )
    return equations.groupBy(key).applyInArrow(solve, f"`{key}` string, {PARAMS_SCHEMA}")


def with_series_params(df: DataFrame, params: DataFrame, key: str = "city") -> DataFrame:
    """Join one parameter row per series as a struct ``_params``.

    An unseen series gets the parameters of the first trained one in key order. The table grows with
    the number of series, so the join strategy is left to size statistics.
    """
    names = [c for c in params.columns if c != key]
    packed = params.select(key, F.struct(*names).alias("_own"))
    first = params.agg(F.min_by(F.struct(*names), key).alias("p")).scalar()
    return (
        df.join(packed, key, "left")
        .withColumn("_params", F.coalesce(F.col("_own"), first))
        .drop("_own")
    )


def predict_additive(df: DataFrame, params: DataFrame, key: str = "city", ts: str = "date") -> DataFrame:
    """Add ``additive_pred`` and ``additive_sigma``, which grows behind the last day of the fit.

    With r changes a day of mean size b, each with the variance 2 b^2, the trend h days ahead has the variance 2 r b^2 h^3 / 3.
    """
    ahead = F.greatest(F.datediff(F.col(ts).cast("date"), F.col("_params.origin")) / F.col("_params.span") - 1.0, F.lit(0.0))
    drift = F.lit(2 * CHANGEPOINTS / CHANGEPOINT_RANGE / 3) * F.pow("_params.change", F.lit(2)) * F.pow(ahead, F.lit(3))
    x = design(ts, F.col("_params.origin"), F.col("_params.span"), df.columns)
    products = F.zip_with(F.col("_params.coef"), x, lambda a, b: a * b)
    return (
        with_series_params(df, params, key)
        .withColumn("additive_pred", F.aggregate(products, F.lit(0.0), lambda s, v: s + v))
        .withColumn("additive_sigma", F.sqrt(F.pow("_params.sigma", F.lit(2)) + drift))
        .drop("_params")
    )


def fit_linear_trend(
    df: DataFrame, key: str = "city", ts: str = "date", target: str = "orders"
) -> DataFrame:
    """(key, slope, intercept) of a straight line over the day number, by plain aggregates."""
    day = F.datediff(ts, F.lit("1995-01-01").cast("date")).cast("double")
    y = F.col(target).cast("double")
    return df.groupBy(key).agg(
        F.regr_slope(y, day).alias("slope"), F.regr_intercept(y, day).alias("intercept")
    )


def predict_linear_trend(df: DataFrame, params: DataFrame, key: str = "city", ts: str = "date") -> DataFrame:
    day = F.datediff(ts, F.lit("1995-01-01").cast("date")).cast("double")
    return (
        with_series_params(df, params, key)
        .withColumn("pred_orders", F.col("_params.intercept") + F.col("_params.slope") * day)
        .drop("_params")
    )
