"""What tells series apart in the pooled trees, and bands that depend on the day."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.config import FEATURE_COLUMNS, LAG_FEATURES, RATIO_FEATURES, ROLLING_FEATURES, SERIES_FEATURES
from tidecast.operators import forecast, trees
from tidecast.operators.features import build_features
from tidecast.operators.profiles import apply_series_profiles, fit_series_profiles
from tidecast.operators.quantile_trees import fit_quantile_trees
from tidecast.session import scratch_path

START = dt.date(2022, 1, 3)


def stored(df):
    path = scratch_path(df.sparkSession, "test")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def two_weekday_patterns(days=300, seed=3):
    """Series of one mean: one sells at weekends, the other in the week."""
    rng = np.random.default_rng(seed)
    rows = []
    for city, sign in (("A", 1), ("B", -1)):
        for i in range(days):
            day = START + dt.timedelta(days=i)
            lift = 50 if day.weekday() >= 5 else -20
            rows.append((day, city, int(200 + sign * lift + rng.normal(0, 3)), 15.0, 0.0, 0, 0, 0, 0))
    return rows


PANEL = "date date, city string, orders bigint, temperature_c double, rainfall_mm double, is_rainy int, is_holiday int, festival_flag int, promo_active int"


def test_profiles_equal_plain_sums(spark):
    rng = np.random.default_rng(1)
    rows = [(START + dt.timedelta(days=int(i)), c, None if rng.random() < 0.1 else int(rng.integers(0, 90))) for c in "AB" for i in rng.integers(0, 60, 80)]
    df = spark.createDataFrame(rows, "date date, city string, orders bigint")
    profiles = fit_series_profiles(df)
    pdf = pd.DataFrame(rows, columns=["date", "city", "orders"])
    pdf["day"] = [d.weekday() for d in pdf["date"]]
    for leave_out in (True, False):
        got = apply_series_profiles(df, profiles, leave_out=leave_out).collect()
        assert len(got) == len(rows)
        for r in got:
            own = pdf[(pdf["city"] == r.city) & pdf["orders"].notna()]
            same = own[own["day"] == r.date.weekday()]["orders"]
            y = r.orders if leave_out and r.orders is not None else 0
            once = int(leave_out and r.orders is not None)
            mean = (own["orders"].sum() - y) / (len(own) - once)
            level = (same.sum() - y + 7 * mean) / (len(same) - once + 7)
            assert r.series_weekday == pytest.approx(level - mean)
            assert r.series_spread == pytest.approx(own["orders"].std(ddof=0))


def test_unseen_and_empty_series_get_zero(spark):
    df = spark.createDataFrame([(START, "A", 5)], "date date, city string, orders bigint")
    profiles = fit_series_profiles(df)
    other = df.withColumn("city", F.lit("new"))
    assert [tuple(r) for r in apply_series_profiles(other, profiles).select(*SERIES_FEATURES).collect()] == [(0.0, 0.0)]
    alone = apply_series_profiles(df, profiles, leave_out=True).select(*SERIES_FEATURES).first()
    assert tuple(alone) == (0.0, 0.0)
    assert fit_series_profiles(df.limit(0)).count() == 0


def test_opposite_weekday_patterns_are_told_apart(spark):
    """Without earlier targets, the calendar and the mean alone can't tell the two series apart."""
    df = spark.createDataFrame(two_weekday_patterns(), PANEL)
    past = (*LAG_FEATURES, *ROLLING_FEATURES, *RATIO_FEATURES)
    feats = build_features(df).withColumns({c: F.lit(None).cast("double") for c in past})
    feats = feats.withColumn("city_target_enc", F.lit(200.0))  # exactly one mean
    early, late = feats.where("date < '2022-09-01'"), feats.where("date >= '2022-09-01'")
    profiles = fit_series_profiles(early)
    error = {}
    for name, train, test in (
        ("pooled", early, late),
        ("profiled", apply_series_profiles(early, profiles, leave_out=True), apply_series_profiles(late, profiles)),
    ):
        model = trees.fit_trees(train, rounds=20, step=0.3, depth=3)
        scored = trees.predict_trees(model, test)
        error[name] = scored.agg(F.avg(F.abs(F.col("orders") - F.col("tree_pred")))).first()[0]
    assert error["pooled"] > 20
    assert error["profiled"] < 0.35 * error["pooled"]


def test_held_out_days_do_not_reach_profiles(spark):
    """What a forecaster learns for its bands comes from the early days alone."""
    rows = two_weekday_patterns(120)
    cut = START + dt.timedelta(days=110)
    changed = [(r[0], r[1], r[2] * (5 if r[0] > cut else 1), *r[3:]) for r in rows]
    kept = []
    for data in (rows, changed):
        df = spark.createDataFrame(data, PANEL).where(F.col("date") <= cut)
        kept.append(fit_series_profiles(df).orderBy("city").collect())
    assert kept[0] == kept[1]


def uneven(n=6000, seed=2):
    """Residuals whose spread depends on the promotion flag and the month, in two series of different size."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({c: np.zeros(n) for c in FEATURE_COLUMNS})
    pdf["city"] = np.where(rng.random(n) < 0.5, "A", "B")
    pdf["month"] = rng.integers(1, 13, n).astype(float)
    pdf["promo_x_weekend"] = (rng.random(n) < 0.3).astype(float)
    pdf["temp_sq"] = rng.normal(size=n)
    scale = np.where(pdf["promo_x_weekend"] > 0, 4.0, 1.0) * np.where(pdf["month"] > 6, 2.0, 1.0) * np.where(pdf["city"] == "A", 3.0, 1.0)
    pdf["residuals"] = rng.normal(size=n) * scale
    pdf["held"] = rng.random(n) < 0.3
    return pdf


def test_quantile_trees_follow_the_features(spark):
    df = stored(spark.createDataFrame(uneven()))
    alphas = (0.1, 0.9)
    train, test = df.where("not held"), df.where("held")
    offsets = forecast.residual_quantiles(train, alphas)
    model = fit_quantile_trees(train.join(offsets, "city"), alphas, stored, rounds=6, step=0.5, depth=3)
    placed = test.join(offsets, "city").withColumns({f"c{i}": model.column(a) for i, a in enumerate(alphas)})
    pdf = placed.toPandas()
    low, high = (np.array([q[i] for q in pdf["quantiles"]]) for i in (0, 1))
    y = pdf["residuals"].to_numpy()
    plain = (y >= low) & (y <= high)
    fitted = (y >= low + pdf["c0"]) & (y <= high + pdf["c1"])
    worst = {}
    for name, inside in (("plain", plain), ("fitted", fitted.to_numpy())):
        by = [inside[((pdf["promo_x_weekend"] == p) & ((pdf["month"] > 6) == m)).to_numpy()].mean() for p in (0, 1) for m in (False, True)]
        worst[name] = max(abs(np.array(by) - 0.8))
        assert abs(inside.mean() - 0.8) < 0.05
    assert worst["plain"] > 0.2 and worst["fitted"] < 0.1
    x = np.zeros((len(pdf), len(FEATURE_COLUMNS) + 2))
    x[:, : len(FEATURE_COLUMNS)] = pdf[list(FEATURE_COLUMNS)]
    for i, a in enumerate(alphas):
        np.testing.assert_allclose(model.scorer(a)(x), pdf[f"c{i}"], rtol=1e-12)


def test_pinball_loss_falls_with_every_round(spark):
    df = stored(spark.createDataFrame(uneven(2000, 5)))
    offsets = forecast.residual_quantiles(df, (0.9,))
    both = df.join(offsets, "city")
    losses = []
    for rounds in (0, 1, 3):
        model = fit_quantile_trees(both, (0.9,), stored, rounds=rounds, step=0.5, depth=2)
        left = F.col("residuals") - F.col("quantiles")[0] - model.column(0.9)
        losses.append(both.agg(F.avg(F.greatest(0.9 * left, -0.1 * left))).first()[0])
    assert losses[0] > losses[1] > losses[2]


def test_no_held_out_rows_give_no_corrections(spark):
    df = spark.createDataFrame(uneven(20)).withColumn("quantiles", F.array(F.lit(0.0))).limit(0)
    model = fit_quantile_trees(df, (0.5,), stored)
    assert model.rows == [] and model.scorer(0.5)(np.zeros((3, 48))).tolist() == [0, 0, 0]


def test_bands_of_a_forecaster_depend_on_the_day(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for city in ("A", "B"):
        for i in range(700):
            day = START + dt.timedelta(days=i)
            promo = int(rng.random() < 0.4)
            rows.append((day, city, int(max(0, 300 + rng.normal(0, 40 if promo and day.weekday() >= 5 else 5))), 15.0, 0.0, 0, 0, 0, promo))
    df = spark.createDataFrame(rows, PANEL)
    model = forecast.DemandForecaster(rounds=5).fit(df)
    wide = F.col("pred_p90") - F.col("pred_p10")
    loud = (F.col("promo_active") == 1) & (F.weekday("date") >= 5)
    spread = {r.loud: r.wide for r in model.predict_intervals(df).groupBy(loud.alias("loud")).agg(F.avg(wide).alias("wide")).collect()}
    assert spread[True] > 1.5 * spread[False]
    path = str(tmp_path / "model")
    model.save(path)
    again = forecast.DemandForecaster.load(spark, path)
    assert sorted(again.band_trees.rows) == sorted(model.band_trees.rows) and again.band_trees.rows
    ahead = [m.forecast_future(df, 5).select("city", "date", "pred_p10", "pred_p90").orderBy("city", "date").collect() for m in (model, again)]
    assert ahead[0] == ahead[1] and len(ahead[0]) == 10
