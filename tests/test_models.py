from __future__ import annotations

import datetime as dt
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import PANEL_SCHEMA, demand
from tidecast.config import TREE_FEATURES
from tidecast.operators import additive, anomaly, explain, forecast, registry, trees
from tidecast.operators.features import build_features
from tidecast.plans import jobs


def test_predictions_are_finite_and_not_negative(panel, forecaster):
    out = forecaster.predict(panel)
    assert out.count() == panel.count()
    assert out.where("pred_orders is null or isnan(pred_orders) or pred_orders < 0").count() == 0
    blend = out.withColumn("d", F.abs(F.col("pred_orders") - 0.6 * F.col("tree_pred") - 0.4 * F.col("additive_pred")))
    assert blend.agg(F.max("d")).first()[0] < 1e-9


def test_the_model_learns(panel, forecaster):
    out = forecaster.predict(panel).withColumn("e", F.abs(F.col("orders") - F.col("pred_orders")))
    assert out.agg(F.avg("e")).first()[0] < 20


def test_bands_are_ordered(panel, forecaster):
    out = forecaster.predict_intervals(panel)
    bad = out.where("pred_p10 > pred_orders + 1e-6 or pred_p90 < pred_orders - 1e-6 or pred_p10 < 0")
    assert bad.count() == 0
    inside = out.agg(F.avg(F.col("orders").between(F.col("pred_p10"), F.col("pred_p90")).cast("int"))).first()[0]
    assert inside > 0.5


def test_unfitted_forecaster_refuses(panel):
    with pytest.raises(RuntimeError):
        forecast.DemandForecaster().predict(panel)
    with pytest.raises(ValueError, match="city"):
        forecast.DemandForecaster().fit(panel.drop("city"))


def test_save_and_load(spark, panel, forecaster, tmp_path):
    path = str(tmp_path / "forecaster")
    forecaster.save(path)
    loaded = forecast.DemandForecaster.load(spark, path)
    assert (loaded.holdout, loaded.segment_rows, loaded.rounds) == (forecaster.holdout, None, forecaster.rounds)
    names = ["city", "date", "pred_orders", "pred_p10", "pred_p90"]
    a = forecaster.predict_intervals(panel).select(names).orderBy("city", "date").toPandas()
    b = loaded.predict_intervals(panel).select(names).orderBy("city", "date").toPandas()
    pd.testing.assert_frame_equal(a, b)
    with pytest.raises(FileNotFoundError):
        forecast.DemandForecaster.load(spark, str(tmp_path / "nothing"))


def test_unseen_series_use_the_first_model(spark, panel, forecaster):
    stranger = panel.where("city = 'Austin'").withColumn("city", F.lit("Zurich"))
    got = forecaster.components(forecaster.features(stranger)).select("date", "additive_pred")
    own = forecaster.components(forecaster.features(panel.where("city = 'Austin'"))).select("date", "additive_pred")
    assert got.exceptAll(own).count() == 0


def test_horizon(spark, panel, forecaster):
    out = forecaster.forecast_future(panel, 5).orderBy("city", "date").toPandas()
    assert len(out) == 10
    assert list(out["date"][:5]) == [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(5)]
    assert out.notna().all().all()
    assert (out["pred_p10"] <= out["pred_orders"] + 1e-9).all()
    assert not out["short_history"].any()
    for bad in (0, -1):
        with pytest.raises(ValueError):
            forecaster.forecast_future(panel, bad)
    long = forecaster.forecast_future(panel, 120)
    assert long.count() == 240 and long.where("pred_orders is null").count() == 0


def test_bands_come_from_the_newest_days_of_each_series(spark):
    """A series that ended months earlier, at another level, has residuals of its own."""
    both = demand(200)
    both.loc[both.city == "Chicago", "orders"] *= 50
    both = both[(both.city == "Austin") | (pd.to_datetime(both.date) < "2023-10-01")]
    df = spark.createDataFrame(both, PANEL_SCHEMA)
    model = forecast.DemandForecaster(rounds=5).fit(df)
    widths = {r.city: r.quantiles[-1] - r.quantiles[0] for r in model.bands.collect()}
    assert set(widths) == {"Austin", "Chicago"}
    assert widths["Chicago"] > 5 * widths["Austin"]


def test_bands_do_not_see_the_held_out_targets(spark):
    """The held-out share changes the residuals, but not what they are measured against."""
    pdf = demand(150, ("Austin",))
    late = pd.to_datetime(pdf.date) > "2023-12-05"
    shifted = pdf.copy()
    shifted.loc[late, "orders"] += 1000
    bands = []
    for rows in (pdf, shifted):
        model = forecast.DemandForecaster(rounds=3).fit(spark.createDataFrame(rows, PANEL_SCHEMA))
        bands.append(model.bands.first().quantiles)
    # An encoding fitted on all rows would move with the held-out targets and hide the shift.
    assert min(b - a for a, b in zip(*bands)) > 0
    assert max(bands[1]) - max(bands[0]) > 500


def test_each_horizon_day_equals_a_batch_prediction(panel, forecaster):
    """Feed the forecast back as history: scoring the appended rows in one batch gives it again."""
    out = forecaster.forecast_future(panel, 10)
    future = out.select("date", "city", "orders", *[c for c in panel.columns if c not in ("date", "city", "orders")])
    both = panel.withColumn("orders", F.col("orders").cast("double")).unionByName(future)
    batch = forecaster.predict_intervals(both).where("date > '2023-12-31'")
    names = ["pred_orders", "tree_pred", "pred_p10", "pred_p90"]
    a = out.orderBy("city", "date").select(names).toPandas()
    b = batch.orderBy("city", "date").select(names).toPandas()
    np.testing.assert_allclose(a, b, rtol=1e-9)


def test_short_history_is_flagged_and_forecast(spark, forecaster):
    short = spark.createDataFrame(demand(5, ("Austin",)), PANEL_SCHEMA)
    out = forecaster.forecast_future(short, 3).collect()
    assert len(out) == 3
    assert all(r.short_history and np.isfinite(r.pred_orders) for r in out)


def test_weather_and_promos_reach_the_horizon(spark, panel, forecaster):
    feed = spark.createDataFrame(
        [("Austin", dt.date(2024, 1, 2), 40.0, 9.0, True)],
        "city string, date date, temperature_c double, rainfall_mm double, is_rainy boolean",
    )
    promos = spark.createDataFrame(
        [("Austin", dt.date(2024, 1, 3), dt.date(2024, 1, 3), 2.0, "x")],
        "city string, start_date date, end_date date, intensity double, label string",
    )
    rows = {r.date.day: r for r in forecaster.forecast_future(panel, 3, feed, promos).where("city = 'Austin'").collect()}
    assert (rows[2].temperature_c, rows[2].rainfall_mm, rows[2].is_rainy) == (40.0, 9.0, 1)
    assert rows[1].temperature_c != 40.0
    assert [rows[d].promo_active for d in (1, 2, 3)] == [0, 0, 1]


def test_node_table_scores_like_the_model(spark, panel, forecaster):
    feats = forecaster.tree_features(panel)
    pdf = trees.predict_trees(forecaster.tree_model, feats).toPandas()
    x = pdf.reindex(columns=list(TREE_FEATURES)).fillna(0.0).to_numpy(dtype=float)
    np.testing.assert_allclose(forecaster.nodes(spark).score(x), pdf["tree_pred"], rtol=1e-9)


def brute_shapley(nodes, x):
    """Shapley values of one row from the definition, over the features the trees use."""
    from itertools import combinations
    from math import factorial

    def expect(at, known):
        if nodes.left[at] < 0:
            return nodes.value[at]
        left, right, f = nodes.left[at], nodes.right[at], nodes.feature[at]
        if f in known:
            return expect(left if x[f] <= nodes.threshold[at] else right, known)
        return (nodes.rows[left] * expect(left, known) + nodes.rows[right] * expect(right, known)) / nodes.rows[at]

    def value(known):
        return sum(expect(r, known) for r in nodes.roots)

    used = sorted({int(f) for f in nodes.feature if f >= 0})
    phi = np.zeros(len(x))
    for f in used:
        others = [u for u in used if u != f]
        for k in range(len(others) + 1):
            w = factorial(k) * factorial(len(used) - k - 1) / factorial(len(used))
            for s in combinations(others, k):
                phi[f] += w * (value({*s, f}) - value(set(s)))
    return phi, value(set())


def test_attributions_are_shapley_values(spark, panel):
    model = trees.fit_trees(build_features(panel), rounds=2, depth=3, step=0.5)
    nodes = trees.Nodes.of(trees.node_table(spark, model))
    pdf = build_features(panel).toPandas()
    x = pdf.reindex(columns=list(TREE_FEATURES)).fillna(0.0).to_numpy(dtype=float)[::40]
    phi, base = trees.attribute(nodes, x)
    for row, got in zip(x, phi):
        want, expected = brute_shapley(nodes, row)
        np.testing.assert_allclose(got, want, atol=1e-9)
        assert base == pytest.approx(expected)


def test_attributions_add_up(spark, panel, forecaster):
    scored = trees.predict_trees(forecaster.tree_model, forecaster.tree_features(panel))
    out = trees.with_attributions(scored, forecaster.nodes(spark))
    total = F.aggregate("attributions", F.col("base_value"), lambda s, v: s + v)
    assert out.select(F.max(F.abs(total - F.col("tree_pred")))).first()[0] < 1e-6
    top = explain.top_drivers(out, 3).first()
    sizes = [abs(d.attribution) for d in top.drivers]
    assert len(sizes) == 3
    assert sizes == sorted(sizes, reverse=True)
    assert max(abs(v) for v in top.attributions) == sizes[0]
    assert explain.global_importance(out, 4).count() == 4


def test_additive_model_recovers_structure(spark):
    days = np.arange(800)
    dates = [dt.date(2021, 1, 1) + dt.timedelta(days=int(i)) for i in days]
    promo = (days % 11 == 0).astype(int)
    y = 100 + 0.05 * days + 10 * np.sin(2 * np.pi * days / 7) + 20 * promo
    pdf = pd.DataFrame({"date": dates, "city": "A", "orders": y, "promo_active": promo})
    df = spark.createDataFrame(pdf, "date date, city string, orders double, promo_active int")
    params = additive.fit_additive(df)
    out = additive.predict_additive(df, params).toPandas()
    assert np.abs(out["orders"] - out["additive_pred"]).max() < 1.0
    assert params.first().sigma < 0.5


def broken_trend(n=900, at=450, noise=2.0, seed=6):
    """A trend that turns once, in series A, and a straight one in series B."""
    rng = np.random.default_rng(seed)
    days = np.arange(n)
    frames = []
    for city, bend in (("A", -0.4), ("B", 0.0)):
        y = 300 + 0.2 * days + bend * np.maximum(0, days - at) + rng.normal(0, noise, n)
        dates = [dt.date(2021, 1, 1) + dt.timedelta(days=int(i)) for i in days]
        frames.append(pd.DataFrame({"date": dates, "city": city, "orders": y}))
    return pd.concat(frames, ignore_index=True)


def test_trend_changes_are_sparse_and_a_planted_one_is_found(spark):
    df = spark.createDataFrame(broken_trend(), "date date, city string, orders double")
    params = {r.city: r for r in additive.fit_additive(df).collect()}
    changes = {c: np.array(p.coef[2 : 2 + additive.CHANGEPOINTS]) for c, p in params.items()}
    knots = additive.CHANGEPOINT_RANGE * np.arange(1, additive.CHANGEPOINTS + 1) / (additive.CHANGEPOINTS + 1)
    near = np.abs(knots - 0.5) < 0.07
    assert changes["A"][near].sum() == pytest.approx(-0.4 * 899, rel=0.15)
    assert np.abs(changes["A"][~near]).sum() < 0.25 * np.abs(changes["A"]).sum()
    assert np.abs(changes["B"]).sum() < 0.1 * np.abs(changes["A"]).sum()
    assert (changes["A"] == 0).sum() >= 15
    assert params["A"].sigma == pytest.approx(2.0, rel=0.2) == params["B"].sigma


def test_sparse_fit_solves_its_normal_equations():
    """At the solution the gradient of the squared error equals that of the penalties, and no change of a zero helps."""
    rng = np.random.default_rng(2)
    size = len(additive._penalties())
    x = rng.normal(size=(400, size))
    truth = np.zeros(size)
    truth[[0, 1, 5, 40]] = 3, -2, 1.5, 0.7
    y = x @ truth + rng.normal(0, 0.5, 400)
    gram, moment, square = x.T @ x, x.T @ y, float(y @ y)
    coef, sigma = additive.solve_sparse(gram, moment, square, 400)
    slope = moment - gram @ coef
    rms = np.sqrt(square / 400)
    bound = sigma**2 / (additive.CHANGE_SCALE * rms)
    changes = np.arange(2, 2 + additive.CHANGEPOINTS)
    used = [k for k in changes if coef[k]]
    np.testing.assert_allclose(slope[used], bound * np.sign(coef[used]), rtol=0.2)
    assert (np.abs(slope[changes]) <= 1.3 * bound).all()
    rest = np.setdiff1d(np.arange(size), changes)
    np.testing.assert_allclose(slope[rest], additive._penalties()[rest] * coef[rest], atol=0.05 * bound)


def test_bands_widen_with_the_horizon(spark):
    df = spark.createDataFrame(broken_trend(), "date date, city string, orders double")
    params = additive.fit_additive(df)
    last = dt.date(2021, 1, 1) + dt.timedelta(days=899)
    ahead = [(last + dt.timedelta(days=d), c) for d in (-300, 0, 1, 30, 60, 120) for c in "AB"]
    out = additive.predict_additive(spark.createDataFrame(ahead, "date date, city string"), params).collect()
    own = {r.city: r for r in params.collect()}
    for city in "AB":
        rows = sorted((r.date, r.additive_sigma) for r in out if r.city == city)
        widths = [s for _, s in rows]
        assert widths[0] == pytest.approx(widths[1]) == pytest.approx(own[city].sigma)
        for (day, width) in rows[2:]:
            h = (day - last).days / own[city].span
            rate = additive.CHANGEPOINTS / additive.CHANGEPOINT_RANGE
            assert width == pytest.approx(np.sqrt(own[city].sigma ** 2 + 2 * rate * own[city].change ** 2 * h**3 / 3))
    a = sorted((r.date, r.additive_sigma) for r in out if r.city == "A")
    assert a[-1][1] > a[-2][1] > a[-3][1] > a[1][1]


def test_variance_of_a_changing_trend_by_simulation():
    """The closed form of the horizon's variance against drawn changes."""
    rng = np.random.default_rng(1)
    rate, scale, h = 30.0, 2.0, 0.3
    ends = []
    for _ in range(20_000):
        at = rng.uniform(0, h, rng.poisson(rate * h))
        ends.append((rng.laplace(0, scale, len(at)) * (h - at)).sum())
    assert np.var(ends) == pytest.approx(2 * rate * scale**2 * h**3 / 3, rel=0.05)


def test_linear_trend(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "A", 5.0 + 2 * i) for i in range(10)]
    df = spark.createDataFrame(rows, "date date, city string, orders double")
    params = additive.fit_linear_trend(df)
    assert params.first().slope == pytest.approx(2.0)
    out = additive.predict_linear_trend(df, params)
    assert out.agg(F.max(F.abs(F.col("orders") - F.col("pred_orders")))).first()[0] < 1e-6


def test_registry(spark, panel, forecaster, tmp_path):
    models = registry.ModelRegistry(spark, str(tmp_path / "registry"))
    assert models.list_versions().count() == 0
    with pytest.raises(ValueError):
        models.register(forecast.DemandForecaster(), "v0")
    with pytest.raises(ValueError):
        models.load_version("v0")
    models.register(forecaster, "v1", "first", dt.datetime(2024, 1, 1))
    models.register(forecaster, "v2", "second", dt.datetime(2024, 1, 2))
    models.register(forecaster, "v1", "again", dt.datetime(2024, 1, 3))
    assert [(r.tag, r.description) for r in models.list_versions().collect()] == [("v1", "again"), ("v2", "second")]
    assert [(r.tag, r.number) for r in models.history().orderBy("tag", "number").collect()] == [("v1", 1), ("v1", 2), ("v2", 1)]
    assert models.load_version("v2").tree_weight == 0.6
    assert models.age_days("v1", dt.datetime(2024, 1, 2, 12)) == 1.5  # what the tag meant then
    assert models.age_days("v1", dt.datetime(2024, 1, 5)) == 2.0
    assert models.age_days("v1", dt.datetime(2023, 1, 1)) is None
    row = models.compare("v1", "v2", panel).first()
    assert row.mape_a == row.mape_b
    assert row.rmse_a_minus_b == 0.0


def test_registrations_of_one_tag_at_the_same_time(spark, panel, forecaster, tmp_path):
    models = registry.ModelRegistry(spark, str(tmp_path / "registry"))
    path = str(tmp_path / "model")
    forecaster.save(path)
    variants = [forecast.DemandForecaster.load(spark, path) for _ in range(3)]
    for i, model in enumerate(variants):
        model.tree_weight = 0.1 * (i + 1)
    # All have looked at the manifest before any writes to it.
    empty = models.history()
    models.history = lambda: empty
    with ThreadPool(3) as pool:
        numbers = pool.map(lambda m: models.register(m, "same"), variants)
    del models.history
    assert sorted(numbers) == [1, 2, 3]
    winner = variants[numbers.index(3)].tree_weight
    assert models.load_version("same").tree_weight == pytest.approx(winner)
    assert models.manifest().count() == 1 and models.history().count() == 3
    assert models.load_version("same").predict_intervals(panel).count() == panel.count()


def test_end_to_end_job(spark, tmp_path):
    pdf = demand(100)
    df = spark.createDataFrame(pdf, PANEL_SCHEMA)
    orders, truth = str(tmp_path / "orders"), str(tmp_path / "labels")
    df.write.csv(orders, header=True)
    df.select("date", "city", F.lit(0).alias("is_anomaly")).write.csv(truth, header=True)
    result = jobs.run_daily_job(spark, orders, str(tmp_path / "out"), truth, n_splits=3, now=dt.datetime(2024, 1, 1), rounds=2)
    summary = result.summary.first()
    assert all(summary[c] >= 0 for c in ("mape_model", "rmse_model", "mae_model", "mape_baseline"))
    assert spark.read.csv(result.paths["metrics"], header=True).count() == 3
    assert spark.read.parquet(result.paths["scored"]).count() == 200
    assert result.evaluation.where("scope = 'overall'").first().n_samples == 200
    assert {r.city for r in result.drift.collect()} == {"Austin", "Chicago"}
    assert "year_month" in spark.read.parquet(result.paths["scored"]).columns
    facts = {r.metric: r.value for r in result.card.where("scope = 'metadata'").collect()}
    assert facts == {"age_days": 0.0, "is_fitted": 1.0}
    days = result.performance.orderBy("date").collect()
    assert len(days) == spark.read.parquet(result.paths["performance"]).count() > 30
    runs = [d.rolling_mape > 8.0 for d in days]
    assert [d.drift for d in days] == [i >= 2 and all(runs[i - 2 : i + 1]) for i in range(len(days))]
    assert anomaly.HybridDetector.load(spark, result.paths["detector"]).forest is not None


def test_validation_rows_do_not_reach_the_fold_model(spark, panel, monkeypatch):
    """Changing the last fold's target changes no prediction of an earlier fold."""
    changed = panel.withColumn(
        "orders", F.when(F.col("date") > "2023-12-20", F.col("orders") * 10).otherwise(F.col("orders"))
    )
    names = ["city", "date", "pred_model"]
    a = jobs.walk_forward_predictions(panel, 3, rounds=2).where("fold < 3").select(names)
    b = jobs.walk_forward_predictions(changed, 3, rounds=2).where("fold < 3").select(names)
    x, y = (d.orderBy("city", "date").toPandas() for d in (a, b))
    np.testing.assert_allclose(x["pred_model"], y["pred_model"], rtol=1e-9)
