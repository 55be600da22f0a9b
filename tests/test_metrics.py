from __future__ import annotations

import datetime as dt
import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidecast.functions.columns import finite_or_zero
from tidecast.functions.quantiles import quantiles, value_counts
from tidecast.operators import backtest, decompose, drift, metrics, planning, registry, reports

DAY = dt.date(2024, 1, 1)


def series(spark, values, city="A", column="rolling_mape"):
    rows = [(DAY + dt.timedelta(days=i), city, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"date date, city string, {column} double")


def test_error_metrics(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 190.0), (300.0, 300.0)], "orders double, pred_orders double")
    row = metrics.error_metrics(df).first()
    assert row.mae == pytest.approx(20 / 3)
    assert row.mape == pytest.approx(5.0)
    assert row.rmse == pytest.approx(np.sqrt(200 / 3))


def test_scoped_metrics_equal_single_levels(panel):
    df = backtest.naive_baseline(panel).where("pred_orders is not null")
    both = {r.city: r.mape for r in metrics.scoped_metrics(df).collect()}
    assert both["ALL"] == pytest.approx(metrics.error_metrics(df).first().mape)
    per_city = {r.city: r.mape for r in metrics.error_metrics(df, ["city"]).collect()}
    for city, value in per_city.items():
        assert both[city] == pytest.approx(value)


def test_segmented_baseline_is_the_same(panel):
    a = backtest.naive_baseline(panel).select("city", "date", "pred_orders")
    b = backtest.naive_baseline(panel, segment_rows=30).select("city", "date", "pred_orders")
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101])
def test_quantiles_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(size=n), 1)
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    row = quantiles(value_counts(df, ["k"], "v"), ["k"], probs).first()
    assert row.n_rows == n
    np.testing.assert_allclose(row.quantiles, np.percentile(values, [100 * p for p in probs]), atol=1e-12)


@pytest.mark.parametrize(
    ("values", "streak", "expected"),
    [([5, 5, 5], 3, False), ([10, 11, 12], 3, True), ([15, 15], 3, False), ([5, 10, 10, 5], 3, False), ([10, 10], 2, True)],
)
def test_performance_drift(spark, values, streak, expected):
    df = series(spark, values)
    assert drift.performance_drift(df, 8.0, streak).first().drift is expected
    history = drift.drift_history(df, 8.0, streak).orderBy(F.desc("date")).first()
    assert history.drift is expected


def psi_numpy(new, base):
    edges = np.unique(np.percentile(base, np.linspace(0, 100, 11)))
    if len(edges) < 2:
        edges = np.array([0, np.inf])
    else:
        edges[0], edges[-1] = -np.inf, np.inf
    p = np.maximum(np.histogram(base, edges)[0] / len(base), 1e-6)
    q = np.maximum(np.histogram(new, edges)[0] / len(new), 1e-6)
    return float(np.sum((q - p) * np.log(q / p)))


def test_stability_index(spark):
    rng = np.random.default_rng(1)
    cases = {
        "same": (np.full(30, 10), np.full(30, 10)),
        "shift": (rng.poisson(200, 100), rng.poisson(10, 100)),
        "near": (rng.poisson(50, 80), rng.poisson(50, 100)),
        "negative": (np.array([-5, 10, 10]), np.full(30, 10)),
    }
    new = [(c, int(v)) for c, (n, _) in cases.items() for v in n]
    base = [(c, int(v)) for c, (_, b) in cases.items() for v in b] + [("gone", 5)]
    schema = "city string, orders bigint"
    out = drift.population_stability(spark.createDataFrame(new + [("fresh", 1)], schema), spark.createDataFrame(base, schema))
    got = {r.city: r for r in out.collect()}
    assert set(got) == set(cases)
    for city, (n, b) in cases.items():
        assert got[city].psi == pytest.approx(psi_numpy(n, b), abs=1e-9)
    assert got["same"].psi == 0.0
    assert got["shift"].drifted


def psi_exact(new, base):
    """With edges as fractions."""
    base, n = sorted(base), len(base)
    edges = set()
    for i in range(11):
        whole, rest = divmod((n - 1) * i, 10)
        edges.add(base[whole] + Fraction(rest, 10) * (base[min(whole + 1, n - 1)] - base[whole]))
    inner = sorted(edges)[1:-1]
    bins = max(1, len(edges) - 1)
    share = lambda values: [max(sum(sum(e <= v for e in inner) == b for v in values) / len(values), 1e-6) for b in range(bins)]
    return sum((q - p) * math.log(q / p) for p, q in zip(share(base), share(new)))


def test_values_on_the_edges_of_bins(spark):
    """Interpolated edges that are whole numbers, for which products of doubles are off."""
    rng = np.random.default_rng(7)
    base, new = [], []
    for i in range(60):
        n = int(rng.integers(5, 40))
        base += [(f"c{i}", int(v)) for v in rng.integers(0, 30, n) * rng.choice([1, 3, 10])]
        new += [(f"c{i}", int(v)) for v in rng.integers(0, 300, 25)]
    schema = "city string, orders bigint"
    got = {r.city: r.psi for r in drift.population_stability(spark.createDataFrame(new, schema), spark.createDataFrame(base, schema)).collect()}
    for city, psi in got.items():
        assert psi == pytest.approx(psi_exact([v for c, v in new if c == city], [v for c, v in base if c == city]), abs=1e-9)
    assert len(got) == 60


def test_rolling_accuracy_counts_days(spark):
    rows = [(DAY, 100, 90.0), (DAY, 100, 70.0), (DAY + dt.timedelta(days=6), 100, 100.0), (DAY + dt.timedelta(days=7), 100, 50.0)]
    df = spark.createDataFrame(rows, "date date, orders bigint, pred_orders double")
    out = [r.rolling_mape for r in metrics.rolling_accuracy(df, 7).orderBy("date").collect()]
    assert out == pytest.approx([20.0, 10.0, 25.0])
    assert metrics.rolling_accuracy(df.drop("orders")).count() == 0


def test_folds(spark):
    df = series(spark, range(20))
    table = backtest.fold_table(df, 5).orderBy("fold").collect()
    assert [(r.train_dates, r.val_dates) for r in table] == [(5, 3), (8, 3), (11, 3), (14, 3), (17, 3)]
    train, val = backtest.fold_split(df, 2, 5)
    assert train.agg(F.max("date")).first()[0] < val.agg(F.min("date")).first()[0]
    with pytest.raises(Exception, match="Insufficient distinct calendar dates"):
        backtest.assign_folds(series(spark, range(6)), 5).collect()


def test_decomposition(spark):
    days = np.arange(70)
    season = np.array([3.0, 1.0, 0.0, -1.0, -2.0, -1.0, 0.0])
    values = 100 + 0.5 * days + season[days % 7]
    df = series(spark, values, column="orders").unionByName(series(spark, range(10), "short", "orders"))
    out = decompose.decompose_weekly(df).orderBy("date").toPandas()
    assert set(out.city) == {"A"}
    assert out["trend"].isna().sum() == 6
    inner = out.iloc[3:-3]
    np.testing.assert_allclose(inner["trend"], 100 + 0.5 * days[3:-3], atol=1e-9)
    np.testing.assert_allclose(inner["resid"], 0, atol=1e-9)
    np.testing.assert_allclose(out["seasonal"], season[days % 7], atol=1e-9)


def test_capacity(spark):
    df = spark.createDataFrame(
        [(DAY, "A", 100.0, 130.0), (DAY, "A", 100.0, 110.0), (DAY, "A", 0.0, 5.0), (DAY, "A", 100.0, 120.0)],
        "date date, city string, pred_orders double, pred_p90 double",
    )
    rows = planning.recommend_capacity(df, unit_cost=2.0).collect()
    assert (rows[0].recommended_inventory, rows[0].reorder_point) == (143, 115)
    assert (rows[0].expected_cost, rows[0].max_exposed_cost) == (200.0, 286.0)
    assert [r.risk_level for r in rows] == ["High", "Low", "Low", "Medium"]
    assert all(r.recommended_inventory >= r.pred_p90 for r in rows)
    part = df.drop("pred_p90")
    assert planning.recommend_capacity(part) is part


def test_month_matrix_has_null_cells(spark):
    rows = [(dt.date(2024, 1, 5), "A", 10, 9.0), (dt.date(2024, 2, 5), "B", 10, 8.0)]
    df = spark.createDataFrame(rows, "date date, city string, orders bigint, pred_orders double")
    tidy = metrics.mape_by_month(df)
    cells = {(r.city, r.year_month): r.mape for r in tidy.collect()}
    assert cells == {("A", "2024-01"): 10.0, ("A", "2024-02"): None, ("B", "2024-01"): None, ("B", "2024-02"): 20.0}
    assert metrics.pivot_months(tidy, ["2024-02", "2024-01"]).columns == ["city", "2024-02", "2024-01"]
    assert metrics.mape_by_month(df, months=1).count() == 2


def test_sanitizing(spark):
    values = [None, float("nan"), float("inf"), float("-inf"), -3.0, 2.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(finite_or_zero(F.col("x"))).collect()] == [0.0, 0.0, 0.0, 0.0, 0.0, 2.5]


def test_digest(spark):
    rows = [
        (DAY, "A", "surge", 3.456, 300, 200.0, 100.0, True),
        (DAY + dt.timedelta(days=2), "A", "dip", 2.5, 50, 200.0, -150.0, True),
        (DAY, "A", "normal", 0.1, 200, 200.0, 0.0, False),
        (DAY, "B", "normal", 0.1, 200, 200.0, 0.0, False),
        (None, "C", "surge", 3.0, 300, 200.0, 100.0, True),
    ]
    df = spark.createDataFrame(
        rows,
        "date date, city string, anomaly_type string, anomaly_score double, orders bigint, pred_orders double, residuals double, is_anomaly boolean",
    )
    text = {r.city: r.digest for r in reports.anomaly_digest(df).collect()}
    assert "All Clear" in text["B"]
    assert "**2** total anomaly events (1 surges, 1 dips)" in text["A"]
    assert text["A"].index("DIP on 2024-01-03") < text["A"].index("SURGE on 2024-01-01")
    assert "`+100.0` orders" in text["A"]
    assert "`-150.0` orders" in text["A"]
    assert "Unknown Date" in text["C"]


def test_nested_forecast_defaults(spark):
    df = spark.createDataFrame([(DAY, "A", 5.0, None)], "date date, city string, pred_orders double, pred_p10 double")
    item = reports.nested_forecast(df).first().forecasts[0]
    assert (item.pred_mean, item.pred_p10, item.pred_p90) == (5.0, 0.0, 0.0)


def test_coverage_and_card(spark):
    rows = [("A", 10, 10.0, 9.0, 11.0, False), ("A", 20, 10.0, 9.0, 11.0, True), ("B", 5, 10.0, 5.0, 11.0, False)]
    df = spark.createDataFrame(rows, "city string, orders bigint, pred_orders double, pred_p10 double, pred_p90 double, is_anomaly boolean")
    assert metrics.interval_coverage(df).first().coverage == pytest.approx(2 / 3)
    assert metrics.interval_coverage(df.where("false")).first().coverage == 0.0
    card = {(r.scope, r.city, r.metric): r.value for r in reports.model_card(df, 3.5).collect()}
    assert card[("calibration", "ALL", "p10_p90_coverage")] == pytest.approx(2 / 3)
    assert card[("anomaly", "ALL", "flag_rate")] == pytest.approx(1 / 3)
    assert card[("metadata", "ALL", "age_days")] == 3.5
    assert card[("series", "B", "mae")] == 5.0
    assert len(card) == 3 + 2 * 3 + 4


def test_ab_difference(spark):
    df = spark.createDataFrame([(100.0, 90.0, 95.0)], "orders double, a double, b double")
    row = registry.compare_predictions(df, "a", "b").first()
    assert row.mape_a_minus_b == pytest.approx(5.0)
    assert row.rmse_a_minus_b == pytest.approx(5.0)


def test_describe_equals_pandas(panel, panel_pdf):
    got = metrics.describe_by_city(panel).orderBy("city").toPandas().set_index("city")
    want = panel_pdf.groupby("city")["orders"].describe()
    np.testing.assert_allclose(got.to_numpy(dtype=float), want.to_numpy(dtype=float))
    assert isinstance(want, pd.DataFrame)
