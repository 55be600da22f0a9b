from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import anomaly, isolation


def frame(spark, values):
    rows = [(i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "row_id bigint, residuals double")


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(42)
    return frame(spark, rng.normal(0, 10, 500))


@pytest.fixture(scope="module")
def detector(history):
    return anomaly.HybridDetector(contamination=0.02).fit(history, ("row_id",))


def test_extremes_are_flagged_and_normal_rows_are_not(spark, detector):
    out = detector.transform(frame(spark, [500, -450, 800, -900])).collect()
    assert all(r.is_anomaly for r in out)
    normal = np.random.default_rng(7).normal(0, 10, 300)
    rate = detector.transform(frame(spark, normal)).agg(F.avg(F.col("is_anomaly").cast("int"))).first()[0]
    assert rate < 0.10


def test_classes(spark, detector):
    out = detector.transform(frame(spark, [5, 500, -450, -2])).orderBy("row_id").collect()
    assert [r.anomaly_type for r in out] == ["normal", "surge", "dip", "normal"]
    assert out[1].anomaly_score > out[0].anomaly_score


def test_flag_rate_is_the_contamination(history, detector):
    scores = detector.forest.transform(history, "residuals")
    share = scores.agg(F.avg((F.col("forest_score") < 0).cast("int"))).first()[0]
    assert 0.01 <= share <= 0.02


def test_scores_fall_with_distance(spark, history, detector):
    """Down to the rim of the training values; beyond it the score stays the same."""
    top = history.agg(F.max("residuals")).first()[0]
    values = [0, 0.6 * top, top, 100 * top]
    out = detector.forest.transform(frame(spark, values), "residuals").orderBy("row_id").collect()
    scores = [r.forest_score for r in out]
    assert scores[0] > scores[1] > scores[2] >= scores[3]


def test_strict_needs_both_signals(history, detector):
    loose = detector.transform(history).where("is_anomaly").count()
    strict = anomaly.HybridDetector(
        contamination=0.02, strict=True, baseline=detector.baseline, forest=detector.forest
    )
    assert strict.transform(history).where("is_anomaly").count() <= loose


def test_fit_is_repeatable(history, detector):
    again = anomaly.HybridDetector(contamination=0.02).fit(history.repartition(3), ("row_id",))
    assert again.forest.offset == detector.forest.offset
    np.testing.assert_array_equal(again.forest.edges, detector.forest.edges)


def test_save_and_load(spark, history, detector, tmp_path):
    path = str(tmp_path / "detector")
    detector.save(path)
    loaded = anomaly.HybridDetector.load(spark, path)
    a = detector.transform(history).select("row_id", "is_anomaly", "anomaly_score")
    b = loaded.transform(history).select("row_id", "is_anomaly", "anomaly_score")
    assert a.exceptAll(b).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        anomaly.HybridDetector.load(spark, str(tmp_path / "nothing"))


def test_unfitted_detector_refuses(history):
    with pytest.raises(RuntimeError):
        anomaly.HybridDetector().transform(history)


def test_samples_are_bounded_and_drawn_per_tree(spark):
    values = frame(spark, range(3000))
    out = isolation.tree_samples(values, ("row_id",), "residuals", trees=10, sample_size=64, seed=1)
    sizes = {r.tree: r["count"] for r in out.groupBy("tree").count().collect()}
    assert sizes == {t: 64 for t in range(10)}
    small = isolation.tree_samples(frame(spark, range(20)), ("row_id",), "residuals", 4, 64, 1)
    assert {r["count"] for r in small.groupBy("tree").count().collect()} == {20}


def test_samples_come_from_all_rows(spark):
    """However many rows there are, every tree draws from all of them."""
    values = frame(spark, range(60_000))
    out = isolation.tree_samples(values, ("row_id",), "residuals", trees=50, sample_size=64, seed=1)
    seen = out.select("value").distinct().count()
    assert seen > 3000  # 50 independent draws of 64 hardly meet


def test_baseline_floor(spark):
    row = anomaly.residual_baseline(frame(spark, [3, 3, 3])).first()
    assert (row.res_mean, row.res_std) == (3.0, 1e-6)


def test_evaluation(spark):
    day = "2024-01-0"
    pred = spark.createDataFrame(
        [(f"{day}1", "A", True), (f"{day}2", "A", True), (f"{day}3", "A", False), (f"{day}1", "B", False)],
        "date string, city string, is_anomaly boolean",
    )
    true = spark.createDataFrame(
        [(f"{day}1", "A", 1), (f"{day}2", "A", 0), (f"{day}3", "A", 1), (f"{day}1", "B", 0), (f"{day}9", "B", 1)],
        "date string, city string, is_anomaly int",
    )
    rows = {r.city: r for r in anomaly.evaluate_flags(anomaly.join_labels(pred, true)).collect()}
    assert (rows["ALL"].n_samples, rows["ALL"].n_true, rows["ALL"].n_predicted) == (4, 2, 2)
    assert rows["A"].precision == rows["A"].recall == rows["A"].f1 == 0.5
    assert rows["B"].precision == rows["B"].recall == rows["B"].f1 == 0.0
    assert anomaly.evaluate_flags(anomaly.join_labels(pred, true.where("false"))).count() == 0


def test_flag_sources(spark, history, detector):
    flagged = history.withColumn("is_anomaly", F.lit(True))
    assert anomaly.resolve_flags(flagged) is flagged
    pair = spark.createDataFrame([(900.0, 100.0)], "orders double, pred_orders double")
    assert anomaly.resolve_flags(pair, detector).first().is_anomaly
    assert "is_anomaly" in anomaly.resolve_flags(history, detector).columns
    with pytest.raises(ValueError):
        anomaly.resolve_flags(spark.createDataFrame([(1,)], "x int"), detector)
