from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidecast.operators import quality
from tidecast.sources import exports
from tidecast.sources import panel as panel_io

AS_OF = dt.date(2024, 6, 1)


def test_valid_panel_passes(panel):
    out = quality.validate_orders(panel, AS_OF)
    assert out.count() == panel.count()
    assert quality.violations(panel, AS_OF).count() == 0


@pytest.mark.parametrize(
    ("change", "column", "rule"),
    [
        ({"orders": "-50"}, "orders", "not_negative"),
        ({"orders": "'many'"}, "orders", "type"),
        ({"date": "date_add(date, 3650)"}, "date", "not_in_future"),
        ({"rainfall_mm": "-1.0"}, "rainfall_mm", "not_negative"),
        ({"is_rainy": "3"}, "is_rainy", "zero_or_one"),
        ({"temperature_c": "double('NaN')"}, "temperature_c", "not_nullable"),
        ({"city": "cast(null as string)"}, "city", "not_nullable"),
    ],
)
def test_broken_rules_are_reported_and_raise(panel, change, column, rule):
    bad = panel.withColumns({c: F.expr(e) for c, e in change.items()})
    found = {(r["column"], r["rule"]) for r in quality.violations(bad, AS_OF).collect()}
    assert found == {(column, rule)}
    with pytest.raises(quality.DataValidationError, match=column):
        quality.validate_orders(bad, AS_OF)
    assert quality.valid_rows(bad, AS_OF).count() == 0


def test_all_failures_are_collected(panel):
    bad = panel.drop("orders", "is_holiday").withColumn("promo_active", F.lit(7))
    found = {(r["column"], r["rule"]) for r in quality.violations(bad, AS_OF).collect()}
    assert found == {
        ("orders", "column_present"),
        ("is_holiday", "column_present"),
        ("promo_active", "zero_or_one"),
    }


def test_reading_orders(spark, panel, tmp_path):
    path, truth = str(tmp_path / "orders"), str(tmp_path / "labels")
    panel_io.write_orders_and_labels(panel.withColumn("is_anomaly", F.lit(0)), path, truth)
    out = panel_io.read_orders(spark, path, AS_OF)
    assert "is_anomaly" not in out.columns
    assert out.dtypes == panel.dtypes
    assert out.exceptAll(panel).count() == 0
    assert panel_io.read_labels(spark, truth).count() == panel.count()
    with pytest.raises(quality.DataValidationError, match="does not exist"):
        panel_io.read_orders(spark, str(tmp_path / "nothing"))
    assert panel_io.read_labels(spark, str(tmp_path / "nothing")).count() == 0


def test_feature_table_fallbacks(spark, panel, tmp_path):
    orders = str(tmp_path / "orders")
    panel.write.csv(orders, header=True)
    parquet, csv = str(tmp_path / "f.parquet"), str(tmp_path / "f.csv")
    rebuilt = panel_io.read_features(spark, parquet, csv, orders)
    assert "orders_lag_28" in rebuilt.columns
    panel_io.write_features(rebuilt, csv)
    assert panel_io.read_features(spark, parquet, csv).count() == panel.count()
    panel_io.write_features(rebuilt, parquet, partitioned=True)
    one = panel_io.read_features(spark, parquet).where("city = 'Austin'")
    assert one.count() == 100
    assert "PartitionFilters: [isnotnull(city" in one._jdf.queryExecution().toString()
    with pytest.raises(FileNotFoundError):
        panel_io.read_features(spark, str(tmp_path / "none"))


@pytest.mark.parametrize(("age", "healthy", "warns"), [(0, True, False), (2, True, True), (10, False, False)])
def test_freshness(spark, age, healthy, warns):
    now = dt.datetime(2024, 1, 20, 12)
    df = spark.createDataFrame(
        [(now - dt.timedelta(days=age, hours=1), "A", 5)], "date timestamp, city string, orders bigint"
    )
    row = quality.check_health(df, now).first()
    assert row.is_healthy is healthy
    assert (row.warning is not None) is warns
    assert row.days_stale == age


def test_empty_and_incomplete_frames_are_unhealthy(spark):
    empty = spark.createDataFrame([], "date timestamp, city string, orders bigint")
    assert quality.check_health(empty).first().error == "Dataset is completely empty."
    part = spark.createDataFrame([("A", 5)], "city string, orders bigint")
    row = quality.check_health(part).first()
    assert not row.is_healthy
    assert "date" in row.error


def test_densify_fills_the_calendar(spark):
    rows = [(dt.date(2024, 1, 1), "A", 5, 3.0), (dt.date(2024, 1, 4), "A", 7, 4.0), (dt.date(2024, 1, 2), "B", 1, 5.0)]
    df = spark.createDataFrame(rows, "date date, city string, orders bigint, temperature_c double")
    out = panel_io.densify(df).orderBy("city", "date").collect()
    assert [r.orders for r in out] == [5, 0, 0, 7, 0, 1, 0, 0]
    assert out[1].temperature_c is None
    assert panel_io.densify(df, per_series=True).count() == 5


def test_exports(spark, tmp_path):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "New York", 5, 4.25, True, "surge", 1)],
        "date date, city string, orders bigint, pred_orders double, is_anomaly boolean, anomaly_type string, extra int",
    )
    out = exports.results_export(df)
    assert out.columns == ["date", "city", "orders", "pred_orders", "is_anomaly", "anomaly_type"]
    assert df.select(exports.file_slug(F.col("city"))).first()[0] == "new_york"
    exports.write_csv(out, str(tmp_path / "r"), single_file=True)
    assert spark.read.csv(str(tmp_path / "r"), header=True).count() == 1
