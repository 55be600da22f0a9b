"""Shape of the physical plans: shuffles, pushdown, early limits."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tidecast.operators import backtest, decompose, features, metrics
from tidecast.plans.catalog import orders_panel
from tidecast.sources import promos

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def stored(spark, panel, tmp_path):
    path = str(tmp_path / "panel")
    panel.write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|Single)", plan(df)))


def test_all_window_features_share_one_shuffle_and_one_sort(stored):
    out = features.build_features(stored, fill="none")
    assert exchanges(out) == 1
    assert plan(out).count("Sort [") == 1
    assert "Python" not in plan(out)


def test_filled_features_add_no_shuffle_when_nothing_crosses_series(stored):
    assert exchanges(features.build_features(stored)) == 1


def test_decomposition_needs_one_shuffle(stored):
    assert exchanges(decompose.decompose_weekly(stored)) == 1


def test_folds_do_not_shuffle_the_rows(stored):
    text = plan(backtest.assign_folds(stored))
    main = text.split("Subquery")[0]
    assert "Exchange" not in main


def test_scan_reads_only_what_the_query_needs(stored):
    text = plan(metrics.error_metrics(stored.where("city = 'Austin'"), actual="orders", pred="orders"))
    assert "ReadSchema: struct<city:string,orders:bigint>" in text
    assert "EqualTo(city,Austin)" in text


def test_newest_rows_are_limited_before_the_shuffle(stored):
    text = plan(features.last_rows(stored, 40))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_promo_overlay_has_no_range_join(spark, stored):
    calendar = promos.add_promo(promos.empty_calendar(spark), "Austin", "2023-12-01", "2023-12-05")
    text = plan(promos.overlay_promos(stored, calendar))
    assert "NestedLoop" not in text
    assert "Cartesian" not in text


def test_panel_prunes_columns(spark):
    text = plan(orders_panel(spark, SF))
    assert not any(c in text for c in ("l_extendedprice", "l_partkey", "l_linenumber", "s_name", "n_comment"))


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.scope for r in rows} == {"global", "series"}
