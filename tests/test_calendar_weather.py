from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidecast.sources import promos, weather
from tidecast.sources.requests import parse_requests, request_features
from tidecast.config import FEATURE_COLUMNS
from tidecast.operators.features import build_features, fit_target_encoding


def grid(spark, cities, first, days):
    rows = [(c, first + dt.timedelta(days=i)) for c in cities for i in range(days)]
    return spark.createDataFrame(rows, "city string, date date")


@pytest.fixture()
def calendar(spark):
    out = promos.empty_calendar(spark)
    out = promos.add_promo(out, "Austin", "2024-09-01", "2024-09-03", 1.5, "sale")
    return promos.add_promo(out, "Austin", dt.date(2024, 9, 3), dt.date(2024, 9, 4), 2.0)


def test_promo_days_are_inclusive_and_take_the_maximum(spark, calendar):
    days = grid(spark, ["Austin", "Miami"], dt.date(2024, 9, 1), 5)
    out = {(r.city, r.date.day): (r.promo_active, r.promo_intensity) for r in promos.promo_grid(calendar, days).collect()}
    assert out[("Austin", 1)] == (1, 1.5)
    assert out[("Austin", 3)] == (1, 2.0)
    assert out[("Austin", 5)] == (0, 0.0)
    assert all(out[("Miami", d)] == (0, 0.0) for d in range(1, 6))
    assert promos.promo_grid(calendar).count() == 4
    assert promos.promo_grid(promos.empty_calendar(spark)).count() == 0


def test_bad_promos_are_rejected(spark, calendar):
    with pytest.raises(ValueError):
        promos.add_promo(calendar, "Austin", "2024-09-03", "2024-09-01")
    with pytest.raises(ValueError):
        promos.add_promo(calendar, "Austin", "2024-09-01", "2024-09-01", 0.0)
    day = dt.date(2024, 1, 2)
    asked = spark.createDataFrame(
        [("A", day, day, 1.0, ""), ("A", day, dt.date(2024, 1, 1), 1.0, ""), ("A", day, day, float("nan"), "")],
        promos.CALENDAR_SCHEMA,
    )
    # NaN is larger than any number to Spark, so it passes as positive.
    assert promos.promo_problems(asked).count() == 1
    assert promos.valid_promos(asked).count() == 2


def test_removing_and_listing(spark, calendar):
    left, removed = promos.remove_promo(calendar, "Austin", "2024-09-01")
    assert removed == 1
    assert left.count() == 1
    assert promos.remove_promo(calendar, "Miami", "2024-09-01")[1] == 0
    assert [r.start_date.day for r in promos.list_promos(calendar).collect()] == [1, 3]
    assert promos.list_promos(calendar, "Miami").count() == 0
    gone = spark.createDataFrame([("Austin", dt.date(2024, 9, 3))], "city string, start_date date")
    assert promos.remove_promos(calendar, gone).count() == 1


def test_calendar_round_trip(spark, calendar, tmp_path):
    path = str(tmp_path / "calendar")
    assert promos.load_calendar(spark, path).count() == 0
    promos.save_calendar(calendar, path)
    assert promos.load_calendar(spark, path).exceptAll(calendar).count() == 0
    array = tmp_path / "array.json"
    entry = {"city": "A", "start_date": "2024-01-01", "end_date": "2024-01-02", "intensity": 1.0, "label": "x"}
    array.write_text(json.dumps([entry, entry], indent=2))
    assert promos.load_calendar(spark, str(array), multi_line=True).count() == 2


def test_overlay_replaces_or_keeps_flags(spark, calendar):
    base = grid(spark, ["Austin"], dt.date(2024, 9, 3), 3).withColumn("promo_active", F.lit(1))

    def flags(df):
        return [(r.promo_active, r.promo_intensity) for r in df.orderBy("date").collect()]

    assert flags(promos.overlay_promos(base, calendar)) == [(1, 2.0), (1, 2.0), (0, 0.0)]
    assert flags(promos.overlay_promos(base, calendar, mode="or"))[2] == (1, 0.0)
    assert [f for f, _ in flags(promos.overlay_promos(base, promos.empty_calendar(spark)))] == [1, 1, 1]


def payload(**daily):
    return json.dumps({"daily": daily})


def test_weather_payload(spark):
    rows = [
        ("Austin", payload(time=["2024-01-01", "2024-01-02"], temperature_2m_mean=[None, 25.0], precipitation_sum=[None, 3.0])),
        ("Miami", payload(time=["2024-01-01", "2024-01-02"], temperature_2m_mean=[20.0], precipitation_sum=[2.0, 1.0])),
        ("Nowhere", json.dumps({"error": True})),
        ("Half", payload(time=["2024-01-01"], temperature_2m_mean=[20.0])),
    ]
    out = weather.parse_payloads(spark.createDataFrame(rows, "city string, payload string"))
    got = {(r.city, r.date.day): (r.temperature_c, r.rainfall_mm, r.is_rainy) for r in out.collect()}
    assert got == {
        ("Austin", 1): (15.0, 0.0, False),
        ("Austin", 2): (25.0, 3.0, True),
        ("Miami", 1): (20.0, 2.0, False),
    }


def test_weather_extension(spark):
    rows = [("A", dt.date(2024, 1, 1), 10.0, 0.0, False), ("A", dt.date(2024, 1, 2), 20.0, 4.0, True)]
    df = spark.createDataFrame(rows, "city string, date date, temperature_c double, rainfall_mm double, is_rainy boolean")
    out = weather.extend_horizon(df, 4).orderBy("date").collect()
    assert [r.date.day for r in out] == [1, 2, 3, 4]
    assert all((r.temperature_c, r.rainfall_mm, r.is_rainy) == (15.0, 2.0, False) for r in out[2:])
    assert weather.extend_horizon(df, 1).count() == 2


def test_weather_override_takes_the_first_match(spark):
    rows = grid(spark, ["A"], dt.date(2024, 1, 1), 2).withColumns({"temperature_c": F.lit(1.0), "is_rainy": F.lit(0)})
    feed = spark.createDataFrame(
        [(1, "A", dt.date(2024, 1, 1), 30.0, True), (0, "A", dt.date(2024, 1, 1), 20.0, False)],
        "seq int, city string, date date, temperature_c double, is_rainy boolean",
    )
    out = weather.override_weather(rows, feed, order="seq").orderBy("date").collect()
    assert [(r.temperature_c, r.is_rainy) for r in out] == [(20.0, 0), (1.0, 0)]


def test_coordinates(spark):
    df = spark.createDataFrame([("Miami",), ("Atlantis",)], "city string")
    got = {r.city: (r.lat, r.lon) for r in weather.with_coordinates(df).collect()}
    assert got == {"Miami": (25.7617, -80.1918), "Atlantis": (40.7128, -74.0060)}
    zero = weather.with_coordinates(df, default=(0.0, 0.0)).where("city = 'Atlantis'").first()
    assert (zero.lat, zero.lon) == (0.0, 0.0)


def test_requests_get_defaults_and_history(spark, panel):
    day = "2024-01-01"
    texts = [json.dumps({"date": day, "city": "Austin"}), json.dumps({"date": day, "city": "Chicago", "orders_lag_1": 7.0, "is_rainy": True})]
    asked = parse_requests(spark.createDataFrame([(t,) for t in texts], "request string"))
    first = asked.where("city = 'Austin'").first()
    assert (first.temperature_c, first.rainfall_mm, first.is_rainy, first.promo_active) == (15.0, 0.0, False, 0)
    feats = request_features(asked, panel, fit_target_encoding(panel))
    got = {r.city: r for r in feats.collect()}
    last = panel.where("city = 'Austin' and date = '2023-12-31'").first().orders
    assert got["Austin"].orders_lag_1 == last
    assert got["Chicago"].orders_lag_1 == 7.0
    assert got["Chicago"].lag_7_ratio == pytest.approx(7.0 / (got["Chicago"].orders_lag_7 + 1))


def test_repeated_requests_do_not_meet(spark, panel):
    """One row per request; each gets the features that it would get alone."""
    days = ["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-05"]
    texts = [(json.dumps({"date": d, "city": "Austin"}),) for d in days] + [(json.dumps({"date": days[0], "city": "Nowhere"}),)]
    asked = parse_requests(spark.createDataFrame(texts, "request string"))
    encoding = fit_target_encoding(panel)
    got = request_features(asked, panel, encoding)
    assert got.count() == 5 and set(FEATURE_COLUMNS) <= set(got.columns)
    own = [r for r in got.collect() if r.city == "Austin"]
    last = panel.where("city = 'Austin' and date = '2023-12-31'").first().orders
    assert {r.orders_lag_1 for r in own} == {last}
    assert got.where("city = 'Nowhere'").first().orders_lag_1 is None
    one = asked.where("city = 'Austin' and date = '2024-01-01'").limit(1)
    asks = one.withColumns({"orders": F.lit(None).cast("double"), "is_rainy": F.col("is_rainy").cast("int")})
    names = [c for c in panel.columns if c in asks.columns]
    both = panel.withColumn("orders", F.col("orders").cast("double")).select(names).unionByName(asks.select(names))
    built = build_features(both, encoding, fill="none").where("date = '2024-01-01' and city = 'Austin'").first()
    mine = request_features(one, panel, encoding).first()
    for c in FEATURE_COLUMNS:
        assert mine[c] == pytest.approx(built[c]), c
