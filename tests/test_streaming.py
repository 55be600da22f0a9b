from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidecast.operators import anomaly, drift
from tidecast.streaming import flows

SCHEMA = "ts timestamp, event_type string, value double"


def test_daily_stream_drops_late_rows_and_equals_the_batch(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("events", "out", "mark"))
    start = dt.datetime(2024, 1, 1, 6)
    rows = [(start + dt.timedelta(hours=5 * i), "view" if i % 3 else "buy", 1.0) for i in range(48)]
    first, second = rows[:30], rows[30:] + [(start, "buy", 1.0)]
    for i, part in enumerate((first, second)):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        daily = flows.daily_events(flows.read_stream(spark, source))
        flows.run_to_parquet(daily, out, mark)
    got = spark.read.parquet(out)
    batch = flows.daily_events(spark.createDataFrame(rows, SCHEMA))
    last = max(r[0] for r in rows) - dt.timedelta(days=1)
    final = batch.where(F.date_add("date", 1).cast("timestamp") <= F.lit(last))
    assert final.count() > 0
    assert got.exceptAll(final).count() == 0
    assert final.exceptAll(got).count() == 0


def test_streak_state_survives_batches(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("daily", "alerts", "mark"))
    values = [9.0, 9.0, 9.0, 1.0, 9.0, 9.0, 9.0, 9.0, 1.0, 9.0]
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), c, v) for c in ("A", "B") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "date date, city string, rolling_mape double")
    for part in ("date <= '2024-01-06'", "date > '2024-01-06'"):
        df.where(part).write.mode("append").parquet(source)
        flows.run_to_parquet(flows.streak_alerts(flows.read_stream(spark, source)), out, mark)
    got = spark.read.parquet(out).select("city", "date")
    want = drift.drift_history(df, key="city").where("drift").select("city", "date")
    assert want.count() == 6
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_days_that_come_too_late_do_not_count(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("daily", "alerts", "mark"))
    for days in ((1, 2, 4), (3, 5), (7, 6)):
        rows = [(dt.date(2024, 1, d), "A", 1.0 if d == 6 else 9.0) for d in days]
        df = spark.createDataFrame(rows, "date date, city string, rolling_mape double")
        df.coalesce(1).write.mode("append").parquet(source)
        flows.run_to_parquet(flows.streak_alerts(flows.read_stream(spark, source)), out, mark)
    got = sorted((r.date.day, r.streak) for r in spark.read.parquet(out).collect())
    assert got == [(4, 3), (5, 4)]


def test_flagged_rows_are_stored_once(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("rows", "flags", "mark"))
    rows = spark.createDataFrame([("A", float(v)) for v in (0, 1, -1, 0, 50)], "city string, residuals double")
    rows.write.parquet(source)
    baseline = spark.createDataFrame([("A", 0.0, 1.0)], "city string, res_mean double, res_std double")
    scored = flows.score_stream(flows.read_stream(spark, source), baseline, ["city"])
    flows.run_flag_sink(scored, out, mark)
    flows.run_flag_sink(scored, out, mark)
    assert [(r.residuals, r.anomaly_type) for r in spark.read.parquet(out).collect()] == [(50.0, "surge")]
    batch = anomaly.detect_zscore(rows, baseline, by=["city"]).where("is_anomaly")
    assert batch.count() == 1


def late_alerts(spark, tmp_path, parts, **options):
    """Alerts after each batch of (day, series, value), and rows in the state after the last."""
    source, out, mark = (str(tmp_path / n) for n in ("daily", "alerts", "mark"))
    seen, query = [], None
    for part in parts:
        rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=d), c, v) for d, c, v in part]
        spark.createDataFrame(rows, "date date, city string, rolling_mape double").coalesce(1).write.mode("append").parquet(source)
        query = flows.run_to_parquet(flows.late_streak_alerts(flows.read_stream(spark, source), **options), out, mark)
        seen.append(sorted((r.city, (r.date - dt.date(2024, 1, 1)).days, r.streak) for r in spark.read.parquet(out).collect()))
    return seen, query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_days_out_of_order_give_the_batch_result(spark, tmp_path):
    marks = {"A": [9, 9, 9, 1, 9, 9, 9, 9, 1, 9, 9, 9, 1, 1], "B": [1, 9, 9, 9, 9, 9, 1, 9, 9, 9, 9, 9, 9, 9]}
    days = [(d, c, float(v)) for c, values in marks.items() for d, v in enumerate(values)]
    take = lambda *wanted: [x for x in days if x[0] in wanted]
    seen, _ = late_alerts(spark, tmp_path, [take(2, 0, 3), take(1, 5, 4), take(8, 6, 7, 9, 13, 12, 10, 11)])
    want = []
    for city, values in marks.items():
        run = 0
        for d, v in enumerate(values):
            run = run + 1 if v > 8 else 0
            if run >= 3 and d < 13 - 3:
                want.append((city, d, run))
    assert seen[-1] == sorted(want)
    assert seen[0] == [] and set(seen[1]) < set(seen[2])


def test_a_late_day_completes_a_streak(spark, tmp_path):
    """Day 1 comes after days 2 and 3, within the delay."""
    parts = [[(0, "A", 9.0), (2, "A", 9.0)], [(3, "A", 1.0), (1, "A", 9.0)], [(9, "A", 1.0), (1, "A", 1.0)]]
    assert late_alerts(spark, tmp_path, parts)[0][-1] == [("A", 2, 3)]


def test_missing_values_break_a_streak_and_repeats_count_once(spark, tmp_path):
    part = [(0, "A", 9.0), (0, "A", 9.0), (1, "A", 9.0), (2, "A", None), (3, "A", 9.0), (4, "A", 9.0), (5, "A", 9.0), (20, "A", 0.0)]
    assert late_alerts(spark, tmp_path, [part])[0][-1] == [("A", 5, 3)]


def test_idle_series_leave_the_state(spark, tmp_path):
    parts = [[(0, "A", 9.0), (1, "A", 9.0), (0, "B", 9.0)], [(30, "B", 1.0)], [(60, "B", 1.0), (61, "A", 9.0)], [(62, "B", 1.0)]]
    seen, held = late_alerts(spark, tmp_path, parts[:2], idle_days=10)
    assert held == 1
    (tmp_path / "again").mkdir()
    seen, held = late_alerts(spark, tmp_path / "again", parts, idle_days=10)
    assert held == 2 and seen[-1] == []
