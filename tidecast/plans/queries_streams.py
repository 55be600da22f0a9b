"""Queries: streaming flows run to completion over the event table and the daily panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.operators import anomaly, metrics
from tidecast.plans.catalog import SCORED, query, rounded, table
from tidecast.plans.queries_anomaly import residuals
from tidecast.plans.queries_metrics import naive
from tidecast.session import scratch_path
from tidecast.streaming import flows

DAILY_SQL = """select cast(date_trunc('day', ts) as date) as date, event_type, count(*) as orders,
  round(sum(value), 4) as total from events group by 1, 2"""


@query("daily_events", DAILY_SQL)
def daily_events(spark, sf_dir):
    """The batch twin of the streaming panel."""
    return rounded(flows.daily_events(table(spark, sf_dir, "events")), 4, "total")


@query(
    "stream_daily_panel",
    f"""with d as ({DAILY_SQL}) select * from d
where date + 1 <= (select max(ts) - interval 1 day from events)""",
)
def stream_daily_panel(spark, sf_dir):
    """The stream emits the days its watermark has passed."""
    events = flows.read_stream(spark, f"{sf_dir}/events.parquet*", f"{sf_dir}/events.parquet")
    out = scratch_path(spark, "daily")
    flows.run_to_parquet(flows.daily_events(events), out, scratch_path(spark, "daily-checkpoint"))
    return rounded(spark.read.parquet(out), 4, "total")


@query(
    "stream_score",
    f"""with {SCORED}, b as (select city, avg(residuals) as m, greatest(stddev_pop(residuals), 1e-6) as s
  from resid group by 1)
select date, r.city, residuals, round(abs((residuals - m) / s), 6) as z_score,
  case when residuals >= 0 then 'surge' else 'dip' end as anomaly_type
from resid r join b on b.city = r.city where abs((residuals - m) / s) >= 2.5""",
)
def stream_score(spark, sf_dir):
    """Residuals arrive as a stream and are flagged against the per-series baseline."""
    source, out = scratch_path(spark, "residuals"), scratch_path(spark, "flags")
    residuals(spark, sf_dir).select("date", "city", "residuals").write.parquet(source)
    baseline = anomaly.residual_baseline(spark.read.parquet(source), ["city"])
    scored = flows.score_stream(flows.read_stream(spark, source), baseline, ["city"])
    flows.run_flag_sink(scored, out, scratch_path(spark, "flags-checkpoint"))
    flags = spark.read.parquet(out).select("date", "city", "residuals", "z_score", "anomaly_type")
    return rounded(flags, 6, "z_score")


BREACH_SQL = f"""with {SCORED}, daily as (select city, date, avg(abs(residuals) / greatest(orders, 1) * 100) as ape
  from resid group by 1, 2),
roll as (select city, date, avg(ape) over (partition by city order by date
    range between interval 6 days preceding and current row) as rolling_mape from daily),
runs as (select *, sum(case when rolling_mape > 70 then 0 else 1 end) over (partition by city order by date
    rows unbounded preceding) as g from roll),
s as (select city, date, rolling_mape, cast(count(*) filter (rolling_mape > 70) over (partition by city, g order by date
    rows unbounded preceding) as int) as streak from runs)
select city, date, round(rolling_mape, 6) as rolling_mape, streak from s"""


@query("stream_breach", BREACH_SQL + " where streak >= 3")
def stream_breach(spark, sf_dir):
    """Rolling errors arrive as a stream; keyed state counts the days in a row above the threshold."""
    source, out = scratch_path(spark, "rolling"), scratch_path(spark, "alerts")
    metrics.rolling_accuracy(naive(spark, sf_dir), 7, key="city").write.parquet(source)
    alerts = flows.streak_alerts(flows.read_stream(spark, source), threshold=70.0)
    flows.run_to_parquet(alerts, out, scratch_path(spark, "alerts-checkpoint"))
    return rounded(spark.read.parquet(out), 6, "rolling_mape")


@query("stream_breach_late", BREACH_SQL + " where streak >= 3 and date < (select max(date) from s) - interval 3 day")
def stream_breach_late(spark, sf_dir):
    """The same in event time, with days in any order: what is final when the newest day is three days ahead."""
    source, out = scratch_path(spark, "rolling"), scratch_path(spark, "alerts")
    rolling = metrics.rolling_accuracy(naive(spark, sf_dir), 7, key="city")
    rolling.withColumn("_order", F.xxhash64("city", "date")).sort("_order").drop("_order").write.parquet(source)
    alerts = flows.late_streak_alerts(flows.read_stream(spark, source), threshold=70.0)
    flows.run_to_parquet(alerts, out, scratch_path(spark, "alerts-checkpoint"))
    return rounded(spark.read.parquet(out), 6, "rolling_mape")
