"""Queries: error metrics, benchmark tables, drift, planning and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.operators import anomaly, backtest, drift, metrics, planning, reports
from tidecast.plans.catalog import PANEL, SCORED, labels, orders_panel, panel, panel_sql, query, rounded
from tidecast.sources import exports

ERRORS_SQL = """round(avg(abs(orders - pred_orders) / greatest(orders, 1) * 100), 6) as mape,
  round(sqrt(avg((orders - pred_orders) * (orders - pred_orders))), 6) as rmse,
  round(avg(abs(orders - pred_orders)), 6) as mae"""
ERRORS = ("mape", "rmse", "mae")


def scored(spark, sf_dir):
    """Lag-7 predictions, residuals, pooled z-score and flags."""
    df = backtest.naive_baseline(orders_panel(spark, sf_dir)).where("pred_orders is not null")
    return anomaly.detect_zscore(anomaly.add_residuals(df))


def naive(spark, sf_dir):
    return backtest.naive_baseline(orders_panel(spark, sf_dir)).where("pred_orders is not null")


@query("error_metrics", f"with {SCORED} select count(*) as n, {ERRORS_SQL} from resid")
def error_metrics(spark, sf_dir):
    return rounded(metrics.error_metrics(naive(spark, sf_dir)), 6, *ERRORS)


@query(
    "metrics_grouping_sets",
    f"""with {SCORED} select 'global' as scope, 'ALL' as city, count(*) as n, {ERRORS_SQL} from resid
union all select 'series', city, count(*), {ERRORS_SQL} from resid group by city""",
)
def metrics_grouping_sets(spark, sf_dir):
    return rounded(metrics.scoped_metrics(naive(spark, sf_dir)), 6, *ERRORS)


BANDS_SQL = """coalesce(pred_orders * 0.9, 0) as pred_p10, coalesce(pred_orders * 1.1, 0) as pred_p90"""


@query(
    "pred_fallback",
    f"""with {PANEL}, l as (select *, lag(orders, 7) over (partition by city order by date) as l7 from panel)
select date, city, cast(coalesce(l7, orders) as double) as pred_orders,
  round(0.9::double * coalesce(l7, orders), 6) as pred_p10, round(1.1::double * coalesce(l7, orders), 6) as pred_p90 from l""",
)
def pred_fallback(spark, sf_dir):
    """No model: lag 7 or the actual value, with a band of ten percent."""
    df = reports.with_fallbacks(
        backtest.naive_baseline(orders_panel(spark, sf_dir)).withColumnRenamed("pred_orders", "orders_lag_7")
    )
    return rounded(df.select("date", "city", "pred_orders", "pred_p10", "pred_p90"), 6, "pred_p10", "pred_p90")


@query(
    "interval_coverage",
    f"""with {SCORED} select round(avg((orders between pred_orders * 0.5 and pred_orders * 1.5)::int), 6) as coverage,
  0.8::double as target_coverage from resid""",
)
def interval_coverage(spark, sf_dir):
    df = naive(spark, sf_dir).withColumns(
        {"pred_p10": F.col("pred_orders") * 0.5, "pred_p90": F.col("pred_orders") * 1.5}
    )
    return rounded(metrics.interval_coverage(df), 6, "coverage")


@query(
    "kpi_panel",
    f"""with {SCORED} select round(avg(abs(residuals) / greatest(orders, 1) * 100), 6) as mape,
  round(sqrt(avg(residuals * residuals)), 6) as rmse, count(*) filter (is_anomaly) as anomalies,
  cast(sum(orders) as bigint) as volume
from scored where city = 'ASIA' and date between date '1997-01-01' and date '1999-12-31'""",
)
def kpi_panel(spark, sf_dir):
    part = scored(spark, sf_dir).where("city = 'ASIA' and date between date'1997-01-01' and date'1999-12-31'")
    return rounded(metrics.kpi_panel(part), 6, "mape", "rmse")


@query(
    "city_benchmark",
    f"""with {SCORED}, t as (select city, floor(avg(orders))::int as avg_daily_orders,
    cast(sum(orders) as bigint) as total_volume,
    round_even(avg(abs(residuals) / greatest(orders, 1) * 100), 2) as mape,
    round_even(sqrt(avg(residuals * residuals)), 1) as rmse,
    round_even(100.0 * (count(*) filter (is_anomaly)) / count(*), 2) as anomaly_pct from scored group by 1)
select *, round(avg_daily_orders::double / max(avg_daily_orders) over () * 40, 6) as marker_size from t""",
)
def city_benchmark(spark, sf_dir):
    return rounded(metrics.city_benchmark(scored(spark, sf_dir)), 6, "marker_size")


@query(
    "mape_city_month",
    f"""with {SCORED}, c as (select city, strftime(date, '%Y-%m') as year_month,
    round_even(avg(abs(residuals) / greatest(orders, 1) * 100), 2) as mape from scored group by 1, 2),
m as (select distinct year_month from c order by 1 desc limit 12)
select city, m.year_month, mape from (select distinct city from c) cross join m
  left join c using (city, year_month)""",
)
def mape_city_month(spark, sf_dir):
    return metrics.mape_by_month(scored(spark, sf_dir))


@query(
    "benchmark_table",
    f"""with {SCORED} select date, city, orders, pred_orders, residuals, is_anomaly,
  strftime(date, '%Y-%m') as year_month from scored""",
)
def benchmark_table(spark, sf_dir):
    return (
        scored(spark, sf_dir)
        .withColumn("year_month", F.date_format("date", "yyyy-MM"))
        .select("date", "city", "orders", "pred_orders", "residuals", "is_anomaly", "year_month")
    )


@query(
    "city_describe",
    f"""with {PANEL} select city, count(orders) as count, round(avg(orders), 6) as mean,
  round(stddev_samp(orders), 6) as std, min(orders)::double as min,
  round(quantile_cont(orders::double, 0.25), 6) as p25, round(quantile_cont(orders::double, 0.5), 6) as p50,
  round(quantile_cont(orders::double, 0.75), 6) as p75, max(orders)::double as max from panel group by 1""",
)
def city_describe(spark, sf_dir):
    return rounded(metrics.describe_by_city(orders_panel(spark, sf_dir)), 6, "mean", "std", "p25", "p50", "p75")


@query(
    "uplift_flags",
    f"""with {PANEL} select 'is_rainy' as flag, is_rainy as value, count(*) as n, round(avg(orders), 6) as mean_orders
  from panel group by is_rainy
union all select 'promo_active', promo_active, count(*), round(avg(orders), 6) from panel group by promo_active""",
)
def uplift_flags(spark, sf_dir):
    out = rounded(metrics.flag_uplift(orders_panel(spark, sf_dir)), 6, "mean_orders")
    return out.withColumn("n", F.col("n").cast("bigint"))


@query(
    "anomaly_share",
    f"""with {PANEL} select count(*) as rows, cast(sum(is_anomaly) as bigint) as anomalies,
  round(100.0 * sum(is_anomaly) / count(*), 6) as anomaly_pct from panel""",
)
def anomaly_share(spark, sf_dir):
    return rounded(metrics.label_share(orders_panel(spark, sf_dir), labels(spark, sf_dir)), 6, "anomaly_pct")


@query(
    "panel_profile",
    f"""with {PANEL} select city, min(date) as first_date, max(date) as last_date, count(*) as rows,
  count(distinct date) as distinct_dates from panel group by 1""",
)
def panel_profile(spark, sf_dir):
    return metrics.panel_profile(orders_panel(spark, sf_dir))


DAILY_SQL = f"""{SCORED}, daily as (select date, avg(abs(residuals) / greatest(orders, 1) * 100) as ape
  from resid group by 1),
rolling as (select date, avg(ape) over (order by date range between interval 29 days preceding and current row)
  as rolling_mape from daily)"""


@query("rolling_mape", f"with {DAILY_SQL} select date, round(rolling_mape, 6) as rolling_mape from rolling")
def rolling_mape(spark, sf_dir):
    return rounded(metrics.rolling_accuracy(naive(spark, sf_dir)), 6, "rolling_mape")


@query(
    "rolling_mape_by_city",
    f"""with {SCORED}, daily as (select city, date, avg(abs(residuals) / greatest(orders, 1) * 100) as ape
  from resid group by 1, 2)
select city, date, round(avg(ape) over (partition by city order by date
  range between interval 6 days preceding and current row), 6) as rolling_mape from daily""",
)
def rolling_mape_by_city(spark, sf_dir):
    return rounded(metrics.rolling_accuracy(naive(spark, sf_dir), 7, key="city"), 6, "rolling_mape")


@query(
    "perf_drift",
    f"""with {DAILY_SQL}, newest as (select * from rolling order by date desc limit 3)
select count(*) as days, round(min(rolling_mape), 6) as min_mape, count(*) >= 3 and min(rolling_mape) > 8.0 as drift
from newest""",
)
def perf_drift(spark, sf_dir):
    out = drift.performance_drift(metrics.rolling_accuracy(naive(spark, sf_dir)))
    return rounded(out, 6, "min_mape")


@query(
    "perf_drift_history",
    f"""with {DAILY_SQL} select date, round(rolling_mape, 6) as rolling_mape,
  count(*) over w >= 3 and min(rolling_mape) over w > 95.0 as drift
from rolling window w as (order by date rows between 2 preceding and current row)""",
)
def perf_drift_history(spark, sf_dir):
    out = drift.drift_history(metrics.rolling_accuracy(naive(spark, sf_dir)), threshold=95.0)
    return rounded(out, 6, "rolling_mape")


def _psi_sql(split: str, panel: str = PANEL) -> str:
    # Deciles times 10, in whole numbers.
    edge = "l[(n - 1) * i // 10 + 1] * (10 - (n - 1) * i % 10) + coalesce(l[(n - 1) * i // 10 + 2], 0) * ((n - 1) * i % 10)"
    return f"""with {panel}, b as (select city, orders as x from panel where date < date '{split}'),
n as (select city, orders as x from panel where date >= date '{split}'),
v as (select city, list(x order by x) as l, count(x) as n from b where x is not null group by 1),
e as (select city, list_sort(list_distinct(list_transform(range(11), lambda i: {edge}))) as e, n as nb from v),
k as (select city, case when len(e) < 2 then 1 else len(e) - 1 end as bins, e, nb from e),
side as (select 'b' as s, city, x from b union all select 'n', city, x from n),
placed as (select s, k.city, case when len(e) < 2 then case when x >= 0 then 0 end
    else len(list_filter(e[2:len(e)-1], lambda v: v <= 10 * x)) end as bin from side join k using (city)),
cnt as (select s, city, bin, count(*) as c from placed group by 1, 2, 3),
tot as (select city, count(*) filter (s = 'b') as tb, count(*) filter (s = 'n') as tn from placed group by 1),
grid as (select city, unnest(range(bins)) as bin from k),
sh as (select g.city, greatest(coalesce(cb.c, 0) / tb, 1e-6) as p, greatest(coalesce(cn.c, 0) / tn, 1e-6) as q
  from grid g join tot using (city) left join cnt cb on cb.city = g.city and cb.bin = g.bin and cb.s = 'b'
  left join cnt cn on cn.city = g.city and cn.bin = g.bin and cn.s = 'n' where tb > 0 and tn > 0)
select city, round(sum((q - p) * ln(q / p)), 6) as psi, sum((q - p) * ln(q / p)) > 0.2 as drifted from sh group by 1"""


@query("psi_by_city", _psi_sql("1999-01-01"))
def psi_by_city(spark, sf_dir):
    df = orders_panel(spark, sf_dir)
    out = drift.population_stability(
        df.where(F.col("date") >= "1999-01-01"), df.where(F.col("date") < "1999-01-01")
    )
    return rounded(out, 6, "psi")


@query("psi_by_part", _psi_sql("1999-01-01", panel_sql("part")))
def psi_by_part(spark, sf_dir):
    """The same for as many series as there are parts."""
    df = orders_panel(spark, sf_dir, "part")
    out = drift.population_stability(
        df.where(F.col("date") >= "1999-01-01"), df.where(F.col("date") < "1999-01-01")
    )
    return rounded(out, 6, "psi")


HORIZON_SQL = f"""{SCORED}, horizon as (select date, city, pred_orders, round(pred_orders * 0.8, 4) as pred_p10,
  round(pred_orders * (1 + (0.1 + (orders % 4) * 0.1)), 4) as pred_p90 from resid)"""


def horizon(spark, sf_dir):
    """Predictions with a band of varying width, for the planning tables."""
    mean = F.col("pred_orders")
    return naive(spark, sf_dir).select(
        "date",
        "city",
        "pred_orders",
        F.round(mean * 0.8, 4).alias("pred_p10"),
        F.round(mean * (1 + (0.1 + (F.col("orders") % 4) * 0.1)), 4).alias("pred_p90"),
    )


PLAN_SQL = """case when pred_orders > 0 then (pred_p90 - pred_orders) / pred_orders else 0 end as spread"""
PLAN_COLUMNS_SQL = """cast(ceil(pred_p90 * (1.0 + 10.0::double / 100.0)) as bigint) as recommended_inventory,
  cast(ceil((pred_orders + pred_p90) / 2.0) as bigint) as reorder_point,
  case when spread < 0.15 then 'Low' when spread < 0.30 then 'Medium' else 'High' end as risk_level"""


@query(
    "capacity_plan",
    f"""with {HORIZON_SQL}, s as (select *, {PLAN_SQL} from horizon), p as (select *, {PLAN_COLUMNS_SQL} from s)
select date, city, pred_orders, pred_p90, recommended_inventory, reorder_point, risk_level,
  round(pred_orders * 2.0, 6) as expected_cost, round(recommended_inventory * 2.0::double, 6) as max_exposed_cost from p""",
)
def capacity_plan(spark, sf_dir):
    out = planning.recommend_capacity(horizon(spark, sf_dir).drop("pred_p10"), unit_cost=2.0)
    return rounded(out, 6, "expected_cost", "max_exposed_cost")


@query(
    "export_capacity",
    f"""with {HORIZON_SQL}, s as (select *, {PLAN_SQL} from horizon), p as (select *, {PLAN_COLUMNS_SQL} from s)
select strftime(date, '%Y-%m-%d') as date, city, round_even(pred_orders, 1) as pred_orders,
  round_even(pred_p90, 1) as pred_p90, recommended_inventory, reorder_point, risk_level,
  recommended_inventory * 1.0::double as max_exposed_cost from p""",
)
def export_capacity(spark, sf_dir):
    return exports.capacity_export(planning.recommend_capacity(horizon(spark, sf_dir)))


@query(
    "export_results",
    f"""with {SCORED} select date, city, orders, pred_orders, round(pred_orders * 0.9, 6) as pred_p10,
  round(pred_orders * 1.1, 6) as pred_p90, residuals, is_anomaly, anomaly_type,
  replace(lower(city), ' ', '_') || '_results.csv' as file_name from scored""",
)
def export_results(spark, sf_dir):
    df = scored(spark, sf_dir).withColumns(
        {"pred_p10": F.round(F.col("pred_orders") * 0.9, 6), "pred_p90": F.round(F.col("pred_orders") * 1.1, 6)}
    )
    out = exports.results_export(df)
    return out.withColumn("file_name", F.concat(exports.file_slug(F.col("city")), F.lit("_results.csv")))


@query(
    "forecast_nested",
    f"""with {HORIZON_SQL}, r as (select *, row_number() over (partition by city order by date desc) as i from horizon)
select city, '[' || string_agg('{{"date":"' || strftime(date, '%Y-%m-%d') || '","pred_mean":' ||
  printf('%.2f', pred_orders) || ',"pred_p10":' || printf('%.2f', pred_p10) || '}}', ',' order by date) || ']'
  as forecasts from r where i <= 14 group by city""",
)
def forecast_nested(spark, sf_dir):
    """The newest 14 predictions of each series as one ordered JSON list."""
    newest = reports.last_horizon(horizon(spark, sf_dir), 14)
    nested = reports.nested_forecast(newest)
    item = F.transform(
        "forecasts",
        lambda f: F.format_string(
            '{"date":"%s","pred_mean":%.2f,"pred_p10":%.2f}',
            F.date_format(f["date"], "yyyy-MM-dd"),
            f["pred_mean"],
            f["pred_p10"],
        ),
    )
    return nested.select("city", F.concat(F.lit("["), F.array_join(item, ","), F.lit("]")).alias("forecasts"))


DIGEST_SQL = f"""{SCORED}, ev as (select city, date, anomaly_type, '### ' || case anomaly_type when 'surge' then '📈'
    when 'dip' then '📉' else '⚠️' end || ' ' || upper(anomaly_type) || ' on ' || strftime(date, '%Y-%m-%d') || chr(10)
    || '- **Severity Score:** `' || printf('%.2f', 0.6 * z_score) || '`' || chr(10)
    || '- **Actual Orders:** `' || printf('%.1f', orders::double) || '`' || chr(10)
    || '- **Expected Orders:** `' || printf('%.1f', pred_orders) || '`' || chr(10)
    || '- **Deviation:** `' || case when residuals >= 0 then '+' else '' end || printf('%.1f', residuals)
    || '` orders' || chr(10) as event from scored where is_anomaly)"""


@query(
    "anomaly_digest",
    f"""with {DIGEST_SQL}, c as (select distinct city from scored),
g as (select city, count(*) as n, count(*) filter (anomaly_type = 'surge') as s,
    count(*) filter (anomaly_type = 'dip') as d, string_agg(event, chr(10) order by date desc) as events
  from ev group by 1)
select c.city, case when n is null then '# 🟢 Anomaly Alert Digest: ' || c.city || chr(10) || chr(10) ||
    '**Status:** All Clear' || chr(10) || 'No operational anomalies detected in the selected time window.' || chr(10)
  else '# 🚨 Anomaly Alert Digest: ' || c.city || chr(10) || chr(10) || '**Summary:** Detected **' || n ||
    '** total anomaly events (' || s || ' surges, ' || d || ' dips).' || chr(10) || chr(10) || '## Detailed Events'
    || chr(10) || chr(10) || events || chr(10) || '---' || chr(10) || '*Generated by automated reporting*' end as digest
from c left join g on g.city = c.city""",
)
def anomaly_digest(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("anomaly_score", 0.6 * F.col("z_score"))
    return reports.anomaly_digest(df)


@query(
    "digest_events",
    f"with {DIGEST_SQL} select city, date, anomaly_type, event from ev",
)
def digest_events(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("anomaly_score", 0.6 * F.col("z_score"))
    return reports.digest_events(df).select("city", "date", "anomaly_type", "event")


@query(
    "model_card",
    f"""with {SCORED}, m as (select city, residuals, orders, pred_orders, is_anomaly from scored),
g as (select {ERRORS_SQL}, round(avg((orders between pred_orders * 0.5 and pred_orders * 1.5)::int), 6) as coverage,
  round(avg(is_anomaly::int), 6) as flag_rate from m),
c as (select city, {ERRORS_SQL} from m group by city)
select 'global' as scope, 'ALL' as city, unnest(['mape', 'rmse', 'mae']) as metric, unnest([mape, rmse, mae]) as value from g
union all select 'series', city, unnest(['mape', 'rmse', 'mae']), unnest([mape, rmse, mae]) from c
union all select 'calibration', 'ALL', unnest(['p10_p90_coverage', 'target_coverage']), unnest([coverage, 0.8::double]) from g
union all select 'anomaly', 'ALL', 'flag_rate', flag_rate from g
union all select 'metadata', 'ALL', 'age_days', 10.0::double from g""",
)
def model_card(spark, sf_dir):
    df = scored(spark, sf_dir).withColumns(
        {"pred_p10": F.col("pred_orders") * 0.5, "pred_p90": F.col("pred_orders") * 1.5}
    )
    return rounded(reports.model_card(df, age_days=10.0), 6, "value")
