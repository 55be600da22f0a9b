"""Queries: model fits, predictions, intervals, horizon forecasts, attributions and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.config import FEATURE_COLUMNS, TREE_FEATURES, WEATHER_ATTRIBUTION_FEATURES
from tidecast.operators import additive, anomaly, backtest, explain, forecast, metrics, registry, reports, trees
from tidecast.operators.features import build_features
from tidecast.plans import jobs
from tidecast.plans.catalog import PANEL, SCORED, orders_panel, panel, query, rounded
from tidecast.plans.queries_anomaly import residuals
from tidecast.plans.queries_features import features_sql, fill_sql
from tidecast.plans.queries_panel import promo_calendar, weather_payloads
from tidecast.session import scratch_path
from tidecast.sources import panel as panel_io
from tidecast.sources import weather
from tidecast.sources.requests import parse_requests, request_features

_FITTED: dict[tuple[str, str], forecast.DemandForecaster] = {}


def fitted(spark, sf_dir) -> forecast.DemandForecaster:
    """One forecaster per session and data folder, shared by the queries below."""
    where = (spark.sparkContext.applicationId, sf_dir)
    if where not in _FITTED:
        _FITTED[where] = forecast.DemandForecaster().fit(orders_panel(spark, sf_dir))
    return _FITTED[where]


@query(
    "trend_linear",
    f"""with {PANEL}, d as (select city, orders, date_diff('day', date '1995-01-01', date)::double as x from panel)
select city, round(regr_slope(orders, x), 6) as slope, round(regr_intercept(orders, x), 6) as intercept
from d group by 1""",
)
def trend_linear(spark, sf_dir):
    return rounded(additive.fit_linear_trend(orders_panel(spark, sf_dir)), 6, "slope", "intercept")


@query(
    "model_lookup",
    f"""with {PANEL}, d as (select *, date_diff('day', date '1995-01-01', date)::double as x from panel),
p as (select city, regr_slope(orders, x) as a, regr_intercept(orders, x) as b from d
  where city not in ('ASIA', 'EUROPE') group by 1),
f as (select a, b from p order by city limit 1)
select d.date, d.city, d.orders, round(coalesce(p.b, f.b) + coalesce(p.a, f.a) * x, 6) as pred_orders
from d left join p on p.city = d.city, f""",
)
def model_lookup(spark, sf_dir):
    """Two regions have no model and use the first trained one."""
    df = orders_panel(spark, sf_dir)
    params = additive.fit_linear_trend(df.where(~F.col("city").isin("ASIA", "EUROPE")))
    out = additive.predict_linear_trend(df, params)
    return rounded(out.select("date", "city", "orders", "pred_orders"), 6, "pred_orders")


@query(
    "fit_quantiles",
    f"""with {SCORED} select city, round(quantile_cont(residuals, 0.1), 6) as q10,
  round(quantile_cont(residuals, 0.5), 6) as q50, round(quantile_cont(residuals, 0.9), 6) as q90
from resid group by 1""",
)
def fit_quantiles(spark, sf_dir):
    q = forecast.residual_quantiles(residuals(spark, sf_dir), (0.1, 0.5, 0.9))
    cells = [F.round(F.col("quantiles")[i], 6).alias(n) for i, n in enumerate(("q10", "q50", "q90"))]
    return q.select("city", *cells)


def component_columns(spark, sf_dir):
    """Two stand-in component predictions out of the rolling means."""
    feats = build_features(orders_panel(spark, sf_dir))
    return feats.select(
        "date",
        "city",
        "orders",
        F.col("rolling_mean_7").alias("tree_pred"),
        F.col("rolling_mean_28").alias("additive_pred"),
    )


PARTS_SQL = f"""{PANEL}, {features_sql()},
parts as (select city, date, orders, rolling_mean_7 as tree_pred, rolling_mean_28 as additive_pred
  from ({fill_sql(('orders', 'rolling_mean_7', 'rolling_mean_28'), 'feats', 12)}))"""


@query(
    "ensemble_blend",
    f"""with {PARTS_SQL} select date, city,
  round(greatest(0.6::double * tree_pred + 0.4::double * additive_pred, 0), 6) as pred_orders from parts""",
)
def ensemble_blend(spark, sf_dir):
    mean = forecast.blend(F.col("tree_pred"), F.col("additive_pred"), 0.6, 0.4)
    return component_columns(spark, sf_dir).select("date", "city", F.round(mean, 6).alias("pred_orders"))


@query(
    "interval_order",
    f"""with {PARTS_SQL}, b as (select date, city, tree_pred as m, tree_pred + orders - 120 as lo,
    tree_pred + orders % 7 - 3 as mid, tree_pred + 60 - orders as hi from parts)
select date, city, round(m, 6) as pred_orders, round(greatest(least(lo, m), 0), 6) as pred_p10,
  round(greatest(mid, 0), 6) as pred_p50, round(greatest(greatest(hi, m), 0), 6) as pred_p90 from b""",
)
def interval_order(spark, sf_dir):
    """Raw bands on both sides of the mean, put in order."""
    m = F.col("pred_orders")
    raw = component_columns(spark, sf_dir).withColumnRenamed("tree_pred", "pred_orders")
    raw = raw.withColumns(
        {
            "pred_p10": m + F.col("orders") - 120,
            "pred_p50": m + F.col("orders") % 7 - 3,
            "pred_p90": m + 60 - F.col("orders"),
        }
    )
    out = forecast.order_bands(raw, (0.1, 0.5, 0.9))
    names = ("pred_orders", "pred_p10", "pred_p50", "pred_p90")
    return rounded(out.select("date", "city", *names), 6, *names)


WEIGHTS = [0.0, 0.25, 0.5, 0.75, 1.0]


@query(
    "weight_sweep",
    f"""with {PARTS_SQL}, w as (select unnest({WEIGHTS}::double[]) as w),
b as (select w, orders, greatest(w * tree_pred + (1 - w) * additive_pred, 0) as p from parts, w)
select w as tree_weight, round(avg(abs(orders - p) / greatest(orders, 1) * 100), 6) as mape,
  round(sqrt(avg((orders - p) * (orders - p))), 6) as rmse, round(avg(abs(orders - p)), 6) as mae
from b group by w""",
)
def weight_sweep(spark, sf_dir):
    return rounded(metrics.weight_sweep(component_columns(spark, sf_dir), WEIGHTS), 6, "mape", "rmse", "mae")


@query(
    "ab_compare",
    f"""with {PARTS_SQL}, m as (select avg(abs(orders - tree_pred) / greatest(orders, 1) * 100) as mape_a,
    sqrt(avg((orders - tree_pred) * (orders - tree_pred))) as rmse_a, avg(abs(orders - tree_pred)) as mae_a,
    avg(abs(orders - additive_pred) / greatest(orders, 1) * 100) as mape_b,
    sqrt(avg((orders - additive_pred) * (orders - additive_pred))) as rmse_b,
    avg(abs(orders - additive_pred)) as mae_b from parts)
select round(mape_a, 6) as mape_a, round(rmse_a, 6) as rmse_a, round(mae_a, 6) as mae_a, round(mape_b, 6) as mape_b,
  round(rmse_b, 6) as rmse_b, round(mae_b, 6) as mae_b, round(mape_a - mape_b, 6) as mape_a_minus_b,
  round(rmse_a - rmse_b, 6) as rmse_a_minus_b from m""",
)
def ab_compare(spark, sf_dir):
    out = registry.compare_predictions(component_columns(spark, sf_dir), "tree_pred", "additive_pred")
    return rounded(out, 6, *out.columns)


def linear(spark, sf_dir):
    """Features with linear attributions and z-score flags on the deviation from the 28-row mean."""
    feats = jobs.materialize(build_features(orders_panel(spark, sf_dir)), "features")
    explained = explain.linear_attributions(feats, explain.fit_linear_effects(feats))
    return explained.withColumn("residuals", F.col("orders") - F.col("rolling_mean_28"))


LINEAR_SQL = f"""{PANEL}, {features_sql()},
filled as ({fill_sql(('orders', *FEATURE_COLUMNS), 'feats', 12)}),
fx as (select {', '.join(f'case when max({c}) > min({c}) then regr_slope(orders, {c}) else 0 end as s_{c}, avg({c}) as m_{c}' for c in FEATURE_COLUMNS)}
  from filled),
attr as (select date, city, orders, rolling_mean_28, {', '.join(f's_{c} * ({c} - m_{c}) as a_{c}' for c in FEATURE_COLUMNS)}
  from filled, fx)"""
DRIVER_LIST_SQL = "list_sort([" + ", ".join(
    f"{{'r': -abs(a_{c}), 'i': {i}, 'f': '{c}', 'v': a_{c}}}" for i, c in enumerate(FEATURE_COLUMNS)
) + "])"


@query(
    "top_drivers",
    f"""with {LINEAR_SQL}, d as (select date, city, {DRIVER_LIST_SQL} as l from attr),
e as (select date, city, unnest([1, 2, 3, 4, 5]) as rank, unnest(l[1:5]) as x from d)
select date, city, rank::int as rank, x.f as feature, round(x.v, 4) as attribution from e""",
)
def top_drivers(spark, sf_dir):
    out = explain.drivers_long(explain.top_drivers(linear(spark, sf_dir), 5), ["date", "city"])
    return rounded(out, 4, "attribution")


@query(
    "weather_attribution",
    f"""with {LINEAR_SQL} select date, city,
  round({' + '.join(f'a_{c}' for c in WEATHER_ATTRIBUTION_FEATURES)}, 4) as weather_attribution from attr""",
)
def weather_attribution(spark, sf_dir):
    out = explain.weather_attribution(linear(spark, sf_dir)).select("date", "city", "weather_attribution")
    return rounded(out, 4, "weather_attribution")


@query(
    "global_importance",
    f"""with {LINEAR_SQL}, g as (select {', '.join(f'avg(abs(a_{c})) as {c}' for c in FEATURE_COLUMNS)} from attr),
u as (unpivot g on {', '.join(FEATURE_COLUMNS)} into name feature value v)
select feature, round(v, 4) as mean_abs_attribution from u order by v desc limit 15""",
)
def global_importance(spark, sf_dir):
    return rounded(explain.global_importance(linear(spark, sf_dir), 15), 4, "mean_abs_attribution")


@query(
    "drilldown_linear",
    f"""with {LINEAR_SQL}, r as (select *, orders - rolling_mean_28 as residuals from attr),
b as (select avg(residuals) as m, greatest(stddev_pop(residuals), 1e-6) as s from r),
d as (select date, city, residuals, {DRIVER_LIST_SQL} as l from r, b where abs((residuals - m) / s) >= 2.5),
e as (select date, city, residuals, unnest([1, 2, 3]) as rank, unnest(l[1:3]) as x from d)
select date, city, round(residuals, 4) as residuals, rank::int as rank, x.f as feature, round(x.v, 4) as attribution
from e""",
)
def drilldown_linear(spark, sf_dir):
    """Flagged rows with their top three drivers."""
    flagged = anomaly.detect_zscore(linear(spark, sf_dir))
    out = explain.drivers_long(explain.anomaly_drilldown(flagged, 3), ["date", "city", "residuals"])
    return rounded(out, 4, "residuals", "attribution")


# Fitted models: no SQL twin, rows and properties are tested.
@query("fit_trees")
def fit_trees(spark, sf_dir):
    """Node table of the boosted trees."""
    return trees.node_table(spark, fitted(spark, sf_dir).tree_model)


@query("fit_additive")
def fit_additive(spark, sf_dir):
    """One coefficient row per nation."""
    params = additive.fit_additive(orders_panel(spark, sf_dir, "nation"))
    return params.select("city", "origin", "span", F.size("coef").alias("terms"), "sigma")


@query("additive_predict")
def additive_predict(spark, sf_dir):
    df = orders_panel(spark, sf_dir, "nation")
    out = additive.predict_additive(df, additive.fit_additive(df))
    return out.select("date", "city", "orders", "additive_pred", "additive_sigma")


@query("ensemble_predict")
def ensemble_predict(spark, sf_dir):
    out = fitted(spark, sf_dir).predict(orders_panel(spark, sf_dir))
    return out.select("date", "city", "orders", "tree_pred", "additive_pred", "pred_orders")


@query("predict_intervals")
def predict_intervals(spark, sf_dir):
    out = fitted(spark, sf_dir).predict_intervals(orders_panel(spark, sf_dir))
    return out.select("date", "city", "orders", "pred_orders", "pred_p10", "pred_p50", "pred_p90")


@query("predict_requests")
def predict_requests(spark, sf_dir):
    """Requests for the week behind the history, scored with features from the stored tail."""
    model, history = fitted(spark, sf_dir), orders_panel(spark, sf_dir)
    asked = model.horizon_rows(history, 7).select(
        F.to_json(F.struct(F.col("date").cast("string").alias("date"), "city", "temperature_c")).alias("request")
    )
    feats = request_features(parse_requests(asked), history, model.encoding)
    out = model.predict_intervals(feats)
    return out.select("date", "city", "orders_lag_1", "pred_orders", "pred_p10", "pred_p90")


@query("forecast_future")
def forecast_future(spark, sf_dir):
    """Fourteen days per region with the weather feed and the promo calendar laid over them."""
    history = orders_panel(spark, sf_dir)
    feed = weather.extend_horizon(weather.parse_payloads(weather_payloads(spark, sf_dir)), 45, ["city", "month"])
    out = fitted(spark, sf_dir).forecast_future(
        history, 14, weather=feed, promos=promo_calendar(spark, sf_dir)
    )
    return out.select(
        "date", "city", "temperature_c", "promo_active", "pred_orders", "pred_p10", "pred_p50", "pred_p90"
    )


@query("forecast_nested_future")
def forecast_nested_future(spark, sf_dir):
    """The next fourteen days of every region as one ordered list each."""
    future = fitted(spark, sf_dir).forecast_future(orders_panel(spark, sf_dir), 14)
    return reports.nested_forecast(future)


@query("walk_forward_eval")
def walk_forward_eval(spark, sf_dir):
    """Fold metrics of the ensemble against lag 7."""
    return backtest.fold_metrics(validated(spark, sf_dir))


@query("attributions")
def attributions(spark, sf_dir):
    """Shapley attributions of the tree prediction, one row per (date, city, feature)."""
    model = fitted(spark, sf_dir)
    feats = model.tree_features(orders_panel(spark, sf_dir))
    scored = trees.predict_trees(model.tree_model, trees.with_attributions(feats, model.nodes(spark)))
    names = F.array(*[F.lit(c) for c in TREE_FEATURES])
    return scored.select(
        "date",
        "city",
        "tree_pred",
        "base_value",
        F.explode(F.arrays_zip(names.alias("feature"), F.col("attributions").alias("attribution"))).alias("a"),
    ).select("date", "city", "tree_pred", "base_value", "a.feature", "a.attribution")


@query("tree_importance")
def tree_importance(spark, sf_dir):
    model = fitted(spark, sf_dir)
    feats = model.tree_features(orders_panel(spark, sf_dir))
    return explain.global_importance(trees.with_attributions(feats, model.nodes(spark)), 15)


@query("anomaly_drilldown")
def anomaly_drilldown(spark, sf_dir):
    """Days the hybrid detector flags, with the top three drivers of their prediction."""
    model = fitted(spark, sf_dir)
    scored = jobs.materialize(
        anomaly.add_residuals(model.predict(orders_panel(spark, sf_dir))), "residuals"
    )
    flagged = anomaly.HybridDetector().fit(scored).transform(scored).where("is_anomaly")
    out = explain.anomaly_drilldown(trees.with_attributions(flagged, model.nodes(spark)), 3)
    return explain.drivers_long(out, ["date", "city", "orders", "pred_orders", "anomaly_type"])


@query("history_scores")
def history_scores(spark, sf_dir):
    """Full history scored by the fitted ensemble and detector."""
    model, df = fitted(spark, sf_dir), orders_panel(spark, sf_dir)
    base = jobs.materialize(anomaly.add_residuals(model.predict(df)).select("date", "city", "residuals"), "residuals")
    out = jobs.score_history(df, model, anomaly.HybridDetector().fit(base))
    names = ("pred_orders", "pred_p10", "pred_p90", "residuals", "is_anomaly", "anomaly_score", "anomaly_type")
    return out.select("date", "city", "orders", *names, "year_month")


@query("registry_compare")
def registry_compare(spark, sf_dir):
    """Two registered versions of different blend weights, compared on the whole panel."""
    df, model = orders_panel(spark, sf_dir), fitted(spark, sf_dir)
    versions = registry.ModelRegistry(spark, scratch_path(spark, "registry"))
    versions.register(model, "v1", "default weights")
    path = scratch_path(spark, "forecaster")
    model.save(path)
    other = forecast.DemandForecaster.load(spark, path)
    other.tree_weight, other.additive_weight = 0.3, 0.7
    versions.register(other, "v2", "more additive")
    return versions.compare("v1", "v2", df)


@query("daily_job")
def daily_job(spark, sf_dir):
    """The end-to-end job on the panel written as CSV; returns the label evaluation."""
    base = scratch_path(spark, "job")
    panel_io.write_orders_and_labels(panel(spark, sf_dir), f"{base}/orders", f"{base}/labels")
    return jobs.run_daily_job(spark, f"{base}/orders", f"{base}/out", f"{base}/labels").evaluation


# Facts about the fitted models that SQL can tell from the panel alone.
_VALIDATED: dict[tuple[str, str], DataFrame] = {}


def validated(spark, sf_dir) -> DataFrame:
    """Validation rows of all folds, once per session and data folder."""
    where = (spark.sparkContext.applicationId, sf_dir)
    if where not in _VALIDATED:
        _VALIDATED[where] = jobs.walk_forward_predictions(orders_panel(spark, sf_dir))
    return _VALIDATED[where]


@query(
    "walk_forward_baseline",
    f"""with {PANEL}, dates as (select distinct date from panel),
ranked as (select date, row_number() over (order by date) as i, count(*) over () as n from dates),
folded as (select date, 5 - cast(floor((n - i) / floor(n / 6)) as bigint) as fold from ranked),
naive as (select p.date, city, orders, coalesce(lag(orders, 7) over (partition by city order by p.date), 0)::double as pred,
    fold from panel p join folded using (date))
select fold::int as fold, min(date) as val_start, max(date) as val_end, count(*) as n_rows,
  round(avg(abs(orders - pred) / greatest(orders, 1) * 100), 6) as mape_baseline,
  round(sqrt(avg((orders - pred) * (orders - pred))), 6) as rmse_baseline
from naive where fold > 0 group by 1""",
    python=True,
)
def walk_forward_baseline(spark, sf_dir):
    """Rows that each fold validates, and the baseline's errors on them, out of the validation table."""
    err = F.col("orders") - F.col("pred_baseline")
    out = validated(spark, sf_dir).where("pred_model is not null and pred_model >= 0").groupBy("fold").agg(
        F.min("date").alias("val_start"),
        F.max("date").alias("val_end"),
        F.count("*").alias("n_rows"),
        F.avg(metrics.absolute_percentage_error(pred="pred_baseline")).alias("mape_baseline"),
        F.sqrt(F.avg(err * err)).alias("rmse_baseline"),
    )
    return rounded(out, 6, "mape_baseline", "rmse_baseline")


@query(
    "attribution_sums",
    f"with {PANEL} select date, city, {len(TREE_FEATURES)}::bigint as n_features, true as adds_up from panel",
    python=True,
)
def attribution_sums(spark, sf_dir):
    """Whether base value and attributions of a row add up to its tree prediction."""
    rows = attributions(spark, sf_dir).groupBy("date", "city").agg(
        F.count("attribution").alias("n_features"),
        (F.sum("attribution") + F.first("base_value") - F.first("tree_pred")).alias("gap"),
    )
    return rows.select("date", "city", "n_features", (F.abs("gap") < 1e-3).alias("adds_up"))


@query(
    "interval_facts",
    f"with {PANEL} select date, city, orders, true as ordered, true as blended from panel",
    python=True,
)
def interval_facts(spark, sf_dir):
    """Whether the bands enclose the mean, and the mean is the weighted one of its parts."""
    out = fitted(spark, sf_dir).predict_intervals(orders_panel(spark, sf_dir))
    mean = F.greatest(0.6 * F.col("tree_pred") + 0.4 * F.col("additive_pred"), F.lit(0.0))
    inside = (F.col("pred_p10") <= F.col("pred_orders")) & (F.col("pred_orders") <= F.col("pred_p90")) & (F.col("pred_p10") >= 0)
    return out.select("date", "city", "orders", inside.alias("ordered"), (F.abs(mean - F.col("pred_orders")) < 1e-9).alias("blended"))


@query(
    "forecast_grid",
    f"""with {PANEL}, ends as (select city, max(date) as last, avg(temperature_c) as t from panel group by 1)
select city, cast(last + cast(d as integer) as date) as date, round(t, 6) as temperature_c, true as known
from ends, range(1, 121) as days(d)""",
    python=True,
)
def forecast_grid(spark, sf_dir):
    """The rows of a horizon of 120 days, each with a prediction."""
    out = fitted(spark, sf_dir).forecast_future(orders_panel(spark, sf_dir), 120)
    known = F.col("pred_orders").isNotNull() & ~F.isnan("pred_orders") & (F.col("pred_p10") <= F.col("pred_p90"))
    return rounded(out.select("city", "date", "temperature_c", known.alias("known")), 6, "temperature_c")


@query(
    "request_rows",
    f"""with {PANEL}, ends as (select city, max(date) as last,
    max_by(orders, date)::double as y from panel group by 1)
select city, cast(last + cast(d as integer) as date) as date, y as orders_lag_1, count(*) as n, true as scored
from ends, range(1, 8) as days(d) group by 1, 2, 3""",
    python=True,
)
def request_rows(spark, sf_dir):
    """One scored row for each request of the week."""
    out = predict_requests(spark, sf_dir).groupBy("city", "date", "orders_lag_1")
    return out.agg(F.count("*").alias("n"), F.bool_and(F.col("pred_orders") >= 0).alias("scored"))
