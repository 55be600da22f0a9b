"""Queries: engineered features, fill chain, encodings, folds and decomposition."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.config import (
    CALENDAR_FEATURES,
    FEATURE_COLUMNS,
    INTERACTION_FEATURES,
    LAG_FEATURES,
    LAGS,
    RATIO_FEATURES,
    ROLLING_FEATURES,
    ROLLING_WINDOWS,
    WEATHER_COLUMN_FEATURES,
)
from tidecast.functions.columns import finite_or_zero
from tidecast.operators import backtest, decompose, features
from tidecast.operators.fill import fill_chain
from tidecast.plans.catalog import PANEL, SCORED, orders_panel, panel_sql, query, rounded
from tidecast.session import scratch_path
from tidecast.sources import panel as panel_io
from tidecast.sources.exports import write_csv

RAW_COLUMNS = (
    "orders",
    "temperature_c",
    "rainfall_mm",
    "is_rainy",
    "is_holiday",
    "festival_flag",
    "promo_active",
)
CALENDAR_SQL = """isodow(date)::int - 1 as dow, month(date)::int as month, day(date)::int as day,
  dayofyear(date)::int as day_of_year, weekofyear(date)::int as week_of_year, quarter(date)::int as quarter,
  (isodow(date) >= 6)::int as is_weekend, (isodow(date) = 5)::int as is_friday,
  (day(date) = 1)::int as is_month_start, (last_day(date) = date)::int as is_month_end,
  round(sin(2*pi()*dayofyear(date)/365.25), 6) as sin_doy, round(cos(2*pi()*dayofyear(date)/365.25), 6) as cos_doy"""
LAGS_SQL = ", ".join(
    f"cast(lag(orders, {n}) over (partition by city order by date) as double) as orders_lag_{n}" for n in LAGS
)


def _rolling_sql(digits: int | None) -> str:
    out = []
    for w in ROLLING_WINDOWS:
        over = f"over (partition by city order by date rows between {w} preceding and 1 preceding)"
        cells = {
            "mean": f"avg(orders) {over}",
            "std": f"coalesce(stddev_samp(orders) {over}, 0.0)",
            "min": f"cast(min(orders) {over} as double)",
            "max": f"cast(max(orders) {over} as double)",
        }
        for stat, sql in cells.items():
            sql = f"round({sql}, {digits})" if digits and stat in ("mean", "std") else sql
            out.append(f"{sql} as rolling_{stat}_{w}")
    return ", ".join(out)


WEATHER_SQL = """temperature_c * temperature_c as temp_sq, temperature_c - 15.0 as temp_deviation,
  ln(1 + greatest(rainfall_mm, 0.0)) as log_rainfall, rainfall_mm * is_rainy as rain_intensity"""
INTERACTION_SQL = """promo_active * (isodow(date) >= 6)::int as promo_x_weekend,
  promo_active * is_rainy as promo_x_rainy, festival_flag * is_rainy as festival_x_rainy,
  is_holiday * (isodow(date) >= 6)::int as holiday_x_weekend, promo_active * is_holiday as promo_x_holiday"""


def features_sql(source: str = "panel", enc: str = "avg(orders) over (partition by city)") -> str:
    """CTEs windowed, feats: all features before the fill chain."""
    return f"""windowed as (select city, date, {', '.join(RAW_COLUMNS)}, {LAGS_SQL}, {_rolling_sql(None)},
    {enc} as city_target_enc from {source}),
feats as (select *, {CALENDAR_SQL}, {WEATHER_SQL}, {INTERACTION_SQL},
    orders_lag_1 / (orders_lag_7 + 1.0) as lag_7_ratio,
    rolling_mean_7 / (rolling_mean_28 + 1.0) as rolling_ratio_7_28 from windowed)"""


FLOATS = (
    *ROLLING_FEATURES,
    "city_target_enc",
    *WEATHER_COLUMN_FEATURES,
    *RATIO_FEATURES,
    "sin_doy",
    "cos_doy",
)


def fill_sql(columns, source: str, digits: int = 6) -> str:
    out = []
    for c in columns:
        cell = (
            f"coalesce(first_value({c} ignore nulls) over (order by city, date rows between current row and unbounded following), "
            f"last_value({c} ignore nulls) over (order by city, date rows between unbounded preceding and current row), 0)"
        )
        out.append(f"round({cell}, {digits}) as {c}" if c in FLOATS else f"{cell} as {c}")
    return f"select city, date, {', '.join(out)} from {source}"


@query("feat_calendar", f"with {PANEL} select date, city, {CALENDAR_SQL} from panel")
def feat_calendar(spark, sf_dir):
    out = features.calendar_features(orders_panel(spark, sf_dir))
    return rounded(out.select("date", "city", *CALENDAR_FEATURES), 6, "sin_doy", "cos_doy")


@query("feat_lags", f"with {PANEL} select date, city, orders, {LAGS_SQL} from panel")
def feat_lags(spark, sf_dir):
    return features.lag_features(orders_panel(spark, sf_dir)).select("date", "city", "orders", *LAG_FEATURES)


@query("feat_rolling", f"with {PANEL} select date, city, orders, {_rolling_sql(6)} from panel")
def feat_rolling(spark, sf_dir):
    out = features.rolling_features(orders_panel(spark, sf_dir))
    return rounded(
        out.select("date", "city", "orders", *ROLLING_FEATURES),
        6,
        *[c for c in ROLLING_FEATURES if "mean" in c or "std" in c],
    )


@query(
    "feat_windows_segmented", f"with {PANEL} select date, city, orders, {LAGS_SQL}, {_rolling_sql(6)} from panel"
)
def feat_windows_segmented(spark, sf_dir):
    """Lags and rolling statistics with every series cut into segments of 365 rows."""
    out = features.build_features(orders_panel(spark, sf_dir), fill="none", segment_rows=365)
    return rounded(
        out.select("date", "city", "orders", *LAG_FEATURES, *ROLLING_FEATURES),
        6,
        *[c for c in ROLLING_FEATURES if "mean" in c or "std" in c],
    )


@query(
    "feat_weather",
    f"""with {PANEL} select date, city, round(temperature_c * temperature_c, 6) as temp_sq,
  round(temperature_c - 15.0, 6) as temp_deviation, round(ln(1 + greatest(rainfall_mm, 0.0)), 6) as log_rainfall,
  round(rainfall_mm * is_rainy, 6) as rain_intensity from panel""",
)
def feat_weather(spark, sf_dir):
    out = features.weather_features(orders_panel(spark, sf_dir))
    return rounded(out.select("date", "city", *WEATHER_COLUMN_FEATURES), 6, *WEATHER_COLUMN_FEATURES)


@query("feat_interactions", f"with {PANEL} select date, city, {INTERACTION_SQL} from panel")
def feat_interactions(spark, sf_dir):
    out = features.interaction_features(orders_panel(spark, sf_dir))
    return out.select("date", "city", *INTERACTION_FEATURES)


@query(
    "feat_ratios",
    f"""with {PANEL}, {features_sql()} select date, city, round(lag_7_ratio, 6) as lag_7_ratio,
  round(rolling_ratio_7_28, 6) as rolling_ratio_7_28 from feats""",
)
def feat_ratios(spark, sf_dir):
    out = features.build_features(orders_panel(spark, sf_dir), fill="none")
    return rounded(out.select("date", "city", *RATIO_FEATURES), 6, *RATIO_FEATURES)


@query(
    "feat_missing_inputs",
    f"""with {PANEL}, {features_sql()} select date, city, orders, 0.0::double as temp_sq, 0.0::double as temp_deviation,
  0.0::double as log_rainfall, 0.0::double as rain_intensity, 0 as promo_x_weekend, 0 as promo_x_rainy,
  0 as festival_x_rainy, 0 as holiday_x_weekend, 0 as promo_x_holiday, round(lag_7_ratio, 6) as lag_7_ratio
from feats""",
)
def feat_missing_inputs(spark, sf_dir):
    """Features of a panel without weather and flag columns."""
    bare = orders_panel(spark, sf_dir).select("date", "city", "orders")
    out = features.build_features(bare, fill="none")
    names = ("date", "city", "orders", *WEATHER_COLUMN_FEATURES, *INTERACTION_FEATURES, "lag_7_ratio")
    return rounded(out.select(*names), 6, "lag_7_ratio")


FILLED = (*RAW_COLUMNS, *FEATURE_COLUMNS)
BUILD_SQL = f"with {PANEL}, {features_sql()} {fill_sql(FILLED, 'feats')}"


@query("build_features", BUILD_SQL)
def build_features(spark, sf_dir):
    return rounded(features.build_features(orders_panel(spark, sf_dir)), 6, *FLOATS)


NATION_SQL = f"with {panel_sql('nation')}, {features_sql()} {fill_sql(FILLED, 'feats')}"


@query("build_features_nation", NATION_SQL)
def build_features_nation(spark, sf_dir):
    """The same features for 25 sparser series, cut into segments of 200 rows."""
    out = features.build_features(orders_panel(spark, sf_dir, "nation"), segment_rows=200)
    return rounded(out, 6, *FLOATS)


@query("features_roundtrip", BUILD_SQL)
def features_roundtrip(spark, sf_dir):
    """Feature table written as Parquet and read back."""
    path = scratch_path(spark, "features") + ".parquet"
    panel_io.write_features(features.build_features(orders_panel(spark, sf_dir)), path)
    return rounded(panel_io.read_features(spark, path), 6, *FLOATS)


@query(
    "fill_chain",
    f"""with {PANEL}, gaps as (select city, date,
    case when city <> 'ASIA' and {'date_diff'}('day', date '1995-01-01', date) % 7 > 2 then orders end as a,
    case when city <> 'MIDDLE EAST' and month(date) > 6 then temperature_c end as b,
    case when city = 'EUROPE' and year(date) = 1996 then rainfall_mm end as c,
    case when city = 'NOWHERE' then rainfall_mm end as d from panel)
select city, date,
  coalesce(first_value(a ignore nulls) over w, last_value(a ignore nulls) over v, 0) as a,
  coalesce(first_value(b ignore nulls) over w, last_value(b ignore nulls) over v, 0) as b,
  coalesce(first_value(c ignore nulls) over w, last_value(c ignore nulls) over v, 0) as c,
  coalesce(first_value(d ignore nulls) over w, last_value(d ignore nulls) over v, 0) as d
from gaps window w as (order by city, date rows between current row and unbounded following),
  v as (order by city, date rows between unbounded preceding and current row)""",
)
def fill_chain_query(spark, sf_dir):
    """Gaps inside series, whole series without a value, and a column without any value."""
    city = F.col("city")
    n = F.expr("datediff(date, date'1995-01-01')")
    gaps = orders_panel(spark, sf_dir).select(
        "city",
        "date",
        F.when((city != "ASIA") & (n % 7 > 2), F.col("orders")).alias("a"),
        F.when((city != "MIDDLE EAST") & (F.month("date") > 6), F.col("temperature_c")).alias("b"),
        F.when((city == "EUROPE") & (F.year("date") == 1996), F.col("rainfall_mm")).alias("c"),
        F.when(city == "NOWHERE", F.col("rainfall_mm")).alias("d"),
    )
    return fill_chain(gaps, ["a", "b", "c", "d"])


@query(
    "target_encode_fit",
    f"with {PANEL} select city, round(avg(orders), 6) as city_target_enc from panel group by 1",
)
def target_encode_fit(spark, sf_dir):
    return rounded(features.fit_target_encoding(orders_panel(spark, sf_dir)), 6, "city_target_enc")


@query(
    "target_encode_apply",
    f"""with {PANEL}, enc as (select city, avg(orders) as e from panel
  where date < date '1999-01-01' and city <> 'AFRICA' group by 1)
select p.date, p.city, p.orders, round(coalesce(e, (select avg(e) from enc), 0), 6) as city_target_enc
from panel p left join enc on enc.city = p.city""",
)
def target_encode_apply(spark, sf_dir):
    """Encoding from the early years of four regions, applied to all rows of all regions."""
    df = orders_panel(spark, sf_dir)
    train = df.where((F.col("date") < "1999-01-01") & (F.col("city") != "AFRICA"))
    out = features.apply_target_encoding(df, features.fit_target_encoding(train))
    return rounded(out.select("date", "city", "orders", "city_target_enc"), 6, "city_target_enc")


FOLDS_SQL = f"""{PANEL}, dates as (select date, row_number() over (order by date) - 1 as r, count(*) over () as n
  from (select distinct date from panel)),
folds as (select date, r, n, case when r < n - 5 * (n // 6) then 0 else 5 - (n - 1 - r) // (n // 6) end as fold
  from dates)"""


@query("fold_split", f"with {FOLDS_SQL} select p.date, city, orders, fold::int as fold from panel p join folds using (date)")
def fold_split(spark, sf_dir):
    return backtest.assign_folds(orders_panel(spark, sf_dir)).select("date", "city", "orders", "fold")


@query(
    "walk_forward_folds",
    f"""with {FOLDS_SQL} select f::int as fold, min(case when fold = f then date end) as val_start,
  max(case when fold = f then date end) as val_end, count(*) filter (fold = f) as val_dates,
  count(*) filter (fold < f) as train_dates, max(case when fold < f then date end) as train_end
from folds, (select unnest([1, 2, 3, 4, 5]) as f) group by f""",
)
def walk_forward_folds(spark, sf_dir):
    return backtest.fold_table(orders_panel(spark, sf_dir))


@query(
    "naive_baseline",
    f"""with {PANEL} select date, city, orders,
  cast(lag(orders, 7) over (partition by city order by date) as double) as pred_orders from panel""",
)
def naive_baseline(spark, sf_dir):
    return backtest.naive_baseline(orders_panel(spark, sf_dir)).select("date", "city", "orders", "pred_orders")


BACKTEST_SQL = f"""{FOLDS_SQL}, {features_sql()},
filled as ({fill_sql(('orders', 'orders_lag_7', 'rolling_mean_28'), 'feats', 12)}),
val as (select fold, orders, rolling_mean_28 as m, orders_lag_7 as b from filled join folds using (date)
  where fold > 0),
per_fold as (select fold::int as fold, avg(abs(orders - m) / greatest(orders, 1) * 100) as mape_model,
    sqrt(avg((orders - m) * (orders - m))) as rmse_model, avg(abs(orders - m)) as mae_model,
    avg(abs(orders - b) / greatest(orders, 1) * 100) as mape_baseline,
    sqrt(avg((orders - b) * (orders - b))) as rmse_baseline, avg(abs(orders - b)) as mae_baseline
  from val group by fold)"""
SCORES = tuple(f"{m}_{s}" for s in ("model", "baseline") for m in ("mape", "rmse", "mae"))


def _fold_predictions(spark, sf_dir):
    """Validation rows with the 28-row mean as the model and lag 7 as the baseline."""
    feats = features.build_features(orders_panel(spark, sf_dir))
    folded = backtest.assign_folds(feats).where("fold > 0")
    return folded.select(
        "fold",
        "date",
        "city",
        "orders",
        F.col("rolling_mean_28").alias("pred_model"),
        F.col("orders_lag_7").alias("pred_baseline"),
    )


@query(
    "backtest_naive",
    f"with {BACKTEST_SQL} select fold, {', '.join(f'round({c}, 6) as {c}' for c in SCORES)} from per_fold",
)
def backtest_naive(spark, sf_dir):
    return rounded(backtest.fold_metrics(_fold_predictions(spark, sf_dir)), 6, *SCORES)


@query(
    "fold_csv",
    f"with {BACKTEST_SQL} select fold, {', '.join(f'round({c}, 6) as {c}' for c in SCORES)} from per_fold",
)
def fold_csv(spark, sf_dir):
    """Fold metrics written as one CSV file and read back."""
    path = scratch_path(spark, "fold-metrics")
    metrics = backtest.fold_metrics(_fold_predictions(spark, sf_dir))
    write_csv(metrics, path, single_file=True)
    return rounded(spark.read.schema(metrics.schema).csv(path, header=True), 6, *SCORES).select("fold", *SCORES)


@query(
    "backtest_summary",
    f"""with {BACKTEST_SQL} select {', '.join(f'round(avg({c}), 6) as {c}' for c in SCORES)},
  avg(mape_model) < avg(mape_baseline) as beats_naive from per_fold""",
)
def backtest_summary(spark, sf_dir):
    return rounded(backtest.fold_summary(backtest.fold_metrics(_fold_predictions(spark, sf_dir))), 6, *SCORES)


DECOMPOSE_SQL = f"""with {PANEL}, t as (select city, date, orders,
    (row_number() over (partition by city order by date) - 1) % 7 as ph,
    case when count(*) over w = 7 then avg(orders) over w end as trend, count(*) over (partition by city) as n
  from panel window w as (partition by city order by date rows between 3 preceding and 3 following)),
m as (select city, ph, avg(orders - trend) as pm from t group by 1, 2),
s as (select city, ph, pm - avg(pm) over (partition by city) as seasonal from m)
select t.city, t.date, cast(orders as double) as observed, round(trend, 6) as trend, round(seasonal, 6) as seasonal,
  round(orders - trend - seasonal, 6) as resid from t join s on s.city = t.city and s.ph = t.ph where n >= 14"""


@query("decompose_weekly", DECOMPOSE_SQL)
def decompose_weekly(spark, sf_dir):
    out = decompose.decompose_weekly(orders_panel(spark, sf_dir))
    return rounded(out, 6, "trend", "seasonal", "resid")


@query("decompose_segmented", DECOMPOSE_SQL)
def decompose_segmented(spark, sf_dir):
    """The same with every series cut into segments of 300 rows."""
    out = decompose.decompose_weekly(orders_panel(spark, sf_dir), segment_rows=300)
    return rounded(out, 6, "trend", "seasonal", "resid")


@query(
    "pred_sanitize",
    f"""with {SCORED}, raw as (select date, city, case when orders % 11 = 0 then null
    when orders % 13 = 0 then 'nan'::double when orders % 17 = 0 then 'inf'::double
    when orders % 19 = 0 then '-inf'::double else pred_orders - 60 end as x from scored)
select date, city, case when x is null or isnan(x) or isinf(x) then 0 else greatest(x, 0) end as pred from raw""",
)
def pred_sanitize(spark, sf_dir):
    df = backtest.naive_baseline(orders_panel(spark, sf_dir)).where("pred_orders is not null")
    n = F.col("orders")
    raw = (
        F.when(n % 11 == 0, F.lit(None))
        .when(n % 13 == 0, F.lit(float("nan")))
        .when(n % 17 == 0, F.lit(float("inf")))
        .when(n % 19 == 0, F.lit(float("-inf")))
        .otherwise(F.col("pred_orders") - 60)
    )
    return df.select("date", "city", finite_or_zero(raw).alias("pred"))


@query("features_from_orders", BUILD_SQL)
def features_from_orders(spark, sf_dir):
    """Neither feature file is there: the features are built from the raw orders."""
    base = scratch_path(spark, "orders")
    orders_panel(spark, sf_dir).write.parquet(f"{base}/orders.parquet")
    out = panel_io.read_features(spark, f"{base}/none.parquet", f"{base}/none.csv", f"{base}/orders.parquet")
    return rounded(out.select("date", *[c for c in orders_panel(spark, sf_dir).columns if c != "date"], *FEATURE_COLUMNS), 6, *FLOATS)


@query("lags_by_part", f"with {panel_sql('part')} select date, city, orders, {LAGS_SQL} from panel")
def lags_by_part(spark, sf_dir):
    """Lags of as many series as there are parts, so the panel grows with the data."""
    return features.lag_features(orders_panel(spark, sf_dir, "part")).select("date", "city", "orders", *LAG_FEATURES)


@query(
    "build_features_supplier",
    f"with {panel_sql('supplier')}, {features_sql()} select city, date, {', '.join(RAW_COLUMNS)}, "
    f"{', '.join(f'round({c}, 6) as {c}' if c in FLOATS else c for c in FEATURE_COLUMNS)} from feats",
)
def build_features_supplier(spark, sf_dir):
    """All features of as many series as there are suppliers, without the fill."""
    return rounded(features.build_features(orders_panel(spark, sf_dir, "supplier"), fill="none"), 6, *FLOATS)
