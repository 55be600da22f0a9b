"""Queries: sources, validation, filters, calendars, weather."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidecast.operators import quality
from tidecast.operators.features import fit_target_encoding, last_rows
from tidecast.plans.catalog import PANEL, labels, orders_panel, panel, query, rounded, table
from tidecast.session import scratch_path
from tidecast.sources import panel as panel_io
from tidecast.sources import promos, requests, weather

AS_OF = dt.date(2000, 12, 31)
DAY_NO = "datediff(date, date'1995-01-01')"
DAY_NO_SQL = "date_diff('day', date '1995-01-01', date)"


@query("scan_panel", f"with {PANEL} select * exclude (is_anomaly) from panel")
def scan_panel(spark, sf_dir):
    return orders_panel(spark, sf_dir)


@query("scan_labels", f"with {PANEL} select date, city, is_anomaly from panel")
def scan_labels(spark, sf_dir):
    """Labels written to CSV and read back with their schema."""
    path = scratch_path(spark, "labels")
    labels(spark, sf_dir).write.csv(path, header=True)
    return panel_io.read_labels(spark, path)


@query("two_sinks", f"with {PANEL} select date, city, orders, is_anomaly from panel")
def two_sinks(spark, sf_dir):
    """Orders and labels written to two files, read back and joined; the orders file has no label."""
    base = scratch_path(spark, "sinks")
    panel_io.write_orders_and_labels(panel(spark, sf_dir), f"{base}/orders", f"{base}/labels")
    orders = panel_io.read_orders(spark, f"{base}/orders")
    if "is_anomaly" in orders.columns:
        raise ValueError("the label is in the orders file")
    return orders.select("date", "city", "orders").join(panel_io.read_labels(spark, f"{base}/labels"), ["date", "city"])


@query("panel_daily_sum", f"with {PANEL} select date, city, orders from base")
def panel_daily_sum(spark, sf_dir):
    """Raw facts to the daily grain."""
    places = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "r_name")
    )
    facts = table(spark, sf_dir, "lineitem").join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    return panel_io.daily_panel(facts, "r_name", "l_shipdate", "l_quantity")


@query(
    "panel_densify",
    f"""with {PANEL}, span as (select min(date) as lo, max(date) as hi from panel),
grid as (select city, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date
  from (select distinct city from panel), span)
select g.city, g.date, coalesce(orders, 0) as orders, temperature_c, rainfall_mm,
  coalesce(is_rainy, 0) as is_rainy, coalesce(is_holiday, 0) as is_holiday,
  coalesce(festival_flag, 0) as festival_flag, coalesce(promo_active, 0) as promo_active
from grid g left join panel p on p.city = g.city and p.date = g.date""",
)
def panel_densify(spark, sf_dir):
    return panel_io.densify(orders_panel(spark, sf_dir))


def raw_orders(spark, sf_dir):
    """The panel as untyped text with errors put in by day number."""
    n = F.expr(DAY_NO)
    return orders_panel(spark, sf_dir).select(
        F.when(n % 211 == 0, "not a date").otherwise(F.col("date").cast("string")).alias("date"),
        F.when(n % 301 == 0, F.lit(None)).otherwise(F.col("city")).alias("city"),
        F.when(n % 97 == 0, "-5").when(n % 89 == 0, "abc").otherwise(F.col("orders").cast("string")).alias("orders"),
        F.when(n % 83 == 0, F.lit(None)).otherwise(F.col("temperature_c").cast("string")).alias("temperature_c"),
        F.when(n % 79 == 0, "-0.5").otherwise(F.col("rainfall_mm").cast("string")).alias("rainfall_mm"),
        F.col("is_rainy").cast("string").alias("is_rainy"),
        F.when(n % 73 == 0, "2").otherwise(F.col("is_holiday").cast("string")).alias("is_holiday"),
        F.col("festival_flag").cast("string").alias("festival_flag"),
        F.when(n % 71 == 0, "yes").otherwise(F.col("promo_active").cast("string")).alias("promo_active"),
    )


RAW_SQL = f"""{PANEL}, raw as (select
  case when n % 211 = 0 then 'not a date' else cast(date as varchar) end as date,
  case when n % 301 = 0 then null else city end as city,
  case when n % 97 = 0 then '-5' when n % 89 = 0 then 'abc' else cast(orders as varchar) end as orders,
  case when n % 83 = 0 then null else cast(temperature_c as varchar) end as temperature_c,
  case when n % 79 = 0 then '-0.5' else cast(rainfall_mm as varchar) end as rainfall_mm,
  cast(is_rainy as varchar) as is_rainy,
  case when n % 73 = 0 then '2' else cast(is_holiday as varchar) end as is_holiday,
  cast(festival_flag as varchar) as festival_flag,
  case when n % 71 = 0 then 'yes' else cast(promo_active as varchar) end as promo_active
  from (select *, {DAY_NO_SQL} as n from panel)),
typed as (select *, try_cast(date as date) as t_date, try_cast(orders as bigint) as t_orders,
  try_cast(rainfall_mm as double) as t_rain, try_cast(is_holiday as int) as t_holiday,
  try_cast(promo_active as int) as t_promo from raw)"""


@query(
    "validate_violations",
    f"""with {RAW_SQL}, hits as (
select 'date' as "column", 'type' as rule, count(*) as failures from typed where date is not null and t_date is null
union all select 'date', 'not_in_future', count(*) from typed where t_date > date '2000-12-31'
union all select 'city', 'not_nullable', count(*) from typed where city is null
union all select 'orders', 'type', count(*) from typed where orders is not null and t_orders is null
union all select 'orders', 'not_negative', count(*) from typed where t_orders < 0
union all select 'temperature_c', 'not_nullable', count(*) from typed where temperature_c is null
union all select 'rainfall_mm', 'not_negative', count(*) from typed where t_rain < 0
union all select 'is_holiday', 'zero_or_one', count(*) from typed where t_holiday not in (0, 1)
union all select 'promo_active', 'type', count(*) from typed where promo_active is not null and t_promo is null)
select * from hits where failures > 0""",
)
def validate_violations(spark, sf_dir):
    return quality.violations(raw_orders(spark, sf_dir), AS_OF)


@query(
    "validate_rows",
    f"""with {RAW_SQL}, hits as (
select city, date, 'date' as "column", 'type' as rule from typed where date is not null and t_date is null
union all select city, date, 'date', 'not_in_future' from typed where t_date > date '2000-12-31'
union all select city, date, 'city', 'not_nullable' from typed where city is null
union all select city, date, 'orders', 'type' from typed where orders is not null and t_orders is null
union all select city, date, 'orders', 'not_negative' from typed where t_orders < 0
union all select city, date, 'temperature_c', 'not_nullable' from typed where temperature_c is null
union all select city, date, 'rainfall_mm', 'not_negative' from typed where t_rain < 0
union all select city, date, 'is_holiday', 'zero_or_one' from typed where t_holiday not in (0, 1)
union all select city, date, 'promo_active', 'type' from typed where promo_active is not null and t_promo is null)
select * from hits""",
)
def validate_rows(spark, sf_dir):
    return quality.row_violations(raw_orders(spark, sf_dir), AS_OF).select("city", "date", "column", "rule")


@query(
    "validate_clean",
    f"""with {RAW_SQL} select t_date as date, city, t_orders as orders,
  cast(temperature_c as double) as temperature_c, t_rain as rainfall_mm, cast(is_rainy as int) as is_rainy,
  t_holiday as is_holiday, cast(festival_flag as int) as festival_flag, t_promo as promo_active
from typed where t_date <= date '2000-12-31' and city is not null and t_orders >= 0
  and temperature_c is not null and t_rain >= 0 and t_holiday in (0, 1) and t_promo in (0, 1)""",
)
def validate_clean(spark, sf_dir):
    return quality.valid_rows(raw_orders(spark, sf_dir), AS_OF)


@query(
    "health_check",
    f"""with {PANEL}, f as (select count(*) as rows, max(date) as max_date,
  cast(date_diff('day', max(date), date '2001-11-10') as int) as days_stale from panel)
select not (rows = 0 or days_stale > 3) as is_healthy, rows, max_date, days_stale,
  case when rows = 0 then 'Dataset is completely empty.' when days_stale > 3 then
    'Data freshness violation: Most recent record is ' || days_stale || ' days old (max allowed: 3).' end as error,
  case when rows > 0 and days_stale between 1 and 3 then
    'Data is ' || days_stale || ' days old, but within acceptable threshold.' end as warning
from f""",
)
def health_check(spark, sf_dir):
    return quality.check_health(orders_panel(spark, sf_dir), dt.date(2001, 11, 10), 3)


@query(
    "health_by_city",
    f"""with {PANEL}, f as (select city, max(date) as max_date from panel group by 1)
select city, max_date, cast(date_diff('day', max_date, date '2001-11-10') as int) as age_days from f""",
)
def health_by_city(spark, sf_dir):
    newest = orders_panel(spark, sf_dir).groupBy("city").agg(F.max("date").alias("max_date"))
    return newest.withColumn("age_days", F.datediff(F.lit(dt.date(2001, 11, 10)), "max_date"))


@query("filter_city", f"with {PANEL} select date, city, orders from panel where city = 'ASIA'")
def filter_city(spark, sf_dir):
    return orders_panel(spark, sf_dir).where(F.col("city") == "ASIA").select("date", "city", "orders")


@query(
    "filter_window",
    f"""with {PANEL} select date, city, orders, promo_active from panel
where date between date '1997-03-01' and date '1998-02-28'""",
)
def filter_window(spark, sf_dir):
    days = F.col("date").between(dt.date(1997, 3, 1), dt.date(1998, 2, 28))
    return orders_panel(spark, sf_dir).where(days).select("date", "city", "orders", "promo_active")


@query(
    "tail_per_city",
    f"""with {PANEL} select date, city, orders from panel
qualify row_number() over (partition by city order by date desc) <= 40""",
)
def tail_per_city(spark, sf_dir):
    return last_rows(orders_panel(spark, sf_dir), 40).select("date", "city", "orders")


# Promo entries: one per customer order, in the customer's region. Some are invalid on purpose.
def promo_requests(spark, sf_dir):
    customers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("city"))
    )
    start = F.col("o_orderdate").cast("date")
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "city",
            start.alias("start_date"),
            F.date_add(start, (F.col("o_orderkey") % 9 - 2).cast("int")).alias("end_date"),
            ((F.col("o_orderkey") % 5) * F.lit(0.5)).alias("intensity"),
            F.col("o_orderpriority").alias("label"),
        )
    )


PROMO_SQL = """asked as (select r_name as city, cast(o_orderdate as date) as start_date,
    cast(o_orderdate as date) + cast(o_orderkey % 9 - 2 as int) as end_date,
    cast((o_orderkey % 5) * 0.5 as double) as intensity, o_orderpriority as label
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey),
cal as (select * from asked where end_date >= start_date and intensity > 0),
days as (select city, cast(unnest(generate_series(start_date, end_date, interval 1 day)) as date) as date,
    intensity from cal),
day_max as (select city, date, max(intensity) as promo_intensity from days group by 1, 2)"""


@query(
    "promo_validate",
    f"""with {PROMO_SQL} select *, case when end_date < start_date then 'end_date before start_date'
  else 'intensity must be positive' end as problem
from asked where end_date < start_date or not intensity > 0""",
)
def promo_validate(spark, sf_dir):
    return promos.promo_problems(promo_requests(spark, sf_dir))


def promo_calendar(spark, sf_dir):
    return promos.valid_promos(promo_requests(spark, sf_dir))


@query("promo_list", f"with {PROMO_SQL} select * from cal where city = 'EUROPE'")
def promo_list(spark, sf_dir):
    return promos.list_promos(promo_calendar(spark, sf_dir), "EUROPE")


@query(
    "promo_remove",
    f"""with {PROMO_SQL}, gone as (select distinct city, start_date from asked where label = '1-URGENT')
select * from cal where not exists
  (select 1 from gone where gone.city = cal.city and gone.start_date = cal.start_date)""",
)
def promo_remove(spark, sf_dir):
    gone = promo_requests(spark, sf_dir).where("label = '1-URGENT'")
    return promos.remove_promos(promo_calendar(spark, sf_dir), gone)


@query(
    "promo_interval",
    f"""with {PANEL}, {PROMO_SQL} select p.date, p.city,
  case when max(c.intensity) is null then 0 else 1 end as promo_active,
  coalesce(max(c.intensity), 0) as promo_intensity
from panel p left join cal c on c.city = p.city and p.date between c.start_date and c.end_date
group by 1, 2""",
)
def promo_interval(spark, sf_dir):
    return promos.promo_grid(promo_calendar(spark, sf_dir), orders_panel(spark, sf_dir))


@query(
    "promo_grid",
    f"""with {PROMO_SQL}, span as (select min(start_date) as lo, max(end_date) as hi from cal),
grid as (select city, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date
  from (select distinct city from cal), span)
select g.date, g.city, case when m.date is null then 0 else 1 end as promo_active,
  coalesce(promo_intensity, 0) as promo_intensity
from grid g left join day_max m on m.city = g.city and m.date = g.date""",
)
def promo_grid(spark, sf_dir):
    return promos.promo_grid(promo_calendar(spark, sf_dir))


@query(
    "promo_overlay",
    f"""with {PANEL}, {PROMO_SQL} select p.date, p.city, p.orders,
  case when m.date is null then 0 else 1 end as promo_active, coalesce(promo_intensity, 0) as promo_intensity
from panel p left join day_max m on m.city = p.city and m.date = p.date""",
)
def promo_overlay(spark, sf_dir):
    out = promos.overlay_promos(orders_panel(spark, sf_dir), promo_calendar(spark, sf_dir))
    return out.select("date", "city", "orders", "promo_active", "promo_intensity")


# Weather payloads: one JSON text per series and month. Every second month's rain array is one short.
def weather_payloads(spark, sf_dir):
    n = F.expr(DAY_NO)
    day = F.struct(
        F.col("date").cast("string").alias("t"),
        F.when(n % 11 != 0, F.col("temperature_c")).alias("c"),
        F.when(n % 7 != 0, F.col("rainfall_mm")).alias("r"),
    )
    month = F.trunc("date", "month").alias("month")
    # At most 31 days per group.
    days = orders_panel(spark, sf_dir).groupBy("city", month).agg(F.array_sort(F.collect_list(day)).alias("d"))
    short = F.size("d") - F.when(F.month("month") % 2 == 0, 1).otherwise(0)
    daily = F.struct(
        F.col("d.t").alias("time"),
        F.col("d.c").alias("temperature_2m_mean"),
        F.slice(F.col("d.r"), F.lit(1), short).alias("precipitation_sum"),
    )
    payload = F.to_json(F.struct(daily.alias("daily")), {"ignoreNullFields": "false"})
    return days.select("city", "month", payload.alias("payload"))


WEATHER_SQL = f"""{PANEL}, feed as (select city, cast(date_trunc('month', date) as date) as month, date,
    case when {DAY_NO_SQL} % 11 <> 0 then temperature_c end as c,
    case when {DAY_NO_SQL} % 7 <> 0 then rainfall_mm end as r,
    row_number() over (partition by city, date_trunc('month', date) order by date) as i,
    count(*) over (partition by city, date_trunc('month', date)) as k from panel),
weather as (select city, month, date, coalesce(c, 15.0) as temperature_c, coalesce(r, 0.0) as rainfall_mm,
    coalesce(r > 2.0, false) as is_rainy
  from feed where i <= k - case when month(month) % 2 = 0 then 1 else 0 end)"""


@query("weather_parse", f"with {WEATHER_SQL} select * from weather")
def weather_parse(spark, sf_dir):
    return weather.parse_payloads(weather_payloads(spark, sf_dir))


@query(
    "weather_extend",
    f"""with {WEATHER_SQL}, agg as (select city, month, max(date) as last, count(*) as n,
    avg(temperature_c) as t, avg(rainfall_mm) as r from weather group by 1, 2),
more as (select city, month, last, n, t, r, unnest(generate_series(1, 31 - n)) as i from agg where n < 31)
select city, month, date, round(temperature_c, 6) as temperature_c, round(rainfall_mm, 6) as rainfall_mm, is_rainy
  from weather
union all select city, month, last + cast(i as int), round(t, 6), round(r, 6), r > 2.0 from more""",
)
def weather_extend(spark, sf_dir):
    parsed = weather.parse_payloads(weather_payloads(spark, sf_dir))
    out = weather.extend_horizon(parsed, 31, ["city", "month"])
    return rounded(out, 6, "temperature_c", "rainfall_mm")


@query(
    "weather_override",
    f"""with {WEATHER_SQL}, ext as (select city, date, month, temperature_c, rainfall_mm, is_rainy from weather
  union all select city, last + cast(unnest(generate_series(1, 40 - n)) as int), month, t, r, r > 2.0 from
    (select city, month, max(date) as last, count(*) as n, avg(temperature_c) as t, avg(rainfall_mm) as r
     from weather group by 1, 2) where n < 40),
first as (select * from ext qualify row_number() over (partition by city, date order by month) = 1)
select p.date, p.city, round(coalesce(f.temperature_c, p.temperature_c), 6) as temperature_c,
  round(coalesce(f.rainfall_mm, p.rainfall_mm), 6) as rainfall_mm,
  coalesce(cast(f.is_rainy as int), p.is_rainy) as is_rainy
from panel p left join first f on f.city = p.city and f.date = p.date""",
)
def weather_override(spark, sf_dir):
    """Extended monthly payloads overlap; the earlier month counts."""
    parsed = weather.parse_payloads(weather_payloads(spark, sf_dir))
    feed = weather.extend_horizon(parsed, 40, ["city", "month"])
    out = weather.override_weather(orders_panel(spark, sf_dir), feed, order="month")
    return rounded(
        out.select("date", "city", "temperature_c", "rainfall_mm", "is_rainy"), 6, "temperature_c", "rainfall_mm"
    )


# Region names as the city names the coordinate table knows; two regions stay unknown.
CITY_OF_REGION = {"AMERICA": "New York", "EUROPE": "Chicago", "ASIA": "Austin"}


@query(
    "geo_lookup",
    """with c as (select c_custkey, case r_name when 'AMERICA' then 'New York' when 'EUROPE' then 'Chicago'
    when 'ASIA' then 'Austin' else r_name end as city
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select c_custkey, city,
  case city when 'New York' then 40.7128::double when 'Chicago' then 41.8781 when 'Austin' then 30.2672
    else 40.7128 end as lat,
  case city when 'New York' then -74.0060::double when 'Chicago' then -87.6298 when 'Austin' then -97.7431
    else -74.0060 end as lon,
  case city when 'New York' then 40.7128::double when 'Chicago' then 41.8781 when 'Austin' then 30.2672
    else 0 end as map_lat,
  case city when 'New York' then -74.0060::double when 'Chicago' then -87.6298 when 'Austin' then -97.7431
    else 0 end as map_lon
from c""",
)
def geo_lookup(spark, sf_dir):
    name = F.col("r_name")
    for region, city in CITY_OF_REGION.items():
        name = F.when(F.col("r_name") == region, city).otherwise(name)
    customers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", name.alias("city"))
    )
    mapped = weather.with_coordinates(customers, default=(0.0, 0.0))
    mapped = mapped.withColumnsRenamed({"lat": "map_lat", "lon": "map_lon"})
    return weather.with_coordinates(mapped).select("c_custkey", "city", "lat", "lon", "map_lat", "map_lon")


@query(
    "request_defaults",
    f"""with {PANEL}, n as (select *, {DAY_NO_SQL} as n from panel)
select date, city, case when n % 2 = 0 then cast(orders as double) end as orders_lag_1,
  cast(null as double) as orders_lag_7, case when n % 3 = 0 then temperature_c else 15.0 end as temperature_c,
  case when n % 5 = 0 then rainfall_mm else 0.0 end as rainfall_mm,
  case when n % 7 = 0 then is_rainy = 1 else false end as is_rainy,
  case when n % 4 = 0 then promo_active else 0 end as promo_active, 0 as is_holiday,
  case when n % 6 = 0 then festival_flag else 0 end as festival_flag
from n""",
)
def request_defaults(spark, sf_dir):
    """Requests as JSON text in which some fields are absent."""
    n = F.expr(DAY_NO)
    body = F.struct(
        F.col("date").cast("string").alias("date"),
        "city",
        F.when(n % 2 == 0, F.col("orders").cast("double")).alias("orders_lag_1"),
        F.when(n % 3 == 0, F.col("temperature_c")).alias("temperature_c"),
        F.when(n % 5 == 0, F.col("rainfall_mm")).alias("rainfall_mm"),
        F.when(n % 7 == 0, F.col("is_rainy") == 1).alias("is_rainy"),
        F.when(n % 4 == 0, F.col("promo_active")).alias("promo_active"),
        F.when(n % 6 == 0, F.col("festival_flag")).alias("festival_flag"),
    )
    return requests.parse_requests(orders_panel(spark, sf_dir).select(F.to_json(body).alias("request")))


@query(
    "union_history_future",
    f"""with {PANEL}, last as (select city, max(date) as last, round(avg(temperature_c), 6) as temperature_c,
    round(avg(rainfall_mm), 6) as rainfall_mm from panel group by 1)
select city, date, orders, temperature_c, rainfall_mm, false as is_future from panel
union all select city, last + cast(unnest(generate_series(1, 14)) as int), null, temperature_c, rainfall_mm, true
from last""",
)
def union_history_future(spark, sf_dir):
    history = orders_panel(spark, sf_dir).select("city", "date", "orders", "temperature_c", "rainfall_mm")
    ends = history.groupBy("city").agg(
        F.max("date").alias("last"),
        F.round(F.avg("temperature_c"), 6).alias("temperature_c"),
        F.round(F.avg("rainfall_mm"), 6).alias("rainfall_mm"),
    )
    future = ends.withColumn(
        "date", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", 14)))
    ).drop("last")
    return panel_io.union_history_future(history, future)


@query("read_orders", f"with {PANEL} select * exclude (is_anomaly) from panel")
def read_orders(spark, sf_dir):
    """Orders and labels written as two CSV files; the orders read back, validated and typed."""
    base = scratch_path(spark, "csv")
    panel_io.write_orders_and_labels(panel(spark, sf_dir), f"{base}/orders", f"{base}/labels")
    out = panel_io.read_orders(spark, f"{base}/orders", as_of=dt.date(2100, 1, 1))
    return out.select(*orders_panel(spark, sf_dir).columns)


@query("promo_file", f"with {PROMO_SQL} select * from cal")
def promo_file(spark, sf_dir):
    """The promotion calendar written as JSON lines and read back."""
    path = scratch_path(spark, "promos")
    promos.save_calendar(promo_calendar(spark, sf_dir), path)
    return promos.load_calendar(spark, path)


@query(
    "request_features",
    f"""with {PANEL}, ends as (select city, max(date) as last, avg(orders) as enc from panel group by 1),
asked as (select city, cast(last + cast(d as integer) as date) as date, enc, k
  from ends, (values (1), (1), (3), (7)) as days(d), (values (0)) as ks(k)),
tail as (select city, orders::double as y, row_number() over (partition by city order by date desc) as n from panel),
agg as (select city, max(case when n = 1 then y end) as l1, max(case when n = 7 then y end) as l7,
    max(case when n = 28 then y end) as l28, avg(case when n <= 7 then y end) as m7,
    stddev_samp(case when n <= 28 then y end) as s28, max(case when n <= 14 then y end) as x14 from tail group by 1)
select a.date, a.city, l1 as orders_lag_1, l7 as orders_lag_7, l28 as orders_lag_28, round(m7, 6) as rolling_mean_7,
  round(s28, 6) as rolling_std_28, x14 as rolling_max_14, round(enc, 6) as city_target_enc,
  round(l1 / (l7 + 1.0), 6) as lag_7_ratio
from asked a join agg using (city)""",
)
def request_features(spark, sf_dir):
    """Requests for several days behind the history, one of them twice: a row for each."""
    history = orders_panel(spark, sf_dir)
    ends = history.groupBy("city").agg(F.max("date").alias("last"))
    days = ends.select("city", F.explode(F.array(*[F.date_add("last", d) for d in (1, 1, 3, 7)])).alias("date"))
    asked = requests.parse_requests(days.select(F.to_json(F.struct(F.col("date").cast("string").alias("date"), "city")).alias("request")))
    out = requests.request_features(asked, history, fit_target_encoding(history))
    names = ("rolling_mean_7", "rolling_std_28", "city_target_enc", "lag_7_ratio")
    lags = ("orders_lag_1", "orders_lag_7", "orders_lag_28", "rolling_max_14")
    return rounded(out.select("date", "city", *lags, *names), 6, *names)
