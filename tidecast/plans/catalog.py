"""Registry of queries and the panel both engines derive from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Queries with SQL whose plan may hold Python: they check facts about fitted models.
WITH_PYTHON: set[str] = set()
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, python: bool = False) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the statement it must agree with."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if python:
            WITH_PYTHON.add(name)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What a series is at each level: SQL of its name. The last two grow with the data.
LEVELS = {"region": "r_name", "nation": "n_name", "supplier": "'s' || l_suppkey", "part": "'p' || l_partkey"}


def panel(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """Daily demand per series, with measures and flags taken from the shipments of the day.

    Demand is the shipped quantity. The temperature scales with the mean tax, the rain with the share of
    returns; the flags follow from the day's sums of discount and tax in percent. A day is labelled as an
    anomaly if its demand is more than 2.2 standard deviations from the mean of its series; all sums are
    of whole numbers, so both engines agree on every digit.
    """
    line = table(spark, sf_dir, "lineitem")
    if level in ("region", "nation"):
        places = (
            table(spark, sf_dir, "supplier")
            .select("s_suppkey", "s_nationkey")
            .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        line = line.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    percent = {"tax": "l_tax", "disc": "l_discount"}
    base = line.groupBy(F.col("l_shipdate").cast("date").alias("date"), F.expr(LEVELS[level]).alias("city")).agg(
        F.sum("l_quantity").cast("bigint").alias("orders"),
        F.count("*").alias("n"),
        *[F.sum(F.round(F.col(c) * 100).cast("bigint")).alias(name) for name, c in percent.items()],
        F.sum((F.col("l_returnflag") == "R").cast("bigint")).alias("ret"),
    )
    tax, disc, ret, n = (F.col(c) for c in ("tax", "disc", "ret", "n"))
    rain = F.when(5 * ret >= 2 * n, (F.floor(ret * 160.0 / n) / 10.0).cast("double")).otherwise(0.0)
    series = Window.partitionBy("city")
    days, total = F.count("*").over(series), F.sum("orders").over(series)
    squares = F.sum(F.col("orders") * F.col("orders")).over(series)
    off = (days * F.col("orders") - total).cast("double")
    anomaly = off * off > 4.84 * (days * squares - total * total).cast("double")
    return base.select(
        "date",
        "city",
        "orders",
        (F.floor(tax * 500.0 / n) / 100.0).cast("double").alias("temperature_c"),
        rain.alias("rainfall_mm"),
        (rain > 2.0).cast("int").alias("is_rainy"),
        (disc % 29 == 0).cast("int").alias("is_holiday"),
        (tax % 9 == 0).cast("int").alias("festival_flag"),
        (disc % 11 < 2).cast("int").alias("promo_active"),
        anomaly.cast("int").alias("is_anomaly"),
    )


def orders_panel(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    return panel(spark, sf_dir, level).drop("is_anomaly")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).select("date", "city", "is_anomaly")


def panel_sql(level: str = "region") -> str:
    """CTEs base and panel: the same panel in SQL."""
    places = """join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
    return f"""base as (
  select cast(l_shipdate as date) as date, {LEVELS[level]} as city, cast(sum(l_quantity) as bigint) as orders,
    count(*) as n, cast(sum(cast(round(l_tax * 100) as bigint)) as bigint) as tax,
    cast(sum(cast(round(l_discount * 100) as bigint)) as bigint) as disc, count(case when l_returnflag = 'R' then 1 end) as ret
  from lineitem {places if level in ("region", "nation") else ""}
  group by 1, 2),
measured as (select *, case when 5 * ret >= 2 * n then floor(ret * 160.0::double / n) / 10 else 0.0::double end as rain,
    cast(count(*) over s as bigint) as days, cast(sum(orders) over s as bigint) as total,
    cast(sum(orders * orders) over s as bigint) as squares
  from base window s as (partition by city)),
panel as (select date, city, orders, floor(tax * 500.0::double / n) / 100 as temperature_c, rain as rainfall_mm,
  case when rain > 2.0 then 1 else 0 end as is_rainy,
  case when disc % 29 = 0 then 1 else 0 end as is_holiday,
  case when tax % 9 = 0 then 1 else 0 end as festival_flag,
  case when disc % 11 < 2 then 1 else 0 end as promo_active,
  case when pow(cast(days * orders - total as double), 2) > 4.84::double * cast(days * squares - total * total as double)
       then 1 else 0 end as is_anomaly
from measured)"""


PANEL = panel_sql()

#: Scored panel in SQL: lag-7 prediction where there is one, residual, pooled z-score and flags.
SCORED = f"""{PANEL},
naive as (select *, cast(lag(orders, 7) over (partition by city order by date) as double) as pred
  from panel),
resid as (select date, city, orders, temperature_c, rainfall_mm, is_rainy, promo_active,
    is_anomaly as label, pred as pred_orders, orders - pred as residuals
  from naive where pred is not null),
bl as (select avg(residuals) as res_mean, greatest(stddev_pop(residuals), 1e-6) as res_std from resid),
scored as (select resid.*, abs((residuals - res_mean) / res_std) as z_score,
    abs((residuals - res_mean) / res_std) >= 2.5 as is_anomaly,
    case when abs((residuals - res_mean) / res_std) >= 2.5
         then case when residuals >= 0 then 'surge' else 'dip' end else 'normal' end as anomaly_type
  from resid, bl)"""


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round float results for comparison across engines."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
