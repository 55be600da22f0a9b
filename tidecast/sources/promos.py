"""Promotion calendar: storage, edits, expansion to days and overlay on a panel.

A calendar is a DataFrame (city, start_date, end_date, intensity, label); both dates are inclusive
and entries may overlap.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

CALENDAR_SCHEMA = "city string, start_date date, end_date date, intensity double, label string"


def empty_calendar(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CALENDAR_SCHEMA)


def load_calendar(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read a calendar from JSON lines, or from a file with one array; absent -> empty."""
    try:
        return spark.read.schema(CALENDAR_SCHEMA).option("multiLine", multi_line).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return empty_calendar(spark)
        raise


def save_calendar(calendar: DataFrame, path: str) -> None:
    """One JSON object per line, written in parallel."""
    calendar.write.mode("overwrite").json(path)


def _problem() -> Column:
    return (
        F.when(F.col("end_date") < F.col("start_date"), "end_date before start_date")
        .when(~(F.col("intensity") > 0), "intensity must be positive")
        .when(
            F.col("start_date").isNull() | F.col("end_date").isNull() | F.col("city").isNull(),
            "missing city or date",
        )
    )


def promo_problems(entries: DataFrame) -> DataFrame:
    """Entries that may not enter a calendar, with the reason."""
    return entries.withColumn("problem", _problem()).where(F.col("problem").isNotNull())


def valid_promos(entries: DataFrame) -> DataFrame:
    return entries.where(_problem().isNull())


def _day(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def add_promo(
    calendar: DataFrame,
    city: str,
    start: str | dt.date,
    end: str | dt.date,
    intensity: float = 1.0,
    label: str = "",
) -> DataFrame:
    """Append one checked entry."""
    start, end = _day(start), _day(end)
    if end < start:
        raise ValueError("end_date must be on or after start_date")
    if not intensity > 0:
        raise ValueError("intensity must be positive")
    entry = [(city, start, end, float(intensity), label)]
    return calendar.unionByName(calendar.sparkSession.createDataFrame(entry, CALENDAR_SCHEMA))


def remove_promos(calendar: DataFrame, removals: DataFrame) -> DataFrame:
    """Calendar without the entries whose (city, start_date) is listed."""
    return calendar.join(removals.select("city", "start_date").distinct(), ["city", "start_date"], "left_anti")


def remove_promo(calendar: DataFrame, city: str, start: str | dt.date) -> tuple[DataFrame, int]:
    """Calendar without the entries of one city and start day, and how many there were."""
    hit = (F.col("city") == city) & (F.col("start_date") == F.lit(_day(start)))
    return calendar.where(~F.coalesce(hit, F.lit(False))), calendar.where(hit).count()


def list_promos(calendar: DataFrame, city: str | None = None) -> DataFrame:
    """Entries by start date, optionally of one city."""
    chosen = calendar if city is None else calendar.where(F.col("city") == city)
    return chosen.orderBy("start_date", "city", "end_date")


def promo_days(calendar: DataFrame, key: str = "city", ts: str = "date") -> DataFrame:
    """(series, day, intensity): the strongest promotion of every promoted day.

    Entries explode into their days, which turns the interval join into an equi-join: no range
    condition, no pairing of all days with all entries, and overlaps combine before the shuffle.
    """
    days = calendar.select(
        F.col("city").alias(key), F.explode(F.sequence("start_date", "end_date")).alias(ts), "intensity"
    )
    return days.groupBy(key, ts).agg(F.max("intensity").alias("promo_intensity"))


def promo_grid(
    calendar: DataFrame, grid: DataFrame | None = None, key: str = "city", ts: str = "date"
) -> DataFrame:
    """Promotion flag and intensity for every (series, day) of the grid.

    Without a grid it spans all cities of the calendar over its whole date range.
    """
    if grid is None:
        span = calendar.agg(
            F.struct(F.min("start_date").alias("lo"), F.max("end_date").alias("hi")).alias("s")
        ).scalar()
        cities = calendar.select(F.col("city").alias(key)).distinct().withColumn("_s", span)
        grid = cities.select(key, F.explode(F.sequence("_s.lo", "_s.hi")).alias(ts))
    return (
        grid.select(key, ts)
        .join(promo_days(calendar, key, ts), [key, ts], "left")
        .select(
            ts,
            key,
            F.col("promo_intensity").isNotNull().cast("int").alias("promo_active"),
            F.coalesce("promo_intensity", F.lit(0.0)).alias("promo_intensity"),
        )
    )


def overlay_promos(
    df: DataFrame, calendar: DataFrame, key: str = "city", ts: str = "date", mode: str = "replace"
) -> DataFrame:
    """Set promo_active and promo_intensity from the calendar.

    ``replace`` also clears flags on days without an entry; ``or`` keeps them. A calendar without
    entries leaves the flags as they are.
    """
    if mode not in ("replace", "or"):
        raise ValueError("mode must be 'replace' or 'or'")
    has_entries = calendar.agg((F.count(F.lit(1)) > 0).alias("any")).scalar()
    out = df.drop("promo_intensity").join(promo_days(calendar, key, ts), [key, ts], "left")
    hit = F.col("promo_intensity").isNotNull().cast("int")
    if "promo_active" in df.columns:
        base = F.col("promo_active").cast("int")
        new = hit if mode == "replace" else F.greatest(hit, base)
        active = F.when(has_entries, new).otherwise(base)
    else:
        active = hit
    return out.withColumn("promo_active", active).withColumn(
        "promo_intensity", F.coalesce("promo_intensity", F.lit(0.0))
    )
