"""Weather forecasts: payload parsing, horizon extension, override of horizon rows, coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAYLOAD_SCHEMA = (
    "daily struct<time: array<string>, temperature_2m_mean: array<double>, "
    "precipitation_sum: array<double>>"
)
# Defaults for missing readings and the rain level above which a day is rainy.
DEFAULT_TEMPERATURE, DEFAULT_RAIN, RAINY_ABOVE = 15.0, 0.0, 2.0
# Coordinates by city.
COORDINATES = {
    "New York": (40.7128, -74.0060),
    "Chicago": (41.8781, -87.6298),
    "Los Angeles": (34.0522, -118.2437),
    "Austin": (30.2672, -97.7431),
    "Miami": (25.7617, -80.1918),
}


def parse_payloads(df: DataFrame, payload: str = "payload", key: str = "city") -> DataFrame:
    """One JSON payload per row -> one row per day. The shortest of the three arrays wins."""
    parsed = df.withColumn("_d", F.from_json(payload, PAYLOAD_SCHEMA)["daily"])
    time, temp, rain = (
        F.col("_d.time"),
        F.col("_d.temperature_2m_mean"),
        F.col("_d.precipitation_sum"),
    )
    # An absent array counts as empty; from_json leaves it NULL.
    shortest = F.coalesce(F.least(F.size(time), F.size(temp), F.size(rain)), F.lit(0))
    usable = time.isNotNull() & temp.isNotNull() & rain.isNotNull()
    days = F.when(
        usable,
        F.slice(
            F.arrays_zip(time.alias("t"), temp.alias("c"), rain.alias("r")), F.lit(1), shortest
        ),
    )
    others = [c for c in df.columns if c not in (payload, key)]
    return parsed.select(*others, key, F.explode(days).alias("_z")).select(
        *others,
        F.to_date("_z.t").alias("date"),
        key,
        F.coalesce(F.col("_z.c"), F.lit(DEFAULT_TEMPERATURE)).alias("temperature_c"),
        F.coalesce(F.col("_z.r"), F.lit(DEFAULT_RAIN)).alias("rainfall_mm"),
        F.coalesce(F.col("_z.r") > RAINY_ABOVE, F.lit(False)).alias("is_rainy"),
    )


def extend_horizon(weather: DataFrame, horizon: int, by: list[str] | None = None) -> DataFrame:
    """Append mean-weather days until each group has ``horizon`` rows; longer groups stay whole."""
    by = by or ["city"]
    spans = weather.groupBy(*by).agg(
        F.max("date").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.avg("temperature_c").alias("temperature_c"),
        F.avg("rainfall_mm").alias("rainfall_mm"),
    )
    extra = (
        spans.where(F.col("_n") < horizon)
        .withColumn(
            "date",
            F.explode(
                F.sequence(
                    F.date_add("_last", 1),
                    F.date_add("_last", (F.lit(horizon) - F.col("_n")).cast("int")),
                )
            ),
        )
        .withColumn("is_rainy", F.col("rainfall_mm") > RAINY_ABOVE)
        .drop("_last", "_n")
    )
    return weather.unionByName(extra)


def override_weather(
    rows: DataFrame, weather: DataFrame, key: str = "city", ts: str = "date", order: str | None = None
) -> DataFrame:
    """Replace temperature, rain and rainy flag where the weather table knows the (series, date).

    Of several weather rows for one day the first by ``order`` counts. The pick is an aggregate with
    map-side combine, so copies of one day never travel.
    """
    names = ["temperature_c", "rainfall_mm", "is_rainy"]
    values = [c for c in names if c in weather.columns]
    one = F.struct(*[F.col(c).alias(f"_w_{c}") for c in values])
    rank = F.col(order) if order else F.struct(*values)
    first = weather.groupBy(key, F.col(ts).cast("date").alias(ts)).agg(F.min_by(one, rank).alias("_w"))
    joined = rows.join(first, [key, ts], "left")
    replaced: dict[str, Column] = {}
    for c in values:
        incoming = F.col(f"_w._w_{c}")
        if c in rows.columns:
            incoming = incoming.cast(rows.schema[c].dataType)
            replaced[c] = F.when(F.col("_w").isNotNull(), incoming).otherwise(F.col(c))
        else:
            replaced[c] = incoming
    return joined.withColumns(replaced).drop("_w")


def with_coordinates(
    df: DataFrame, key: str = "city", default: tuple[float, float] | None = None
) -> DataFrame:
    """Add lat and lon. An unknown city gets ``default``, New York when none is given.

    The table has five fixed entries, so it is a map literal rather than a join.
    """
    lat0, lon0 = default if default is not None else COORDINATES["New York"]

    def lookup(i: int) -> Column:
        entries = [F.lit(x) for city, xy in COORDINATES.items() for x in (city, xy[i])]
        return F.try_element_at(F.create_map(*entries), F.col(key))

    return df.withColumn("lat", F.coalesce(lookup(0), F.lit(float(lat0)))).withColumn(
        "lon", F.coalesce(lookup(1), F.lit(float(lon0)))
    )
