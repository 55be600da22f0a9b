"""Column expressions: calendar parts, weather terms, interactions, errors, sanitizing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(ts: str = "date") -> dict[str, Column]:
    """Twelve calendar parts of a date; weeks are ISO, Monday is day 0."""
    day = F.col(ts).cast("date")
    dow = F.weekday(day)
    angle = 2 * F.pi() * F.dayofyear(day) / F.lit(365.25)
    return {
        "dow": dow,
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "quarter": F.quarter(day),
        "is_weekend": (dow >= 5).cast("int"),
        "is_friday": (dow == 4).cast("int"),
        "is_month_start": (F.dayofmonth(day) == 1).cast("int"),
        "is_month_end": (F.last_day(day) == day).cast("int"),
        "sin_doy": F.sin(angle),
        "cos_doy": F.cos(angle),
    }


def weather_columns(available: list[str]) -> dict[str, Column]:
    """Four weather terms; an absent input contributes 0."""
    zero = F.lit(0.0)
    temp = F.col("temperature_c").cast("double") if "temperature_c" in available else None
    rain = F.col("rainfall_mm").cast("double") if "rainfall_mm" in available else None
    rainy = F.col("is_rainy").cast("double") if "is_rainy" in available else zero
    return {
        "temp_sq": temp * temp if temp is not None else zero,
        "temp_deviation": temp - 15.0 if temp is not None else zero,
        # greatest() skips NULL, so the NULL of a missing reading is kept on purpose here.
        "log_rainfall": F.when(rain.isNotNull(), F.log1p(F.greatest(rain, zero)))
        if rain is not None
        else zero,
        "rain_intensity": rain * rainy if rain is not None else zero,
    }


def interaction_columns(available: list[str], ts: str = "date") -> dict[str, Column]:
    """Five products of the 0/1 flags; an absent flag counts as 0."""

    def flag(name: str) -> Column:
        return F.col(name).cast("int") if name in available else F.lit(0)

    weekend = (F.weekday(F.col(ts).cast("date")) >= 5).cast("int")
    promo, rainy = flag("promo_active"), flag("is_rainy")
    holiday, festival = flag("is_holiday"), flag("festival_flag")
    return {
        "promo_x_weekend": promo * weekend,
        "promo_x_rainy": promo * rainy,
        "festival_x_rainy": festival * rainy,
        "holiday_x_weekend": holiday * weekend,
        "promo_x_holiday": promo * holiday,
    }


def ratio_columns() -> dict[str, Column]:
    """Ratios of lags and of rolling means, damped by 1 in the denominator."""
    return {
        "lag_7_ratio": F.col("orders_lag_1") / (F.col("orders_lag_7") + 1.0),
        "rolling_ratio_7_28": F.col("rolling_mean_7") / (F.col("rolling_mean_28") + 1.0),
    }


def absolute_percentage_error(actual: str = "orders", pred: str = "pred_orders") -> Column:
    """Absolute error over max(actual, 1), in percent."""
    actual_c = F.col(actual).cast("double")
    return F.abs(actual_c - F.col(pred)) / F.greatest(actual_c, F.lit(1.0)) * 100.0


def finite_or_zero(value: Column) -> Column:
    """NULL, NaN and the infinities become 0; everything else is clamped at 0 from below."""
    inf = F.lit(float("inf"))
    broken = value.isNull() | F.isnan(value) | (F.abs(value) == inf)
    return F.when(broken, F.lit(0.0)).otherwise(F.greatest(value, F.lit(0.0)))
