"""Column lists and defaults shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# The panel contract and the names of the engineered features.
REQUIRED_COLUMNS = (
    "date",
    "city",
    "orders",
    "temperature_c",
    "rainfall_mm",
    "is_rainy",
    "is_holiday",
    "festival_flag",
    "promo_active",
)
FLAG_COLUMNS = ("is_rainy", "is_holiday", "festival_flag", "promo_active")
LAGS = (1, 2, 3, 4, 5, 6, 7, 14, 21, 28)
ROLLING_WINDOWS = (7, 14, 28)
CALENDAR_FEATURES = (
    "dow",
    "month",
    "day",
    "day_of_year",
    "week_of_year",
    "quarter",
    "is_weekend",
    "is_friday",
    "is_month_start",
    "is_month_end",
    "sin_doy",
    "cos_doy",
)
LAG_FEATURES = tuple(f"orders_lag_{n}" for n in LAGS)
ROLLING_FEATURES = tuple(
    f"rolling_{stat}_{w}" for w in ROLLING_WINDOWS for stat in ("mean", "std", "min", "max")
)
ENCODING_FEATURE = "city_target_enc"
WEATHER_COLUMN_FEATURES = ("temp_sq", "temp_deviation", "log_rainfall", "rain_intensity")
INTERACTION_FEATURES = (
    "promo_x_weekend",
    "promo_x_rainy",
    "festival_x_rainy",
    "holiday_x_weekend",
    "promo_x_holiday",
)
RATIO_FEATURES = ("lag_7_ratio", "rolling_ratio_7_28")
FEATURE_COLUMNS = (
    *CALENDAR_FEATURES,
    *LAG_FEATURES,
    *ROLLING_FEATURES,
    ENCODING_FEATURE,
    *WEATHER_COLUMN_FEATURES,
    *INTERACTION_FEATURES,
    *RATIO_FEATURES,
)
#: What tells series apart in the pooled trees; fitted on training days, not part of the feature table.
SERIES_FEATURES = ("series_weekday", "series_spread")
#: The columns that the trees split on.
TREE_FEATURES = (*FEATURE_COLUMNS, *SERIES_FEATURES)
#: Features whose attributions add up to "the weather part" of a prediction.
WEATHER_ATTRIBUTION_FEATURES = (*WEATHER_COLUMN_FEATURES, "promo_x_rainy", "festival_x_rainy")
#: Exogenous flags the additive model may use.
ADDITIVE_REGRESSORS = ("is_holiday", "promo_active", "is_rainy")


@dataclass(frozen=True)
class Settings:
    """Defaults of the jobs. Paths are always passed explicitly."""

    random_seed: int = 42
    tree_weight: float = 0.6
    additive_weight: float = 0.4
    folds: int = 5
    quantile_alphas: tuple[float, ...] = (0.1, 0.5, 0.9)
    contamination: float = 0.015
    z_threshold: float = 2.5
    boosting_rounds: int = 100
    boosting_step: float = 0.05
    tree_depth: int = 5
    band_rounds: int = 5
    band_step: float = 0.5
    band_depth: int = 3
    max_stale_days: int = 3
    psi_threshold: float = 0.2
    drift_threshold: float = 8.0
    drift_streak: int = 3
    safety_stock_pct: float = 10.0
    unit_cost: float = 1.0


SETTINGS = Settings()
