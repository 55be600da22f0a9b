"""Capacity and inventory recommendations from forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.config import SETTINGS

FORECAST_COLUMNS = {"date", "city", "pred_orders", "pred_p90"}
# Relative spread of the band that starts the medium and the high risk level.
MEDIUM_RISK, HIGH_RISK = 0.15, 0.30


def recommend_capacity(
    forecast: DataFrame,
    safety_stock_pct: float = SETTINGS.safety_stock_pct,
    unit_cost: float = SETTINGS.unit_cost,
) -> DataFrame:
    """Add inventory, reorder point, costs and risk level; unchanged when a column is missing."""
    if not FORECAST_COLUMNS <= set(forecast.columns):
        return forecast
    mean, p90 = F.col("pred_orders"), F.col("pred_p90")
    stock = F.ceil(p90 * F.lit(1.0 + safety_stock_pct / 100.0)).cast("bigint")
    spread = F.when(mean > 0, (p90 - mean) / mean).otherwise(0.0)
    risk = (
        F.when(F.isnan(spread) | spread.isNull(), "Medium")
        .when(spread < MEDIUM_RISK, "Low")
        .when(spread < HIGH_RISK, "Medium")
        .otherwise("High")
    )
    return forecast.withColumns(
        {
            "recommended_inventory": stock,
            "reorder_point": F.ceil((mean + p90) / 2.0).cast("bigint"),
            "expected_cost": mean * F.lit(float(unit_cost)),
            "max_exposed_cost": stock * F.lit(float(unit_cost)),
            "risk_level": risk,
        }
    )
