"""CSV exports of results, capacity plans and backtest metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column order of the exports.
RESULT_COLUMNS = (
    "date",
    "city",
    "orders",
    "pred_orders",
    "pred_p10",
    "pred_p90",
    "residuals",
    "is_anomaly",
    "anomaly_score",
    "anomaly_type",
)
CAPACITY_COLUMNS = (
    "date",
    "city",
    "pred_orders",
    "pred_p90",
    "recommended_inventory",
    "reorder_point",
    "risk_level",
    "max_exposed_cost",
)


def file_slug(city: str | Column) -> Column:
    """Lower case, spaces as underscores."""
    name = F.lit(city) if isinstance(city, str) else city
    return F.regexp_replace(F.lower(name), " ", "_")


def results_export(scored: DataFrame) -> DataFrame:
    """The result columns that are there, in their fixed order."""
    return scored.select(*[c for c in RESULT_COLUMNS if c in scored.columns])


def capacity_export(plan: DataFrame) -> DataFrame:
    """Capacity columns with the date as text and predictions rounded half-even to one decimal."""
    return plan.select(*CAPACITY_COLUMNS).withColumns(
        {
            "date": F.date_format("date", "yyyy-MM-dd"),
            "pred_orders": F.bround("pred_orders", 1),
            "pred_p90": F.bround("pred_p90", 1),
        }
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """``single_file`` is meant for metric tables, never for row-level results."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").csv(path, header=True)
