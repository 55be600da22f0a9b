"""Report tables: digest, nested forecast, model card, fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.columns import absolute_percentage_error
from tidecast.operators.features import last_rows

# Texts of the digest.
ALL_CLEAR = (
    "# 🟢 Anomaly Alert Digest: %s\n\n**Status:** All Clear\n"
    "No operational anomalies detected in the selected time window.\n"
)
HEADER = (
    "# 🚨 Anomaly Alert Digest: %s\n\n"
    "**Summary:** Detected **%d** total anomaly events (%d surges, %d dips).\n\n## Detailed Events\n\n"
)
FOOTER = "\n---\n*Generated by automated reporting*"
EVENT = (
    "### %s %s on %s\n- **Severity Score:** `%.2f`\n- **Actual Orders:** `%.1f`\n"
    "- **Expected Orders:** `%.1f`\n- **Deviation:** `%+.1f` orders\n"
)
ICONS = {"surge": "📈", "dip": "📉"}
OTHER_ICON = "⚠️"
UNKNOWN_DATE = "Unknown Date"


def with_fallbacks(df: DataFrame) -> DataFrame:
    """Predictions when a model or its intervals are missing.

    The mean falls back to lag 7, then to the actual value; the band to ten percent around the mean.
    """

    def existing(*names: str) -> list[Column]:
        return [F.col(c).cast("double") for c in names if c in df.columns]

    out = df.withColumn("pred_orders", F.coalesce(*existing("pred_orders", "orders_lag_7", "orders")))
    return out.withColumns(
        {
            "pred_p10": F.coalesce(*existing("pred_p10"), F.col("pred_orders") * 0.9),
            "pred_p90": F.coalesce(*existing("pred_p90"), F.col("pred_orders") * 1.1),
        }
    )


def digest_events(scored: DataFrame, key: str = "city", ts: str = "date") -> DataFrame:
    """The flagged rows, each with its digest paragraph. Scales with the number of flags."""
    kind = F.col("anomaly_type")
    icon = F.lit(OTHER_ICON)
    for name, symbol in ICONS.items():
        icon = F.when(kind == name, symbol).otherwise(icon)

    def number(name: str, digits: int) -> Column:
        return F.bround(F.coalesce(F.col(name).cast("double"), F.lit(0.0)), digits)

    event = F.format_string(
        EVENT,
        icon,
        F.upper(kind),
        F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(UNKNOWN_DATE)),
        number("anomaly_score", 2),
        number("orders", 1),
        number("pred_orders", 1),
        number("residuals", 1),
    )
    return scored.where("is_anomaly").withColumn("event", event)


def anomaly_digest(scored: DataFrame, key: str = "city", ts: str = "date") -> DataFrame:
    """One text per series, events newest first; a series without flags is all clear.

    The text of a series holds one paragraph per flagged day, so it is bounded by the calendar.
    Use ``digest_events`` where the paragraphs are to stay separate rows.
    """
    events = digest_events(scored, key, ts).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("anomaly_type") == "surge").alias("surges"),
        F.count_if(F.col("anomaly_type") == "dip").alias("dips"),
        F.sort_array(F.collect_list(F.struct(F.col(ts).alias("d"), "event")), asc=False).alias("e"),
    )
    body = F.concat(
        F.format_string(HEADER, F.col(key), F.col("n"), F.col("surges"), F.col("dips")),
        F.array_join(F.col("e.event"), "\n"),
        F.lit(FOOTER),
    )
    return (
        scored.select(key)
        .distinct()
        .join(events, key, "left")
        .select(
            key,
            F.when(F.col("n").isNull(), F.format_string(ALL_CLEAR, F.col(key))).otherwise(body).alias("digest"),
        )
    )


def last_horizon(df: DataFrame, days: int, key: str = "city", ts: str = "date") -> DataFrame:
    """The newest ``days`` prediction rows of each series."""
    return last_rows(df, days, key, ts)


def nested_forecast(future: DataFrame, key: str = "city", ts: str = "date") -> DataFrame:
    """One row per series with the ordered list of {date, pred_mean, pred_p10, pred_p90}.

    The horizon asked for bounds the list. Series stay rows: one map over all of them would put the whole result into a single cell.
    """

    def value(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0)) if name in future.columns else F.lit(0.0)

    item = F.struct(
        F.col(ts).alias("date"),
        value("pred_orders").alias("pred_mean"),
        value("pred_p10").alias("pred_p10"),
        value("pred_p90").alias("pred_p90"),
    )
    return future.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("forecasts"))


def model_card(
    scored: DataFrame, age_days: float | None = -1.0, key: str = "city", is_fitted: bool | None = None
) -> DataFrame:
    """Tidy report card (scope, key, metric, value) in one pass over a scored table.

    ``age_days`` is that of the model, -1 if unknown; ``is_fitted``, if given, becomes a row of 0 or 1.
    """
    age_days = -1.0 if age_days is None else age_days
    err = F.col("orders").cast("double") - F.col("pred_orders")
    inside = F.coalesce(F.col("orders").between(F.col("pred_p10"), F.col("pred_p90")), F.lit(False))
    per_key = scored.groupBy(key).agg(
        F.count(err).alias("n"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.abs(err)).alias("abs"),
        F.sum(err * err).alias("sq"),
        F.sum(absolute_percentage_error()).alias("ape"),
        F.count_if(inside).alias("inside"),
        F.count_if(F.col("is_anomaly")).alias("flagged"),
    )
    names = ("n", "rows", "abs", "sq", "ape", "inside", "flagged")
    sums = per_key.groupingSets([[], [F.col(key)]], F.col(key)).agg(
        F.grouping_id().alias("_level"), *[F.sum(c).alias(c) for c in names]
    )
    overall = F.col("_level") == 1

    def cell(scope: Column | str, metric: str, value: Column) -> Column:
        scope = F.lit(scope) if isinstance(scope, str) else scope
        return F.struct(
            scope.alias("scope"),
            F.when(overall, "ALL").otherwise(F.col(key)).alias(key),
            F.lit(metric).alias("metric"),
            value.alias("value"),
        )

    scope = F.when(overall, "global").otherwise("series")
    errors = [
        cell(scope, "mape", F.try_divide("ape", "n")),
        cell(scope, "rmse", F.sqrt(F.try_divide("sq", "n"))),
        cell(scope, "mae", F.try_divide("abs", "n")),
    ]
    extra = [
        cell("calibration", "p10_p90_coverage", F.coalesce(F.try_divide("inside", "rows"), F.lit(0.0))),
        cell("calibration", "target_coverage", F.lit(0.8)),
        cell("anomaly", "flag_rate", F.coalesce(F.try_divide("flagged", "rows"), F.lit(0.0))),
        cell("metadata", "age_days", F.lit(float(age_days))),
        *([] if is_fitted is None else [cell("metadata", "is_fitted", F.lit(float(is_fitted)))]),
    ]
    # An all-series grouping set over no rows still yields the global row.
    return sums.select(
        F.explode(F.when(overall, F.array(*errors, *extra)).otherwise(F.array(*errors))).alias("c")
    ).select("c.*")
