"""Schema validation and health of an orders panel."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidecast.config import FLAG_COLUMNS, REQUIRED_COLUMNS, SETTINGS


class DataValidationError(Exception):
    """The dataset breaks the panel contract."""


# The type every required column is coerced to.
COLUMN_TYPES = {
    "date": "date",
    "city": "string",
    "orders": "bigint",
    "temperature_c": "double",
    "rainfall_mm": "double",
    "is_rainy": "int",
    "is_holiday": "int",
    "festival_flag": "int",
    "promo_active": "int",
}


def _coerced(df: DataFrame, name: str) -> Column:
    """The column in its contract type, NULL where it cannot be converted; NaN counts as missing."""
    value = F.col(name)
    target = COLUMN_TYPES[name]
    if df.schema[name].dataType.typeName() in ("double", "float"):
        value = F.when(F.isnan(value), None).otherwise(value)
    out = value.try_cast(target)
    if target == "double":
        out = F.when(F.isnan(out), None).otherwise(out)
    return out


def coerce(df: DataFrame) -> DataFrame:
    """Required columns in their contract types; other columns pass through."""
    return df.withColumns({c: _coerced(df, c) for c in REQUIRED_COLUMNS if c in df.columns})


def _rules(df: DataFrame, as_of: Column) -> list[tuple[str, str, Column]]:
    """(column, rule, condition that marks a failing row)."""
    rules: list[tuple[str, str, Column]] = []
    for name in REQUIRED_COLUMNS:
        if name not in df.columns:
            continue
        value = _coerced(df, name)
        raw = F.col(name)
        missing = raw.isNull()
        if df.schema[name].dataType.typeName() in ("double", "float"):
            missing = missing | F.isnan(raw)
        rules.append((name, "not_nullable", missing))
        if name != "city":
            rules.append((name, "type", ~missing & value.isNull()))
        if name == "date":
            rules.append((name, "not_in_future", value > as_of))
        elif name in ("orders", "rainfall_mm"):
            rules.append((name, "not_negative", value < 0))
        elif name in FLAG_COLUMNS:
            rules.append((name, "zero_or_one", ~value.isin(0, 1)))
    return rules


def _as_of(value: dt.date | None) -> Column:
    return F.current_date() if value is None else F.lit(value)


def row_violations(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Every failing rule of every row: the input columns plus ``column`` and ``rule``."""
    failures = F.array_compact(
        F.array(
            *[
                F.when(bad, F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule")))
                for c, r, bad in _rules(df, _as_of(as_of))
            ]
        )
    )
    return df.withColumn("_f", F.explode(failures)).select(*df.columns, "_f.column", "_f.rule")


def violations(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Failures per rule: (column, rule, failures). One aggregate row, no copies of the rows."""
    spark = df.sparkSession
    absent = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    missing = spark.createDataFrame(
        [(c, "column_present", 1) for c in absent], "`column` string, rule string, failures bigint"
    )
    rules = _rules(df, _as_of(as_of))
    if not rules:
        return missing
    counts = df.agg(
        *[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)]
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(f"r{i}").alias("failures")
        )
        for i, (c, r, _) in enumerate(rules)
    ]
    tall = counts.select(F.inline(F.array(*cells))).where(F.col("failures") > 0)
    return tall.unionByName(missing) if absent else tall


def valid_rows(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Coerced rows that pass every rule."""
    ok = F.lit(True)
    for _, _, bad in _rules(df, _as_of(as_of)):
        ok = ok & ~F.coalesce(bad, F.lit(False))
    return coerce(df.where(ok))


def validate_orders(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The coerced frame, or one error that names every failing rule."""
    failed: list[Row] = violations(df, as_of).collect()  # one row per rule, about 30 at most
    if failed:
        text = ", ".join(f"{r['column']}: {r['rule']} ({r['failures']})" for r in failed)
        raise DataValidationError(f"Data validation failed for orders dataset: {text}")
    return coerce(df)


def check_health(
    df: DataFrame,
    as_of: dt.datetime | dt.date | None = None,
    max_stale_days: int = SETTINGS.max_stale_days,
) -> DataFrame:
    """One row (is_healthy, rows, max_date, days_stale, error, warning): volume, schema, freshness."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    missing = sorted({"date", "city", "orders"} - set(df.columns))
    if missing:
        facts = df.agg(
            F.count(F.lit(1)).alias("rows"), F.lit(None).cast("date").alias("max_date")
        )
    else:
        facts = df.agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("date")).alias("max_date"))
    seconds = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(
        F.col("max_date").cast("timestamp")
    )
    facts = facts.withColumn("days_stale", F.floor(seconds / 86400).cast("int"))
    empty = F.col("rows") == 0
    stale = F.col("days_stale") > max_stale_days
    error = F.when(empty, F.lit("Dataset is completely empty."))
    if missing:
        error = error.otherwise(F.lit(f"Missing critical columns: {', '.join(missing)}"))
    else:
        error = error.when(
            stale,
            F.format_string(
                "Data freshness violation: Most recent record is %d days old (max allowed: %d).",
                F.col("days_stale"),
                F.lit(max_stale_days),
            ),
        )
    warning = F.when(
        ~empty & ~stale & (F.col("days_stale") > 0),
        F.format_string(
            "Data is %d days old, but within acceptable threshold.", F.col("days_stale")
        ),
    )
    return facts.select(
        error.isNull().alias("is_healthy"),
        "rows",
        F.col("max_date").cast("date").alias("max_date"),
        "days_stale",
        error.alias("error"),
        warning.alias("warning"),
    )
