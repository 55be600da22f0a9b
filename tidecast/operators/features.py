"""The 46 leak-free features: calendar, lags, rolling statistics, encoding, weather, interactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidecast.config import (
    CALENDAR_FEATURES,
    ENCODING_FEATURE,
    FEATURE_COLUMNS,
    LAGS,
    ROLLING_WINDOWS,
)
from tidecast.functions.columns import (
    calendar_columns,
    interaction_columns,
    ratio_columns,
    weather_columns,
)
from tidecast.operators.fill import Gaps, fill_chain
from tidecast.operators.segments import HALO, SEGMENT, segmented


def calendar_features(df: DataFrame, ts: str = "date") -> DataFrame:
    return df.withColumns(calendar_columns(ts))


def weather_features(df: DataFrame) -> DataFrame:
    return df.withColumns(weather_columns(df.columns))


def interaction_features(df: DataFrame, ts: str = "date") -> DataFrame:
    return df.withColumns(interaction_columns(df.columns, ts))


def _newest_first(key: str, ts: str, segment: str | None = None) -> WindowSpec:
    """The one window of lags, rolling statistics and backward fill.

    It runs newest first: a lag is then a lead, and the fill chain finds its sort order in place.
    """
    return Window.partitionBy(*([key, segment] if segment else [key])).orderBy(F.desc(ts))


def _lag_columns(window: WindowSpec, target: str, lags: Sequence[int]) -> dict[str, Column]:
    return {f"orders_lag_{n}": F.lead(F.col(target).cast("double"), n).over(window) for n in lags}


def _rolling_columns(window: WindowSpec, target: str, sizes: Sequence[int]) -> dict[str, Column]:
    value = F.col(target).cast("double")
    out: dict[str, Column] = {}
    for size in sizes:
        before = window.rowsBetween(1, size)
        out[f"rolling_mean_{size}"] = F.avg(value).over(before)
        out[f"rolling_std_{size}"] = F.coalesce(F.stddev_samp(value).over(before), F.lit(0.0))
        out[f"rolling_min_{size}"] = F.min(value).over(before)
        out[f"rolling_max_{size}"] = F.max(value).over(before)
    return out


def lag_features(
    df: DataFrame,
    lags: Sequence[int] = LAGS,
    key: str = "city",
    ts: str = "date",
    target: str = "orders",
    segment_rows: int | None = None,
) -> DataFrame:
    """Target of the n-th row before, per series. Lags count rows, not days."""
    return _windowed(df, lags, (), key, ts, target, segment_rows)


def rolling_features(
    df: DataFrame,
    sizes: Sequence[int] = ROLLING_WINDOWS,
    key: str = "city",
    ts: str = "date",
    target: str = "orders",
    segment_rows: int | None = None,
) -> DataFrame:
    """Mean, sample std, min and max of the rows before the current one, per series."""
    return _windowed(df, (), sizes, key, ts, target, segment_rows)


def _windowed(df, lags, sizes, key, ts, target, segment_rows, keep_segment=False) -> DataFrame:
    if segment_rows is None:
        window = _newest_first(key, ts)
        return df.withColumns(
            _lag_columns(window, target, lags) | _rolling_columns(window, target, sizes)
        )
    lookback = max([*lags, *sizes])
    window = _newest_first(key, ts, SEGMENT)
    out = (
        segmented(df, segment_rows, lookback, key=key, ts=ts)
        .withColumns(_lag_columns(window, target, lags) | _rolling_columns(window, target, sizes))
        .where(~F.col(HALO))
        .drop(HALO)
    )
    return out if keep_segment else out.drop(SEGMENT)


def fit_target_encoding(df: DataFrame, key: str = "city", target: str = "orders") -> DataFrame:
    """Mean target per series; empty when a column is absent."""
    schema = f"`{key}` string, {ENCODING_FEATURE} double"
    if not {key, target} <= set(df.columns):
        return df.sparkSession.createDataFrame([], schema)
    return df.groupBy(key).agg(F.avg(F.col(target).cast("double")).alias(ENCODING_FEATURE))


def apply_target_encoding(df: DataFrame, encoding: DataFrame, key: str = "city") -> DataFrame:
    """Look the encoding up; an unseen series gets the plain mean of all encodings, else 0.

    The encoding has one row per series and grows with the data, so no broadcast is forced:
    the session's size threshold and adaptive execution decide.
    """
    default = encoding.agg(F.avg(ENCODING_FEATURE).alias("d")).scalar()
    return df.join(encoding.select(key, ENCODING_FEATURE), key, "left").withColumn(
        ENCODING_FEATURE, F.coalesce(F.col(ENCODING_FEATURE), default, F.lit(0.0))
    )


def build_features(
    df: DataFrame,
    encoding: DataFrame | None = None,
    fill: str = "global",
    key: str = "city",
    ts: str = "date",
    target: str = "orders",
    segment_rows: int | None = None,
) -> DataFrame:
    """All 46 features next to the input columns.

    Args:
        encoding: training-time result of ``fit_target_encoding``; by default the frame's own means.
        fill: ``"global"`` applies the whole-frame fill chain to every column that may be missing;
            ``"none"`` leaves NULL, so that nothing flows back from later rows.
        segment_rows: run the windows per segment of that many rows instead of per series.
    """
    if fill not in ("global", "none"):
        raise ValueError("fill must be 'global' or 'none'")
    out = df.withColumn(ts, F.col(ts).cast("date"))
    out = _windowed(out, LAGS, ROLLING_WINDOWS, key, ts, target, segment_rows, keep_segment=True)
    if encoding is not None:
        out = apply_target_encoding(out, encoding, key)
    elif segment_rows is None:
        # The series is already together for the lags: no further shuffle, no join.
        mean = F.avg(F.col(target).cast("double")).over(Window.partitionBy(key))
        out = out.withColumn(ENCODING_FEATURE, mean)
    else:
        out = apply_target_encoding(out, fit_target_encoding(df, key, target), key)
    out = out.withColumns(
        calendar_columns(ts)
        | weather_columns(df.columns)
        | interaction_columns(df.columns, ts)
        | ratio_columns()
    )
    if fill == "global":
        never_null = {key, ts, SEGMENT, *CALENDAR_FEATURES}
        never_null |= {f"rolling_std_{w}" for w in ROLLING_WINDOWS}
        fillable = [
            f.name
            for f in out.schema.fields
            if f.name not in never_null
            and f.dataType.typeName()
            in ("double", "float", "decimal", "integer", "long", "short", "byte", "boolean", "string", "date")
        ]
        segment = SEGMENT if segment_rows else None
        known = _known_gaps(df, [c for c in fillable if c in df.columns], key, segment_rows)
        out = fill_chain(out, fillable, key, ts, segment, known)
    return out.select(*df.columns, *FEATURE_COLUMNS)


def _known_gaps(
    df: DataFrame, inputs: list[str], key: str, segment_rows: int | None
) -> Gaps | None:
    """Gaps of the features when no input has any: they follow from the length of the series.

    One aggregate over the inputs, without windows. With gaps in an input the answer is None.
    """
    facts = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in inputs])
        .agg(F.min("_n").alias("_n"), *[F.sum(F.col("_n") - F.col(c)).alias(c) for c in inputs])
        .first()
    )
    if any(facts[c] for c in inputs):
        return None
    # The first row that has a value: the lag itself, and 1 for what needs any earlier row.
    first_row = {f"orders_lag_{n}": n for n in LAGS}
    first_row |= {f"rolling_{s}_{w}": 1 for w in ROLLING_WINDOWS for s in ("mean", "min", "max")}
    first_row |= {"lag_7_ratio": 7, "rolling_ratio_7_28": 1}
    shortest = min(facts["_n"] or 0, segment_rows or facts["_n"] or 0)
    return list(first_row), [c for c, row in first_row.items() if shortest <= row]


def require_features(df: DataFrame, **options) -> DataFrame:
    """The frame itself when all features are present, otherwise the frame with features built."""
    if set(FEATURE_COLUMNS) <= set(df.columns):
        return df
    return build_features(df.drop(*[c for c in FEATURE_COLUMNS if c in df.columns]), **options)


def last_rows(df: DataFrame, n: int, key: str = "city", ts: str = "date") -> DataFrame:
    """The newest n rows of every series."""
    rank = Window.partitionBy(key).orderBy(F.desc(ts))
    return df.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= n).drop("_rank")
