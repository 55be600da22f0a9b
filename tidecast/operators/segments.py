"""Cutting long series into bounded segments, so that no window holds a whole series.

A daily panel has at most one row per series and day, which bounds a series by the calendar.
Where that is still too much for one task, row-based windows can run per (series, segment):
each segment also receives the last ``lookback`` rows of the one before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POSITION = "_position"
SEGMENT = "_segment"
HALO = "_halo"


def with_positions(df: DataFrame, key: str = "city", ts: str = "date") -> DataFrame:
    """Add the 0-based row number within the series, computed year by year.

    Yearly counts (combined before the shuffle) give every year its offset; inside a year a
    window numbers the rows. No task sees more than one year of one series.
    """
    rows = df.withColumn("_year", F.year(ts))
    counts = rows.groupBy(key, "_year").agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(key).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        key, "_year", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    in_year = Window.partitionBy(key, "_year").orderBy(ts)
    return (
        rows.join(offsets, [key, "_year"])
        .withColumn(POSITION, F.col("_offset") + F.row_number().over(in_year) - 1)
        .drop("_year", "_offset")
    )


def segmented(
    df: DataFrame,
    rows: int,
    lookback: int,
    lookahead: int = 0,
    key: str = "city",
    ts: str = "date",
    keep_position: bool = False,
) -> DataFrame:
    """Assign rows to segments of ``rows`` rows, with copies of their neighbours' rims.

    A segment also gets the last ``lookback`` rows of the one before and the first ``lookahead`` rows
    of the one after. Copies are marked in the ``_halo`` column and have to be filtered out after the
    window.
    """
    if rows < max(lookback, lookahead):
        raise ValueError("a segment must be at least as long as lookback and lookahead")
    placed = with_positions(df, key, ts)
    own, at = F.floor(F.col(POSITION) / rows), F.col(POSITION) % rows
    targets = F.array_compact(
        F.array(
            own,
            F.when(at >= rows - lookback, own + 1),
            F.when((at < lookahead) & (own > 0), own - 1),
        )
    )
    out = placed.withColumn(SEGMENT, F.explode(targets)).withColumn(HALO, F.col(SEGMENT) != own)
    return out if keep_position else out.drop(POSITION)
