"""Classical additive decomposition into trend, weekly season and remainder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.operators.segments import HALO, POSITION, SEGMENT, segmented


def decompose_weekly(
    df: DataFrame,
    key: str = "city",
    ts: str = "date",
    target: str = "orders",
    period: int = 7,
    segment_rows: int | None = None,
) -> DataFrame:
    """(key, ts, observed, trend, seasonal, resid); series under two periods are left out.

    The trend is a centred moving average over an odd period and NULL at both ends. By default all
    steps share one partitioning by series: the phase means are conditional averages over it. With
    ``segment_rows`` no task holds a whole series, and the phase means are an aggregate joined back.
    """
    half = period // 2
    value = F.col(target).cast("double")
    if segment_rows is None:
        ordered = Window.partitionBy(key).orderBy(ts)
        position = F.row_number().over(ordered) - 1
        source = df
    else:
        ordered = Window.partitionBy(key, SEGMENT).orderBy(ts)
        position = F.col(POSITION)
        source = segmented(df, segment_rows, half, half, key, ts, keep_position=True)
    centred = ordered.rowsBetween(-half, half)
    base = source.select(
        key,
        ts,
        *([HALO] if segment_rows else []),
        value.alias("observed"),
        (position % period).cast("int").alias("_phase"),
        F.when(F.count(value).over(centred) == period, F.avg(value).over(centred)).alias("trend"),
    )
    detrended = F.col("observed") - F.col("trend")
    totals = {f"_p{p}": F.avg(F.when(F.col("_phase") == p, detrended)) for p in range(period)}
    totals["_rows"] = F.count(F.lit(1))
    if segment_rows is None:
        whole = Window.partitionBy(key)
        base = base.withColumns({name: total.over(whole) for name, total in totals.items()})
    else:
        base = base.where(~F.col(HALO)).drop(HALO)
        sums = base.groupBy(key).agg(*[total.alias(name) for name, total in totals.items()])
        base = base.join(sums, key)
    level = sum((F.col(f"_p{p}") for p in range(1, period)), F.col("_p0")) / period
    seasonal = F.element_at(F.array(*[F.col(f"_p{p}") for p in range(period)]), F.col("_phase") + 1)
    return (
        base.where(F.col("_rows") >= 2 * period)
        .withColumn("seasonal", seasonal - level)
        .withColumn("resid", F.col("observed") - F.col("trend") - F.col("seasonal"))
        .select(key, ts, "observed", "trend", "seasonal", "resid")
    )
