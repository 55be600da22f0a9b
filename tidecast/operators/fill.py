"""Backward fill, then forward fill, then 0 (dates: nothing), over the whole frame in (series, date) order.

The order crosses series boundaries: a value missing at the end of one series is taken from the
start of the next. A window over the unpartitioned frame would put every row into one task, so the
fill runs inside blocks (a series, or a segment of one). One aggregate first tells which columns
have gaps at all, and which stay open at the end of some block; only those look across blocks,
first inside buckets of blocks and then across the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType

from tidecast.session import ensure_checkpoint_dir

#: Number of buckets the block summaries are ordered in; bounds the one unpartitioned window.
BUCKETS = 256
#: (columns with gaps, columns still open at the end of some block)
Gaps = tuple[list[str], list[str]]


def fill_chain(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "city",
    ts: str = "date",
    segment: str | None = None,
    known: Gaps | None = None,
) -> DataFrame:
    """Fill ``columns``; the result has no NULL in them, except in a date column without any value.

    Unless the gaps are ``known``, the call runs one aggregate over the frame; a column that has to
    be filled across blocks takes a second one. The frame should then be cheap to read again.

    Args:
        segment: optional column that cuts a series into consecutive blocks, rising with ``ts``.
    """
    columns = list(columns)
    block = [key] + ([segment] if segment else [])
    gappy, crossing = known or find_gaps(df, columns, block, ts)
    ahead = (
        Window.partitionBy(*block)
        .orderBy(F.desc(ts))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    owned = df.withColumns({f"_own_{c}": F.last(c, ignorenulls=True).over(ahead) for c in gappy})
    filled = {c: F.col(f"_own_{c}") for c in gappy}
    if crossing:
        ensure_checkpoint_dir(df.sparkSession)
        heads = owned.groupBy(*block).agg(
            F.min_by(F.struct(*[F.col(f"_own_{c}").alias(c) for c in crossing]), ts).alias("head")
        )
        following = _following_heads(heads.checkpoint(), crossing, block)
        owned = owned.join(following, block, "left")
        final = _final_values(df, crossing, key, ts)
        for c in crossing:
            kind = df.schema[c].dataType
            filled[c] = F.coalesce(
                F.col(f"_own_{c}"), F.col(f"_next_{c}"), F.lit(final[c]).cast(kind), _zero(kind)
            )
    return owned.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def _zero(kind: DataType) -> Column:
    """What is left where a whole column is missing."""
    return F.lit(None if isinstance(kind, DateType) else 0).cast(kind)


def find_gaps(df: DataFrame, columns: list[str], block: list[str], ts: str) -> Gaps:
    """Columns with any NULL, and those that are NULL at the last row of some block."""
    gaps = (
        df.groupBy(*block)
        .agg(
            F.max_by(F.struct(*columns), ts).alias("end"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        )
        .agg(
            *[F.sum(f"null_{c}").alias(f"null_{c}") for c in columns],
            *[F.count_if(F.col(f"end.{c}").isNull()).alias(f"open_{c}") for c in columns],
        )
        .first()
    )
    return [c for c in columns if gaps[f"null_{c}"]], [c for c in columns if gaps[f"open_{c}"]]


def _final_values(df: DataFrame, columns: list[str], key: str, ts: str):
    """Last value of the whole frame per column: what a forward fill meets at the very end."""
    order = F.struct(key, ts)
    return df.agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    ).first()


def _following_heads(summary: DataFrame, columns: list[str], block: list[str]) -> DataFrame:
    """Per block the first value that any later block has."""
    # Up to BUCKETS blocks, picked by hash, cut the ordered blocks into similar buckets.
    # Any cuts give the same fill; they only balance the work.
    order = F.struct(*block)
    cuts = (
        summary.groupBy(F.pmod(F.xxhash64(*block), F.lit(BUCKETS)).alias("_h"))
        .agg(F.min_by(order, F.xxhash64(*block, F.lit(7))).alias("_cut"))
        .agg(F.array_sort(F.collect_list("_cut")).alias("cuts"))
        .scalar()
    )
    bucketed = summary.withColumn("_cuts", cuts).withColumn(
        "_bucket", F.size(F.filter("_cuts", lambda c: c <= order))
    )
    later_in_bucket = (
        Window.partitionBy("_bucket")
        .orderBy(*[F.desc(c) for c in block])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = bucketed.select(
        "_bucket",
        *block,
        *[
            F.last(f"head.{c}", ignorenulls=True).over(later_in_bucket).alias(f"_in_{c}")
            for c in columns
        ],
    )
    per_bucket = bucketed.groupBy("_bucket").agg(
        *[
            F.min_by(f"head.{c}", F.when(F.col(f"head.{c}").isNotNull(), order)).alias(c)
            for c in columns
        ]
    )
    # At most BUCKETS + 1 rows reach this unpartitioned window, and the broadcast.
    later_buckets = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    across = per_bucket.select(
        "_bucket",
        *[F.last(c, ignorenulls=True).over(later_buckets).alias(f"_out_{c}") for c in columns],
    )
    return inside.join(F.broadcast(across), "_bucket", "left").select(
        *block, *[F.coalesce(f"_in_{c}", f"_out_{c}").alias(f"_next_{c}") for c in columns]
    )
