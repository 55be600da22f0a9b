"""URL filters as a temporal join: which dated list entries were active when a page was fetched.

Additions and removals of an entry become validity intervals ``[added, removed)``. A capture asks for its
host, the host's parent domains and the host with its first path segment. The as-of join adds up interval
starts and ends by pattern and time in two steps, days first and then moments of a day, so a host with a
third of all captures is spread over its days, and no interval is compared with every capture.

At equal times a removal wins over an addition. A capture at the moment of an addition finds it active,
at the moment of a removal not. A null URL, a URL without host and a null fetch time match nothing. Null
patterns, times and actions are left out. Repeated rows count once as entries, each as captures. An empty
list matches nothing; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.staging import stage


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)", 1))


def patterns(url: Column) -> Column:
    """Host, parent domains of two labels or more, and host with the first path segment."""
    labels = F.split(host(url), r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segment = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    deep = F.when(segment != "", F.array(F.concat_ws("/", host(url), segment))).otherwise(F.array().cast("array<string>"))
    return F.when(host(url) != "", F.array_distinct(F.concat(parents, deep))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, pattern, valid_from, valid_to`` from ``list, pattern, action ('add' or 'remove'), ts``.

    Repeated additions while an entry is active change nothing; an open interval ends at null.
    """
    events = entries.select("list", "pattern", "ts", (F.col("action") == "add").alias("on")).dropna()
    # One state per moment: a removal wins.
    events = events.groupBy("list", "pattern", "ts").agg(F.bool_and("on").alias("on"))
    by = Window.partitionBy("list", "pattern").orderBy("ts")
    turns = events.withColumn("was", F.lag("on").over(by)).where(F.col("on") != F.coalesce("was", F.lit(False)))
    turns = turns.withColumn("valid_to", F.lead("ts").over(by)).where("on")
    return turns.select("list", "pattern", F.col("ts").alias("valid_from"), "valid_to")


def active_entries(captures: DataFrame, entries: DataFrame, capture_id: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``capture_id, fetched, n_active, first_pattern, blocked`` of every capture.

    ``n_active`` counts the active entries of all its patterns, ``first_pattern`` is the least of them.
    """
    rows = captures.select(
        F.monotonically_increasing_id().alias("row"), F.col(capture_id).alias(capture_id), F.col(fetched).alias("fetched"), patterns(F.col(url)).alias("patterns")
    )
    rows = stage(rows, "captures")
    valid = stage(intervals(entries), "intervals")
    starts = valid.select("pattern", F.col("valid_from").alias("at"), F.lit(1).alias("change"))
    ends = valid.where("valid_to is not null").select("pattern", F.col("valid_to").alias("at"), F.lit(-1).alias("change"))
    changes = starts.unionByName(ends).groupBy("pattern", "at").agg(F.sum("change").alias("change"))
    asked = rows.where("fetched is not null").select("row", F.explode("patterns").alias("pattern"), F.col("fetched").alias("at"))
    # Captures of patterns that no list has can't match; this keeps the rest of the join to listed ones.
    asked = asked.join(valid.select("pattern").distinct(), "pattern", "left_semi")
    line = changes.select("pattern", "at", "change", F.lit(None).cast("long").alias("row")).unionByName(asked.select("pattern", "at", F.lit(0).cast("long").alias("change"), "row"))
    line = line.withColumn("day", F.to_date("at"))
    days = line.groupBy("pattern", "day").agg(F.sum("change").alias("n"))
    before = Window.partitionBy("pattern").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("pattern", "day", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("carried"))
    within = Window.partitionBy("pattern", "day").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.withColumn("so_far", F.sum("change").over(within)).where("row is not null").join(days, ["pattern", "day"])
    line = line.withColumn("n", F.col("carried") + F.col("so_far")).where("n > 0")
    found = line.groupBy("row").agg(F.sum("n").alias("n_active"), F.min("pattern").alias("first_pattern"))
    out = rows.select("row", capture_id, "fetched").join(found, "row", "left").withColumn("n_active", F.coalesce("n_active", F.lit(0)).cast("long"))
    return out.select(capture_id, "fetched", "n_active", "first_pattern", (F.col("n_active") > 0).alias("blocked"))
