"""Incremental daily panel, scoring of arriving rows, and streak alerts as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidecast.config import SETTINGS
from tidecast.operators.anomaly import anomaly_type, with_zscore


def read_stream(spark: SparkSession, path: str, like: str | None = None, files: int | None = None) -> DataFrame:
    """File stream over Parquet with the schema of files already there."""
    reader = spark.readStream.schema(spark.read.parquet(like or path).schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def daily_events(
    events: DataFrame, key: str = "event_type", ts: str = "ts", value: str = "value", delay: str = "1 day"
) -> DataFrame:
    """Events per series and day, for a stream or a table: (date, key, orders, total).

    On a stream a day is final when the watermark passes its end: rows more than ``delay`` late are
    dropped. Counts combine before the shuffle, so a hot series costs one row per task and day.
    """
    stamped = events.withColumn(ts, F.col(ts).cast("timestamp"))
    daily = (
        stamped.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("w"), key)
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(value).alias("total"))
    )
    return daily.select(F.col("w.start").cast("date").alias("date"), key, "orders", "total")


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there, then stop."""
    query = (
        df.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def score_stream(
    rows: DataFrame,
    baseline: DataFrame,
    by: list[str],
    residual: str = "residuals",
    threshold: float = SETTINGS.z_threshold,
) -> DataFrame:
    """Arriving residuals against a fitted baseline: a stateless join with a static table."""
    flag = F.coalesce(F.col("z_score") >= threshold, F.lit(False))
    return (
        with_zscore(rows, baseline, by, residual)
        .withColumn("is_anomaly", flag)
        .withColumn("anomaly_type", anomaly_type(F.col("is_anomaly"), F.col(residual)))
    )


def flag_sink(path: str):
    """``foreachBatch`` function that stores the flagged rows of every batch once.

    A batch that runs again after a failure overwrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.where("is_anomaly").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def run_flag_sink(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    query = (
        df.writeStream.foreachBatch(flag_sink(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def streak_alerts(
    daily: DataFrame,
    key: str = "city",
    ts: str = "date",
    value: str = "rolling_mape",
    threshold: float = SETTINGS.drift_threshold,
    streak: int = SETTINGS.drift_streak,
) -> DataFrame:
    """One row for every day that completes or prolongs a streak of values above the threshold.

    The input has one row per series and day, so a batch gives a group at most its new days. The state
    keeps the last day and the streak that it ended with; a day that is not behind that one comes too
    late to count and is dropped, so the order in which batches bring days can't make a false streak.
    """

    def follow(
        group: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        last, run = state.get if state.exists else (None, 0)
        rows = pd.concat(list(batches)).sort_values(ts)
        if last is not None:
            rows = rows[pd.to_datetime(rows[ts]) > pd.Timestamp(last)]
        if rows.empty:
            return
        breach = (rows[value] > threshold).to_numpy()
        # Days since the latest day without a breach; before the first one the old streak goes on.
        at = np.arange(len(breach))
        calm = np.maximum.accumulate(np.where(breach, -1, at))
        runs = np.where(calm < 0, at + 1 + run, at - calm)
        state.update((pd.Timestamp(rows[ts].iloc[-1]).date(), int(runs[-1])))
        rows = rows.assign(streak=runs.astype("int32"))
        yield rows.loc[rows["streak"] >= streak, [key, ts, value, "streak"]]

    return (
        daily.select(key, ts, value)
        .groupBy(key)
        .applyInPandasWithState(
            follow,
            f"`{key}` string, `{ts}` date, `{value}` double, streak int",
            "last date, streak int",
            "append",
            GroupStateTimeout.NoTimeout,
        )
    )


DAY_MS = 86_400_000


def late_streak_alerts(
    daily: DataFrame,
    key: str = "city",
    ts: str = "date",
    value: str = "rolling_mape",
    threshold: float = SETTINGS.drift_threshold,
    streak: int = SETTINGS.drift_streak,
    delay: str = "3 days",
    idle_days: int = 90,
) -> DataFrame:
    """Streak alerts in event time: days may come in any order up to ``delay`` behind the newest one.

    A day waits in the state of its series until the watermark has passed it, and then counts in the order of days, so
    batches that bring days out of order give what one sorted table gives. A timer wakes a series whose days
    become final while nothing new arrives. ``idle_days`` after its last day a series leaves the state; if it comes back, its streak
    starts anew. Days behind the watermark are dropped; of a day that comes twice the first value counts. The state of a series holds the
    days within ``delay`` and those of one batch.
    """

    def follow(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, run, days, values = state.get if state.exists else (-1, 0, [], [])
        waiting = dict(zip(days, values))
        for rows in batches:
            for at, v in zip(rows["_ms"], rows[value]):
                if at > last and at not in waiting:
                    waiting[int(at)] = None if pd.isna(v) else float(v)
        now = state.getCurrentWatermarkMs()
        final = sorted(at for at in waiting if at < now)
        alerts = []
        for at in final:
            v = waiting.pop(at)
            run = run + 1 if v is not None and v > threshold else 0
            last = at
            if run >= streak:
                alerts.append((at, v, run))
        expiry = last + idle_days * DAY_MS
        if not waiting and expiry <= now:
            if state.exists:
                state.remove()
        else:
            left = sorted(waiting)
            state.update((int(last), int(run), left, [waiting[at] for at in left]))
            state.setTimeoutTimestamp(max(left[0] if left else expiry, now + 1))
        out = pd.DataFrame(alerts, columns=["_ms", value, "streak"])
        out.insert(0, key, group[0])
        yield out

    stamped = daily.select(key, value, F.col(ts).cast("timestamp").alias("_ts")).withWatermark("_ts", delay)
    alerts = (
        stamped.select(key, value, "_ts", F.unix_millis("_ts").alias("_ms"))
        .groupBy(key)
        .applyInPandasWithState(
            follow,
            f"`{key}` string, _ms long, `{value}` double, streak int",
            "last long, run int, days array<long>, marks array<double>",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
    return alerts.select(key, F.timestamp_millis("_ms").cast("date").alias(ts), value, "streak")
