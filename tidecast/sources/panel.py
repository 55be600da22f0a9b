"""Reading, writing and densifying the panel, its labels and its feature table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidecast.config import FLAG_COLUMNS, REQUIRED_COLUMNS
from tidecast.operators.features import build_features
from tidecast.operators.quality import DataValidationError, validate_orders

LABEL_SCHEMA = "date date, city string, is_anomaly int"


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def read_orders(spark: SparkSession, path: str, as_of: dt.date | None = None) -> DataFrame:
    """Read an orders file or folder (CSV, or Parquet by name) and validate it."""
    try:
        if path.rstrip("/").endswith(".parquet"):
            raw = spark.read.parquet(path)
        else:
            # Text columns: a value that does not convert is a reported violation, not a lost row.
            raw = spark.read.csv(path, header=True, inferSchema=False)
    except AnalysisException as error:
        if _missing(error):
            raise DataValidationError(f"Orders dataset file does not exist at: {path}") from error
        raise
    return validate_orders(raw, as_of)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Ground-truth labels from CSV; an absent file is an empty table."""
    try:
        return spark.read.schema(LABEL_SCHEMA).csv(path, header=True)
    except AnalysisException as error:
        if _missing(error):
            return spark.createDataFrame([], LABEL_SCHEMA)
        raise


def write_orders_and_labels(df: DataFrame, orders_path: str, labels_path: str) -> None:
    """Two CSV sinks; the label column never reaches the orders file."""
    orders = df.select(*[c for c in df.columns if c != "is_anomaly"])
    orders.write.mode("overwrite").csv(orders_path, header=True)
    df.select("date", "city", F.col("is_anomaly").cast("int")).write.mode("overwrite").csv(
        labels_path, header=True
    )


def write_features(df: DataFrame, path: str, key: str = "city", partitioned: bool = False) -> None:
    """Feature table as Parquet, or CSV when the path says so.

    Rows are clustered by series inside the files, so a filter on the series skips row groups.
    One folder per series (``partitioned``) only suits a panel with few series.
    """
    if path.rstrip("/").endswith(".csv"):
        df.write.mode("overwrite").csv(path, header=True)
        return
    writer = df.sortWithinPartitions(key, "date").write.mode("overwrite")
    if partitioned:
        writer = writer.partitionBy(key)
    writer.parquet(path)


def read_features(
    spark: SparkSession, parquet_path: str, csv_path: str | None = None, orders_path: str | None = None
) -> DataFrame:
    """The stored feature table; else its CSV twin; else features built from the raw orders."""
    try:
        return spark.read.parquet(parquet_path)
    except AnalysisException as error:
        if not _missing(error):
            raise
    if csv_path is not None:
        try:
            return spark.read.csv(csv_path, header=True, inferSchema=True)
        except AnalysisException as error:
            if not _missing(error):
                raise
    if orders_path is None:
        raise FileNotFoundError(parquet_path)
    return build_features(read_orders(spark, orders_path))


def daily_panel(
    facts: DataFrame, key: str, ts: str, quantity: str, target: str = "orders"
) -> DataFrame:
    """Sum raw facts to one row per series and day: the grain all operators rely on."""
    return facts.groupBy(F.col(key).alias("city"), F.col(ts).cast("date").alias("date")).agg(
        F.sum(quantity).cast("bigint").alias(target)
    )


def calendar_grid(
    df: DataFrame, key: str = "city", ts: str = "date", per_series: bool = False
) -> DataFrame:
    """Every day from the first to the last for every series.

    Each series row explodes into its own days, so no cross join is planned.
    """
    spans = df.groupBy(key).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    if not per_series:
        whole = spans.agg(F.struct(F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).alias("s"))
        spans = spans.select(key).withColumn("_s", whole.scalar())
        spans = spans.select(key, F.col("_s.lo").alias("_lo"), F.col("_s.hi").alias("_hi"))
    return spans.select(key, F.explode(F.sequence("_lo", "_hi")).alias(ts))


def densify(
    df: DataFrame, key: str = "city", ts: str = "date", target: str = "orders", per_series: bool = False
) -> DataFrame:
    """One row per series and calendar day; days without orders get 0, flags 0, weather NULL."""
    grid = calendar_grid(df, key, ts, per_series)
    zero = [c for c in (target, *FLAG_COLUMNS) if c in df.columns]
    return grid.join(df, [key, ts], "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in zero}
    )


def union_history_future(history: DataFrame, future: DataFrame) -> DataFrame:
    """History rows and horizon rows in one frame, marked by ``is_future``."""
    return history.withColumn("is_future", F.lit(False)).unionByName(
        future.withColumn("is_future", F.lit(True)), allowMissingColumns=True
    )
