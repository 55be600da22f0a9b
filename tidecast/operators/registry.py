"""Versioned forecasters with a manifest table, and champion/challenger comparison.

A registered model lies in a folder of its own that is never written again. It counts from the moment its manifest
entry gets its name, by a rename that fails if the name is taken: so two registrations of one tag at the same time get
two numbers, the higher one is what the tag means, and a reader sees either a whole version or none.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidecast.operators.features import apply_target_encoding
from tidecast.operators.forecast import DemandForecaster

MANIFEST_SCHEMA = (
    "tag string, number long, created_at timestamp, description string, tree_weight double, additive_weight double, "
    "folder string, is_fitted boolean"
)


def compare_predictions(
    df: DataFrame, pred_a: str, pred_b: str, actual: str = "orders"
) -> DataFrame:
    """One row of MAPE, RMSE, MAE for both columns and a - b differences; positive: b is better."""
    aggs = []
    for side, pred in (("a", pred_a), ("b", pred_b)):
        y = F.col(actual).cast("double")
        err = y - F.col(pred)
        aggs += [
            F.avg(F.abs(err) / F.greatest(y, F.lit(1.0)) * 100.0).alias(f"mape_{side}"),
            F.sqrt(F.avg(err * err)).alias(f"rmse_{side}"),
            F.avg(F.abs(err)).alias(f"mae_{side}"),
        ]
    return df.agg(*aggs).withColumns(
        {
            "mape_a_minus_b": F.col("mape_a") - F.col("mape_b"),
            "rmse_a_minus_b": F.col("rmse_a") - F.col("rmse_b"),
        }
    )


class ModelRegistry:
    """Forecasters below one folder, one sub-folder per registration, and a manifest of one JSON file each."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def history(self) -> DataFrame:
        """One row per registration; ``number`` counts those of a tag from 1."""
        try:
            return self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.root}/manifest")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)

    def manifest(self, as_of: dt.datetime | None = None) -> DataFrame:
        """One row per tag, its latest registration; with ``as_of`` the latest of those made until then."""
        rows = self.history()
        if as_of is not None:
            rows = rows.where(F.col("created_at") <= F.lit(as_of))
        newest = F.max_by(F.struct(*[c for c in rows.columns if c != "tag"]), "number").alias("m")
        return rows.groupBy("tag").agg(newest).select("tag", "m.*")

    def register(
        self,
        model: DemandForecaster,
        tag: str,
        description: str = "",
        created_at: dt.datetime | None = None,
    ) -> int:
        """Store the model and name it; the number of this registration of the tag."""
        if model.tree_model is None:
            raise ValueError("cannot register an unfitted model")
        folder = f"versions/{uuid.uuid4().hex}"
        model.save(f"{self.root}/{folder}")
        moment = created_at or dt.datetime.now(dt.timezone.utc)
        if moment.tzinfo is None:
            # Without a zone, a time is one of the session's.
            moment = self.spark.createDataFrame([(moment,)], "t timestamp").select(F.unix_micros("t")).first()[0]
            moment = dt.datetime.fromtimestamp(moment / 1e6, dt.timezone.utc)
        entry = {
            "tag": tag, "created_at": moment.isoformat(timespec="microseconds"), "description": description,
            "tree_weight": model.tree_weight, "additive_weight": model.additive_weight, "folder": folder, "is_fitted": True,
        }
        taken = self.history().where(F.col("tag") == tag).agg(F.max("number")).first()[0] or 0
        while True:
            taken += 1
            if self._commit(f"{tag}-{taken}.json", json.dumps(entry | {"number": taken})):
                return taken

    def _commit(self, name: str, text: str) -> bool:
        """Write an entry under a hidden name, then rename it; False if the name is taken."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        folder = hadoop.fs.Path(f"{self.root}/manifest")
        files = folder.getFileSystem(conf)
        files.mkdirs(folder)
        draft, final = hadoop.fs.Path(folder, f".{uuid.uuid4().hex}"), hadoop.fs.Path(folder, name)
        out = files.create(draft, False)
        out.write(bytearray((text + "\n").encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(hadoop.fs.Options.Rename, 0)
        try:
            qualified = [files.makeQualified(p) for p in (draft, final)]
            hadoop.fs.FileContext.getFileContext(files.getUri(), conf).rename(*qualified, options)
        except Py4JJavaError as error:
            files.delete(draft, False)
            if "FileAlreadyExistsException" not in error.java_exception.toString():
                raise
            return False
        return True

    def load_version(self, tag: str) -> DemandForecaster:
        """The model that a tag means now; a later registration does not touch what has been loaded."""
        found = self.manifest().where(F.col("tag") == tag).first()
        if found is None:
            raise ValueError(f"version '{tag}' is not in the registry")
        return DemandForecaster.load(self.spark, f"{self.root}/{found.folder}")

    def age_days(self, tag: str, as_of: dt.datetime) -> float | None:
        """Days from the registration of what a tag meant at ``as_of`` until then; None without one."""
        at = F.lit(as_of)
        age = (F.unix_micros(at.cast("timestamp")) - F.unix_micros("created_at")) / F.lit(86_400_000_000)
        found = self.manifest(as_of).where(F.col("tag") == tag).select(age.alias("age")).first()
        return None if found is None else found.age

    def list_versions(self) -> DataFrame:
        """Newest first."""
        return self.manifest().orderBy(F.desc("created_at"), "tag")

    def compare(self, tag_a: str, tag_b: str, df: DataFrame) -> DataFrame:
        """Both versions on the same rows, carried side by side: no join is needed."""
        a, b = self.load_version(tag_a), self.load_version(tag_b)
        parts = ["tree_pred", "additive_pred", "additive_sigma"]
        first = a.predict(df).withColumnRenamed("pred_orders", "pred_a").drop(*parts)
        # The encoding feature belongs to the version, so the second one encodes anew.
        both = b.predict(_reencoded(first, b)).withColumnRenamed("pred_orders", "pred_b")
        return compare_predictions(both, "pred_a", "pred_b")


def _reencoded(df: DataFrame, model: DemandForecaster) -> DataFrame:
    return apply_target_encoding(df.drop("city_target_enc"), model.encoding)
