"""Ensemble forecaster: pooled trees and per-series additive models, intervals, horizon forecasts."""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidecast.config import (
    ENCODING_FEATURE,
    FEATURE_COLUMNS,
    FLAG_COLUMNS,
    LAG_FEATURES,
    LAGS,
    RATIO_FEATURES,
    ROLLING_FEATURES,
    ROLLING_WINDOWS,
    SETTINGS,
    TREE_FEATURES,
)
from tidecast.functions.columns import (
    calendar_columns,
    finite_or_zero,
    interaction_columns,
    weather_columns,
)
from tidecast.functions.quantiles import quantiles, value_counts
from tidecast.operators import trees
from tidecast.operators.additive import fit_additive, predict_additive, with_series_params
from tidecast.operators.features import (
    apply_target_encoding,
    build_features,
    fit_target_encoding,
    last_rows,
)
from tidecast.operators.profiles import apply_series_profiles, fit_series_profiles
from tidecast.operators.quantile_trees import QuantileTrees, fit_quantile_trees
from tidecast.session import scratch_path
from tidecast.sources.promos import overlay_promos
from tidecast.sources.weather import override_weather

#: Features that depend on earlier targets and change while a forecast rolls forward.
RECURSIVE = (*LAG_FEATURES, *ROLLING_FEATURES, *RATIO_FEATURES)
TAIL = max(LAGS)


def blend(tree: Column, additive: Column, tree_weight: float, additive_weight: float) -> Column:
    """Weighted mean prediction, finite and not negative."""
    return finite_or_zero(tree * F.lit(tree_weight) + additive * F.lit(additive_weight))


def residual_quantiles(
    df: DataFrame, alphas: tuple[float, ...], residual: str = "residuals", key: str = "city"
) -> DataFrame:
    """(key, quantiles): exact residual quantiles per series, in the order of ``alphas``."""
    return quantiles(value_counts(df, [key], residual), [key], list(alphas)).select(key, "quantiles")


def band_name(alpha: float) -> str:
    return f"pred_p{round(alpha * 100)}"


def order_bands(df: DataFrame, alphas: tuple[float, ...]) -> DataFrame:
    """Sanitize the bands; below the median at most the mean, above it at least the mean."""
    mean = F.col("pred_orders")
    out = {}
    for alpha in alphas:
        band = F.col(band_name(alpha))
        if alpha < 0.5:
            band = F.least(band, mean)
        elif alpha > 0.5:
            band = F.greatest(band, mean)
        out[band_name(alpha)] = finite_or_zero(band)
    return df.withColumns(out)


@dataclass
class DemandForecaster:
    """Blend of one tree model over all series and one additive model per series."""

    tree_weight: float = SETTINGS.tree_weight
    additive_weight: float = SETTINGS.additive_weight
    alphas: tuple[float, ...] = SETTINGS.quantile_alphas
    rounds: int = SETTINGS.boosting_rounds
    step: float = SETTINGS.boosting_step
    depth: int = SETTINGS.tree_depth
    seed: int = SETTINGS.random_seed
    holdout: float = 0.2
    segment_rows: int | None = None
    band_rounds: int = SETTINGS.band_rounds
    tree_model: GBTRegressionModel | None = None
    encoding: DataFrame | None = None
    additive: DataFrame | None = None
    bands: DataFrame | None = None
    profiles: DataFrame | None = None
    band_trees: QuantileTrees | None = None
    _nodes: trees.Nodes | None = field(default=None, repr=False)

    def _fitted(self) -> None:
        if self.tree_model is None or self.additive is None or self.encoding is None:
            raise RuntimeError("fit or load the forecaster before using it")

    def features(self, df: DataFrame) -> DataFrame:
        """The frame with all features, encoded with the training-time means."""
        if set(FEATURE_COLUMNS) <= set(df.columns):
            return df
        raw = df.drop(*[c for c in FEATURE_COLUMNS if c in df.columns])
        return build_features(raw, self.encoding, fill="none", segment_rows=self.segment_rows)

    def tree_features(self, df: DataFrame) -> DataFrame:
        """The frame with all columns that the trees split on."""
        feats = self.features(df)
        return feats if self.profiles is None else apply_series_profiles(feats, self.profiles)

    def fit(self, df: DataFrame, intervals: bool = True) -> DemandForecaster:
        """Fit on a panel or on a feature table.

        The trees learn from rows with all lags, unless there are none. With ``intervals`` a second fit
        leaves out the newest ``holdout`` share of the days of each series; its encoding and profiles are those
        of the days before. The residuals of those days give quantiles per series, and trees on the
        pinball loss what these quantiles depend on. Both fits run at the same time.
        Fitted tables are written to the shared folder, so that predicting never fits again.
        """
        missing = {"date", "city", "orders"} - set(df.columns)
        if missing:
            raise ValueError(f"training data lacks columns: {sorted(missing)}")
        spark = df.sparkSession
        self.encoding = _stored(spark, fit_target_encoding(df), "encoding")
        self.profiles = _stored(spark, fit_series_profiles(df), "profiles")
        feats = self.features(df)
        if feats is not df:
            # Both fits and the additive model read the features; built ones are stored once.
            feats = _stored(spark, feats, "features")
        with ThreadPool(2) as pool:
            bands = pool.apply_async(self._fit_bands, (feats,)) if intervals else None
            self.tree_model = self._fit_trees(feats, self.profiles)
            self.additive = _stored(spark, fit_additive(feats), "additive")
            self.bands, self.band_trees = bands.get() if bands else (None, None)
        self._nodes = None
        return self

    def _fit_trees(self, feats: DataFrame, profiles: DataFrame) -> GBTRegressionModel:
        feats = apply_series_profiles(feats, profiles, leave_out=True)
        complete = feats.where(F.col(f"orders_lag_{max(LAGS)}").isNotNull())
        rows = feats if complete.isEmpty() else complete
        return trees.fit_trees(rows, "orders", self.rounds, self.step, self.depth, self.seed)

    def _fit_bands(self, feats: DataFrame) -> tuple[DataFrame, QuantileTrees]:
        """Residual quantiles per series on its newest days, by a model that has not seen them, and their corrections."""
        day = F.col("date").cast("date")
        span = feats.groupBy("city").agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
        kept = F.floor(F.datediff("_hi", "_lo") * (1.0 - self.holdout)).cast("int")
        cuts = span.select("city", F.date_add("_lo", kept).alias("_cut"))
        placed = feats.drop(ENCODING_FEATURE).join(cuts, "city")
        early, late = (placed.where(c).drop("_cut") for c in (day <= F.col("_cut"), day > F.col("_cut")))
        early = _stored(feats.sparkSession, early, "early")
        encoding = _stored(feats.sparkSession, fit_target_encoding(early), "encoding")
        profiles = _stored(feats.sparkSession, fit_series_profiles(early), "profiles")
        model = self._fit_trees(apply_target_encoding(early, encoding), profiles)
        scored = trees.predict_trees(model, apply_series_profiles(apply_target_encoding(late, encoding), profiles))
        residual = (F.col("orders").cast("double") - F.col("tree_pred")).alias("residuals")
        held_out = _stored(feats.sparkSession, scored.select("city", *TREE_FEATURES, residual), "held-out")
        bands = _stored(feats.sparkSession, residual_quantiles(held_out, self.alphas), "bands")
        store = lambda df: _stored(feats.sparkSession, df, "left")
        placed = held_out.join(bands, "city")
        return bands, fit_quantile_trees(placed, self.alphas, store, rounds=self.band_rounds, seed=self.seed)

    def components(self, df: DataFrame) -> DataFrame:
        """Add tree_pred, additive_pred and additive_sigma."""
        self._fitted()
        return predict_additive(trees.predict_trees(self.tree_model, self.tree_features(df)), self.additive)

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``pred_orders`` next to the two components."""
        return self.components(df).withColumn(
            "pred_orders",
            blend(F.col("tree_pred"), F.col("additive_pred"), self.tree_weight, self.additive_weight),
        )

    def predict_intervals(self, df: DataFrame) -> DataFrame:
        """Add ``pred_orders`` and one band column per alpha."""
        predicted = self.predict(df)
        if self.band_trees is None:
            return self._with_bands(predicted)
        return self._with_bands(predicted, [self.band_trees.column(a) for a in self.alphas])

    def _with_bands(self, predicted: DataFrame, corrections: list[Column] | None = None) -> DataFrame:
        """Bands around predictions: the series' quantile of residuals, and what the features change in it.

        Without fitted bands every band equals the mean.
        """
        if self.bands is None:
            return predicted.withColumns({band_name(a): F.col("pred_orders") for a in self.alphas})
        out = with_series_params(predicted, self.bands)
        for i, alpha in enumerate(self.alphas):
            tree = F.col("tree_pred") + F.col("_params.quantiles")[i]
            if corrections is not None:
                tree = tree + corrections[i]
            z = NormalDist().inv_cdf(alpha)
            additive = F.col("additive_pred") + F.lit(z) * F.col("additive_sigma")
            out = out.withColumn(
                band_name(alpha),
                tree * F.lit(self.tree_weight) + additive * F.lit(self.additive_weight),
            )
        return order_bands(out.drop("_params"), self.alphas)

    def nodes(self, spark: SparkSession) -> trees.Nodes:
        self._fitted()
        if self._nodes is None:
            self._nodes = trees.Nodes.of(trees.node_table(spark, self.tree_model))
        return self._nodes

    def forecast_future(
        self,
        history: DataFrame,
        horizon_days: int,
        weather: DataFrame | None = None,
        promos: DataFrame | None = None,
    ) -> DataFrame:
        """``horizon_days`` rows per series behind its last day, each fed with the ones before.

        Everything known in advance (calendar, weather, promotions, additive part) is computed by
        Spark expressions on the horizon rows. A series then is one row: its last 28 targets and its
        horizon. Only the recursion over lags and trees runs in Python, on whole batches of series.
        """
        self._fitted()
        if horizon_days < 1:
            raise ValueError("horizon_days must be at least 1")
        grid = self.horizon_rows(history, horizon_days)
        if promos is not None:
            grid = overlay_promos(grid, promos)
        if weather is not None:
            grid = override_weather(grid, weather)
        static = grid.withColumns(
            calendar_columns() | weather_columns(grid.columns) | interaction_columns(grid.columns)
        )
        static = predict_additive(apply_target_encoding(static, self.encoding), self.additive)
        if self.profiles is not None:
            static = apply_series_profiles(static, self.profiles)
        known = [c for c in TREE_FEATURES if c not in RECURSIVE and c in static.columns]
        day = F.struct(
            "date",
            *[c for c in grid.columns if c not in ("date", "city")],
            "additive_pred",
            "additive_sigma",
            F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in known]).alias("known"),
        )
        # The days asked for and TAIL targets per series.
        days = static.groupBy("city").agg(F.array_sort(F.collect_list(day)).alias("days"))
        tail = (
            last_rows(history.select("city", "date", "orders"), TAIL)
            .groupBy("city")
            .agg(F.array_sort(F.collect_list(F.struct("date", F.col("orders").cast("double").alias("y")))).alias("t"))
        )
        corrections = [self.band_trees.scorer(a) for a in self.alphas] if self.band_trees is not None else []
        roll = _roll_forward(self.nodes(history.sparkSession), self.tree_weight, self.additive_weight, known, corrections)
        rolled = days.join(tail, "city").withColumn(
            "steps",
            roll(F.col("t.y"), F.flatten(F.col("days.known")), F.col("days.additive_pred")),
        )
        steps = [F.col(f"steps.{c}").alias(to) for c, to in (("tree", "tree_pred"), ("mean", "pred_orders"), ("bands", "_bands"))]
        rows = rolled.select("city", F.explode(F.arrays_zip("days", *steps)).alias("z"))
        rows = rows.select("city", "z.days.*", "z.tree_pred", "z.pred_orders", "z._bands")
        out = self._with_bands(rows, [F.col("_bands")[i] for i in range(len(corrections))] or None)
        return out.withColumn("orders", F.col("pred_orders")).withColumn("is_future", F.lit(True)).drop("known", "_bands")

    @staticmethod
    def horizon_rows(history: DataFrame, horizon_days: int) -> DataFrame:
        """Future rows: flags 0, weather at the series' mean, ``short_history`` below 30 rows."""
        weather = [c for c in ("temperature_c", "rainfall_mm") if c in history.columns]
        ends = history.groupBy("city").agg(
            F.max(F.col("date").cast("date")).alias("_last"),
            (F.count(F.lit(1)) < 30).alias("short_history"),
            *[F.avg(c).alias(c) for c in weather],
        )
        days = F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon_days))
        flags = {c: F.lit(0) for c in FLAG_COLUMNS if c in history.columns}
        return ends.withColumn("date", F.explode(days)).drop("_last").withColumns(flags)

    def save(self, path: str) -> None:
        """Tree model in its own format, fitted tables as Parquet."""
        self._fitted()
        spark = self.additive.sparkSession
        settings = [
            (
                self.tree_weight,
                self.additive_weight,
                list(self.alphas),
                self.rounds,
                self.step,
                self.depth,
                self.seed,
                self.holdout,
                self.segment_rows,
                self.bands is not None,
                self.band_rounds,
            )
        ]
        spark.createDataFrame(
            settings,
            "tree_weight double, additive_weight double, alphas array<double>, rounds int, "
            "step double, depth int, seed int, holdout double, segment_rows int, has_bands boolean, band_rounds int",
        ).write.mode("overwrite").parquet(f"{path}/settings")
        self.tree_model.write().overwrite().save(f"{path}/trees")
        self.encoding.write.mode("overwrite").parquet(f"{path}/encoding")
        self.additive.write.mode("overwrite").parquet(f"{path}/additive")
        self.profiles.write.mode("overwrite").parquet(f"{path}/profiles")
        if self.bands is not None:
            self.band_trees.table(spark).write.mode("overwrite").parquet(f"{path}/band_trees")
            self.bands.write.mode("overwrite").parquet(f"{path}/bands")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DemandForecaster:
        try:
            s = spark.read.parquet(f"{path}/settings").first()
        except AnalysisException as error:
            raise FileNotFoundError(path) from error
        return cls(
            tree_weight=s.tree_weight,
            additive_weight=s.additive_weight,
            alphas=tuple(s.alphas),
            rounds=s.rounds,
            step=s.step,
            depth=s.depth,
            seed=s.seed,
            holdout=s.holdout,
            segment_rows=s.segment_rows,
            band_rounds=s.band_rounds,
            tree_model=GBTRegressionModel.load(f"{path}/trees"),
            encoding=spark.read.parquet(f"{path}/encoding"),
            additive=spark.read.parquet(f"{path}/additive"),
            bands=spark.read.parquet(f"{path}/bands") if s.has_bands else None,
            profiles=spark.read.parquet(f"{path}/profiles"),
            band_trees=QuantileTrees.of(spark.read.parquet(f"{path}/band_trees"), tuple(s.alphas)) if s.has_bands else None,
        )


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a fitted table to the shared folder and read it back."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _recursive_features(past: np.ndarray) -> np.ndarray:
    """Lags, rolling statistics and ratios of the next day, from rows of the last TAIL targets.

    Unknown targets are NaN at the front; what depends on them alone is 0.
    """
    lags = np.stack([past[:, -n] for n in LAGS], axis=1)
    rolling = []
    for size in ROLLING_WINDOWS:
        window = past[:, -size:]
        known = np.isfinite(window)
        count = known.sum(axis=1)
        values = np.where(known, window, 0.0)
        mean = values.sum(axis=1) / np.maximum(count, 1)
        spread = (np.where(known, window - mean[:, None], 0.0) ** 2).sum(axis=1)
        std = np.sqrt(spread / np.maximum(count - 1, 1))
        low = np.where(known, window, np.inf).min(axis=1)
        high = np.where(known, window, -np.inf).max(axis=1)
        rolling += [mean, std, np.where(count, low, 0.0), np.where(count, high, 0.0)]
    rolled = np.stack(rolling, axis=1)
    ratio = lags[:, LAGS.index(1)] / (lags[:, LAGS.index(7)] + 1.0)
    mean_ratio = rolled[:, 0] / (rolled[:, ROLLING_FEATURES.index("rolling_mean_28")] + 1.0)
    return np.nan_to_num(np.column_stack([lags, rolled, ratio, mean_ratio]))


def _roll_forward(nodes: trees.Nodes, tree_weight: float, additive_weight: float, known: list[str], corrections: list):
    """Function of (tail, known features of all days, additive predictions) -> predictions per day, and what each of ``corrections`` adds to its band."""
    place_known = [TREE_FEATURES.index(c) for c in known]
    place_recursive = [TREE_FEATURES.index(c) for c in RECURSIVE]

    @F.pandas_udf("tree array<double>, mean array<double>, bands array<array<double>>")
    def roll(tails: pd.Series, static: pd.Series, additive: pd.Series) -> pd.DataFrame:
        past = np.full((len(tails), TAIL), np.nan)
        for i, tail in enumerate(tails):
            if len(tail):
                past[i, -len(tail) :] = tail
        added = np.stack(additive.to_numpy())
        fixed = np.stack(static.to_numpy()).reshape(len(tails), added.shape[1], len(known))
        tree, mean = np.empty_like(added), np.empty_like(added)
        bands = np.zeros((*added.shape, len(corrections)))
        x = np.zeros((len(tails), len(TREE_FEATURES)))
        for step in range(added.shape[1]):
            x[:, place_known] = fixed[:, step]
            x[:, place_recursive] = _recursive_features(past)
            tree[:, step] = nodes.score(x)
            for i, score in enumerate(corrections):
                bands[:, step, i] = score(x)
            raw = tree_weight * tree[:, step] + additive_weight * added[:, step]
            mean[:, step] = np.maximum(0.0, np.nan_to_num(raw, nan=0.0, posinf=0.0, neginf=0.0))
            past = np.column_stack([past[:, 1:], mean[:, step]])
        return pd.DataFrame({"tree": list(tree), "mean": list(mean), "bands": [list(b) for b in bands]})

    return roll
