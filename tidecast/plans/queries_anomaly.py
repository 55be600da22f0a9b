"""Queries: residual baselines, flags, classes, evaluation and sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.operators import anomaly
from tidecast.plans import jobs
from tidecast.plans.catalog import SCORED, labels, query, rounded
from tidecast.plans.queries_metrics import naive, scored
from tidecast.session import scratch_path


def residuals(spark, sf_dir):
    return anomaly.add_residuals(naive(spark, sf_dir))


def stored_residuals(spark, sf_dir):
    """Residuals written once: fitting and applying a detector read them several times."""
    return jobs.materialize(residuals(spark, sf_dir), "residuals")


@query(
    "residual_baseline",
    f"with {SCORED} select round(res_mean, 6) as res_mean, round(res_std, 6) as res_std from bl",
)
def residual_baseline(spark, sf_dir):
    return rounded(anomaly.residual_baseline(residuals(spark, sf_dir)), 6, "res_mean", "res_std")


@query(
    "residual_baseline_by_city",
    f"""with {SCORED} select city, round(avg(residuals), 6) as res_mean,
  round(greatest(stddev_pop(residuals), 1e-6), 6) as res_std from resid group by 1""",
)
def residual_baseline_by_city(spark, sf_dir):
    return rounded(anomaly.residual_baseline(residuals(spark, sf_dir), ["city"]), 6, "res_mean", "res_std")


@query("zscore_flag", f"with {SCORED} select date, city, residuals, round(z_score, 6) as z_score, is_anomaly from scored")
def zscore_flag(spark, sf_dir):
    out = scored(spark, sf_dir).select("date", "city", "residuals", "z_score", "is_anomaly")
    return rounded(out, 6, "z_score")


@query("anomaly_class", f"with {SCORED} select anomaly_type, count(*) as n, sum(residuals) as total from scored group by 1")
def anomaly_class(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("anomaly_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("residuals").alias("total")
    )


@query(
    "zscore_detect",
    f"""with {SCORED}, by_city as (select city, avg(residuals) as m, greatest(stddev_pop(residuals), 1e-6) as s
  from resid group by 1)
select date, r.city, residuals, round(abs((residuals - m) / s), 6) as z_score, abs((residuals - m) / s) >= 3.0 as is_anomaly,
  case when abs((residuals - m) / s) >= 3.0 then case when residuals >= 0 then 'surge' else 'dip' end
    else 'normal' end as anomaly_type
from resid r join by_city b on b.city = r.city""",
)
def zscore_detect(spark, sf_dir):
    """One baseline per series and a higher threshold."""
    out = anomaly.detect_zscore(residuals(spark, sf_dir), threshold=3.0, by=["city"])
    return rounded(out.select("date", "city", "residuals", "z_score", "is_anomaly", "anomaly_type"), 6, "z_score")


@query(
    "anomaly_rows",
    f"""with {SCORED} select date, city, orders, pred_orders, residuals, round(0.6 * z_score, 6) as anomaly_score,
  anomaly_type from scored where is_anomaly""",
)
def anomaly_rows(spark, sf_dir):
    flagged = anomaly.anomaly_rows(scored(spark, sf_dir))
    return flagged.select(
        "date",
        "city",
        "orders",
        "pred_orders",
        "residuals",
        F.round(0.6 * F.col("z_score"), 6).alias("anomaly_score"),
        "anomaly_type",
    )


@query(
    "eval_join",
    f"with {SCORED} select date, city, is_anomaly::int as is_anomaly_pred, label as is_anomaly_true from scored",
)
def eval_join(spark, sf_dir):
    return anomaly.join_labels(scored(spark, sf_dir), labels(spark, sf_dir))


@query(
    "anomaly_prf",
    f"""with {SCORED}, j as (select city, is_anomaly as p, label = 1 as t from scored),
c as (select 'overall' as scope, 'ALL' as city, count(*) as n, count(*) filter (t) as nt, count(*) filter (p) as np,
    count(*) filter (p and t) as h from j
  union all select 'series', city, count(*), count(*) filter (t), count(*) filter (p), count(*) filter (p and t)
  from j group by city)
select scope, city, n as n_samples, nt as n_true, np as n_predicted,
  round(case when np = 0 then 0 else h / np end, 6) as precision,
  round(case when nt = 0 then 0 else h / nt end, 6) as recall,
  round(case when np + nt = 0 then 0 else 2.0::double * h / (np + nt) end, 6) as f1 from c""",
)
def anomaly_prf(spark, sf_dir):
    joined = anomaly.join_labels(scored(spark, sf_dir), labels(spark, sf_dir))
    return rounded(anomaly.evaluate_flags(joined), 6, "precision", "recall", "f1")


THRESHOLDS = [1.5, 2.0, 2.5, 3.0, 3.5, 4.0]


@query(
    "threshold_sweep",
    f"""with {SCORED} select th::double as z_threshold, count(*) filter (z_score >= th) as flagged,
  count(*) filter (z_score >= th and residuals >= 0) as surges,
  count(*) filter (z_score >= th and residuals < 0) as dips,
  round(count(*) filter (z_score >= th) / count(*), 6) as flag_rate
from scored, (select unnest({THRESHOLDS}::double[]) as th) group by th""",
)
def threshold_sweep(spark, sf_dir):
    df = residuals(spark, sf_dir)
    out = anomaly.threshold_sweep(df, anomaly.residual_baseline(df), THRESHOLDS)
    return rounded(out, 6, "flag_rate")


@query("iforest_flags")
def iforest_flags(spark, sf_dir):
    """Isolation signal alone: score and flag of every residual."""
    df = stored_residuals(spark, sf_dir)
    detector = anomaly.HybridDetector().fit(df)
    scores = detector.forest.transform(df, "residuals")
    return scores.select("date", "city", "residuals", "forest_score", (F.col("forest_score") < 0).alias("is_anomaly"))


@query("hybrid_flag")
def hybrid_flag(spark, sf_dir):
    """Either signal against both signals on the same rows."""
    df = stored_residuals(spark, sf_dir)
    detector = anomaly.HybridDetector().fit(df)
    z = F.col("z_score") >= detector.z_threshold
    forest = F.col("forest_score") < 0
    return detector.transform(df).select(
        "date",
        "city",
        anomaly.combine_signals(z, forest, strict=False).alias("flag_any"),
        anomaly.combine_signals(z, forest, strict=True).alias("flag_both"),
    )


@query("anomaly_score")
def anomaly_score(spark, sf_dir):
    df = stored_residuals(spark, sf_dir)
    scored_rows = anomaly.HybridDetector().fit(df).transform(df)
    return scored_rows.select("date", "city", "z_score", "forest_score", "anomaly_score")


@query("hybrid_detect")
def hybrid_detect(spark, sf_dir):
    """Fit, save, load and apply the detector."""
    df = stored_residuals(spark, sf_dir)
    path = scratch_path(spark, "detector")
    anomaly.HybridDetector().fit(df).save(path)
    detector = anomaly.HybridDetector.load(spark, path)
    return detector.transform(df).select(
        "date", "city", "orders", "pred_orders", "residuals", "is_anomaly", "anomaly_score", "anomaly_type"
    )


@query("hybrid_evaluate")
def hybrid_evaluate(spark, sf_dir):
    """Precision, recall and F1 of the hybrid detector against the labels."""
    df = stored_residuals(spark, sf_dir)
    flagged = anomaly.resolve_flags(df, anomaly.HybridDetector().fit(df))
    return anomaly.evaluate_flags(anomaly.join_labels(flagged, labels(spark, sf_dir)))


@query(
    "detector_facts",
    f"""with {SCORED}, n as (select count(*) as n from resid)
select date, city, round(z_score, 6) as z_score, true as consistent from scored""",
    python=True,
)
def detector_facts(spark, sf_dir):
    """The z-score, and whether flag, severity and class of a row follow from its two signals."""
    df = stored_residuals(spark, sf_dir)
    out = anomaly.HybridDetector().fit(df).transform(df)
    flag = (F.col("z_score") >= 2.5) | (F.col("forest_score") < 0)
    severity = 0.6 * F.col("z_score") + 0.4 * F.greatest(F.lit(0.0), -10.0 * F.col("forest_score"))
    kind = F.when(~flag, "normal").when(F.col("residuals") >= 0, "surge").otherwise("dip")
    same = (F.col("is_anomaly") == flag) & (F.abs(severity - F.col("anomaly_score")) < 1e-9) & (F.col("anomaly_type") == kind)
    return rounded(out.select("date", "city", "z_score", same.alias("consistent")), 6, "z_score")


@query(
    "forest_share",
    f"""with {SCORED} select count(*) as n_rows, cast(ceil(0.01::double * (count(*) - 1)) as bigint) as most_flagged, true as within
from resid""",
    python=True,
)
def forest_share(spark, sf_dir):
    """Rows that the forest flags against the contamination: no more than that percentile lets through."""
    df = stored_residuals(spark, sf_dir)
    detector = anomaly.HybridDetector(contamination=0.01).fit(df)
    out = detector.forest.transform(df, "residuals").agg(
        F.count("forest_score").alias("n_rows"), F.count_if(F.col("forest_score") < 0).alias("flagged")
    )
    most = F.ceil(F.lit(0.01) * (F.col("n_rows") - 1))
    within = (F.col("flagged") <= most) & (F.col("flagged") > 0)
    return out.select("n_rows", most.cast("bigint").alias("most_flagged"), within.alias("within"))
