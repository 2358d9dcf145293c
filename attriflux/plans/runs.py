"""End-to-end runs: facts to features, attribution report, model runs, explanations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.explain.report import explain_rows, feature_importance, load_shap, named_features, save_shap
from attriflux.explain.shap import explain
from attriflux.ml.models import Comparison, Trained, compare_anomaly_models, compare_forecast_models
from attriflux.ml.prepare import business_key
from attriflux.operators import attribution as attr
from attriflux.operators import tracking
from attriflux.operators.features import engineer_features
from attriflux.operators.journeys import touchpoints
from attriflux.sources.facts import combine_checked, load_campaigns, save_table, source_summary


def run_collection(frames: Mapping[str, DataFrame], path: str, start: str | None = None,
                   end: str | None = None, spark: SparkSession | None = None) -> tuple[DataFrame | None, list[dict[str, str]]]:
    """Combine all sources, save them, and return the per-source summary and the errors.

    Without dates, the last 30 days up to today are collected. Rows with a value
    that cannot be read are left out and saved at ``path``-rejected (source, column, raw text); the
    summary counts them: ``unread_dates`` and ``rejected_values``. A source of which nothing else is left has a row too.
    """
    today = dt.date.today()
    spark = spark or SparkSession.getActiveSession()
    combined, rejected, errors = combine_checked(
        spark, frames, start or str(today - dt.timedelta(days=30)), end or str(today))
    if combined is None:
        return None, errors
    save_table(combined, path)
    save_table(rejected, f"{path}-rejected")
    summary = source_summary(spark.read.parquet(path))
    bad = spark.read.schema(rejected.schema).parquet(f"{path}-rejected").groupBy(F.col("source").alias("_name")).agg(
        F.count(F.when(F.col("column") == "c_date", 1)).alias("unread_dates"), F.count(F.lit(1)).alias("rejected_values"))
    names = spark.createDataFrame([(n,) for n in frames if n not in {e["connector"] for e in errors}], "_name string")
    bad = names.join(bad, "_name", "left").fillna(0, ["unread_dates", "rejected_values"])
    summary = summary.join(F.broadcast(bad), F.col("source") == F.col("_name"), "full")        # a row per source
    named = F.coalesce("source", "_name").alias("source")
    summary = summary.filter("source IS NOT NULL OR rejected_values > 0")
    return summary.select(named, *[c for c in summary.columns if c not in ("source", "_name")]), errors


def run_features(spark: SparkSession, original: str, out: str, combined: str | None = None,
                 source: str = "auto", fmt: str = "csv") -> DataFrame:
    """Raw facts to a saved feature table."""
    save_table(engineer_features(load_campaigns(spark, original, combined, source, fmt)), out)
    return spark.read.parquet(out)


def attribution_report(touches: DataFrame, path: str) -> dict[str, DataFrame]:
    """Journeys, all five models, comparison, misattribution, tracking loss and insights.

    Journeys and results are written and read back, so that each is computed once.
    """
    spark = touches.sparkSession
    save_table(touchpoints(touches), f"{path}/journeys")
    journeys = spark.read.parquet(f"{path}/journeys")
    save_table(attr.attribution(journeys), f"{path}/attribution")
    results = spark.read.parquet(f"{path}/attribution")
    insights = tracking.attribution_insights(journeys, results)
    tracking.insights_json(insights).write.mode("overwrite").text(f"{path}/insights")
    return {
        "journeys": journeys, "results": results,
        "comparison": attr.compare_models(results),
        "misattribution": attr.find_misattribution(results),
        "tracking_total": tracking.tracking_loss_total(journeys),
        "tracking_by_channel": tracking.tracking_loss_by_channel(journeys),
        "insights": spark.read.text(f"{path}/insights").withColumnRenamed("value", "insights"),
    }


def run_anomaly_detection(features: DataFrame, path: str | None = None) -> Comparison:
    """Train, evaluate and compare the anomaly models; save the best one."""
    return _saved(compare_anomaly_models(features), features.sparkSession, path)


def run_forecaster(features: DataFrame, path: str | None = None) -> Comparison:
    """Train, evaluate and compare the ROAS models; save the best one."""
    return _saved(compare_forecast_models(features), features.sparkSession, path)


def _saved(result: Comparison, spark: SparkSession, path: str | None) -> Comparison:
    if path is not None:
        result.best.save(spark, path, result.metrics)
    return result


def run_explainer(features: DataFrame, anomaly: Trained, forecast: Trained, path: str) -> dict[str, DataFrame]:
    """SHAP values of all rows for both models, their importances, and all anomalies explained.

    Every step is written and the next one reads it: the rows with their values, the SHAP values
    that importances are made of, and the explanations, of which ``named`` counts the features.
    """
    spark = features.sparkSession
    keys = business_key(features)
    out = {}
    for task, model in (("anomaly", anomaly), ("forecaster", forecast)):
        names = list(model.scaler.features)
        explained = explain(model, features)
        explained.select(*keys, "is_anomaly", *names, "shap_values").write.mode("overwrite").parquet(f"{path}/{task}_rows")
        explained = spark.read.parquet(f"{path}/{task}_rows")
        save_shap(explained, names, keys, f"{path}/{task}_shap")
        out[task] = feature_importance(load_shap(spark, f"{path}/{task}_shap"), names)
        if task == "anomaly":
            flagged = explained.filter(F.col("is_anomaly") == 1)
            name = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
            save_table(flagged.select(*keys, explain_rows(flagged, names, name).alias("explanation")), f"{path}/explanations")
            out["explanations"] = spark.read.parquet(f"{path}/explanations")
            out["named"] = named_features(out["explanations"], names)
    return out
