"""Importances, top features and explanations from SHAP values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.functions.columns import half_even, shortest


def feature_importance(df: DataFrame, features: list[str], values: str = "shap_values") -> DataFrame:
    """Mean |SHAP| per feature, largest first: one aggregation, then one row per feature."""
    means = df.agg(*[F.avg(F.abs(F.col(values)[i])).alias(f"m{i}") for i in range(len(features))])
    rows = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.col(f"m{i}").alias("importance")) for i, name in enumerate(features)])
    return means.select(F.inline(rows)).orderBy(F.desc("importance"), "feature")


def _ranked(features: list[str], values: str, top_n: int) -> Column:
    """The row's top features by |SHAP| as an array, without leaving the row; equal values keep feature order."""
    entries = F.array(*[
        F.struct((-F.abs(F.col(values)[i])).alias("falling"), F.lit(i).alias("position"),
                 F.lit(name).alias("feature"), F.col(values)[i].alias("value"),
                 F.col(name).cast("double").alias("feature_value"))
        for i, name in enumerate(features)])
    return F.slice(F.array_sort(entries), 1, top_n)


def top_features(df: DataFrame, features: list[str], keys: list[str], values: str = "shap_values",
                 top_n: int = 3) -> DataFrame:
    """(keys, rank, feature, shap_value), one row per rank."""
    ranked = df.select(*keys, F.posexplode(_ranked(features, values, top_n)).alias("pos", "f"))
    return ranked.select(
        *keys, (F.col("pos") + 1).alias("rank"), F.col("f.feature").alias("feature"),
        half_even("f.value", 4).alias("shap_value"))


def explain_rows(df: DataFrame, features: list[str], name: Column, values: str = "shap_values",
                 top_n: int = 3) -> Column:
    """Text that names the row's top factors, their values, signed SHAP values and directions."""
    def line(entry, i):
        shap = half_even(entry["value"], 4)
        direction = F.when(shap > 0, "pushes TOWARD anomaly").otherwise("pushes AWAY from anomaly")
        return F.concat(
            F.lit("  "), (i + 1).cast("string"), F.lit(". "), entry["feature"], F.lit(" = "),
            shortest(entry["feature_value"], 4), F.lit(" (SHAP: "), F.format_string("%+.4f", shap),
            F.lit(") — "), direction)

    lines = F.transform(_ranked(features, values, top_n), line)
    head = F.concat(F.lit("Row "), name, F.lit(":"))
    return F.concat_ws("\n", head, F.lit(f"  Top {top_n} factors:"), F.array_join(lines, "\n"))


def named_features(explanations: DataFrame, features: list[str]) -> DataFrame:
    """(feature, explained): how many of the texts of ``explain_rows`` name the feature as a factor; one aggregation."""
    counts = explanations.agg(*[
        F.count(F.when(F.col("explanation").contains(f". {c} = "), 1)).alias(f"n{i}") for i, c in enumerate(features)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("explained")) for i, c in enumerate(features)])))


def anomaly_explain_table(df: DataFrame, shap: DataFrame, features: list[str], keys: list[str],
                          rows: int | None = None, top_n: int = 3) -> DataFrame:
    """All anomalies (or the latest ``rows``) with their top features and directions.

    Features and SHAP values are joined on the row's key.
    """
    wanted = df.filter(F.col("is_anomaly") == 1)
    if rows is not None:
        wanted = wanted.orderBy(F.desc("c_date"), *keys).limit(rows)
    joined = shap.select(*keys, *features, "shap_values").join(wanted.select(*keys), keys)
    ranked = top_features(joined, features, keys, top_n=top_n)
    return ranked.withColumn(
        "direction", F.when(F.col("shap_value") > 0, "TOWARD anomaly").otherwise("AWAY from anomaly"))


def save_shap(df: DataFrame, features: list[str], keys: list[str], path: str) -> None:
    """Keys, values and feature names as one table."""
    names = F.array(*[F.lit(f) for f in features])
    df.select(*keys, "shap_values", names.alias("feature_names")).write.mode("overwrite").parquet(path)


def load_shap(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
