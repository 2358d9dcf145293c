"""Classification and regression metrics as one conditional aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attriflux.functions.columns import half_even, ratio
from attriflux.operators.reports import model_leaderboard


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing to divide by."""
    return F.coalesce(ratio(part.cast("double"), whole), F.lit(0.0))


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _share(2 * tp, 2 * tp + fp + fn)


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           by: list[str] | None = None) -> DataFrame:
    """accuracy, precision, recall and f1 of class 1, rounded to 4 digits, overall or per group."""
    actual, guess = F.col(label) == 1, F.col(prediction) == 1
    counts = df.groupBy(*(by or [])).agg(
        _count(actual & guess).alias("tp"), _count(~actual & guess).alias("fp"),
        _count(actual & ~guess).alias("fn"), _count(~actual & ~guess).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *(by or []),
        half_even(_share(tp + tn, tp + fp + fn + tn), 4).alias("accuracy"),
        half_even(_share(tp, tp + fp), 4).alias("precision"),
        half_even(_share(tp, tp + fn), 4).alias("recall"),
        half_even(_f1(tp, fp, fn), 4).alias("f1"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support per class, with macro and weighted averages.

    Rows are reduced to one per (label, prediction) pair first; the rest
    works on that confusion table.
    """
    pairs = df.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"),
                 F.lit(0).cast("bigint").alias("hits")))))
    totals = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])
    hits, guessed, support = F.col("hits"), F.col("guessed"), F.col("support")
    per_class = totals.select(
        F.col("class").cast("string").alias("class"),
        _share(hits, guessed).alias("precision"), _share(hits, support).alias("recall"),
        _share(2 * hits, guessed + support).alias("f1"), "support")
    scores = ["precision", "recall", "f1"]
    macro = per_class.agg(
        F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in scores], F.sum("support").alias("support"))
    weighted = per_class.agg(
        F.lit("weighted avg").alias("class"),
        *[_share(F.sum(F.col(c) * support), F.sum(support)).alias(c) for c in scores],
        F.sum("support").alias("support"))
    out = per_class.unionByName(macro).unionByName(weighted)
    return out.select("class", *[half_even(c, 4).alias(c) for c in scores], "support")


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: list[str] | None = None) -> DataFrame:
    """MAE, RMSE and R2, rounded to 4 digits, overall or per group."""
    y, error = F.col(label).cast("double"), F.col(label) - F.col(prediction)
    sums = df.groupBy(*(by or [])).agg(
        F.avg(F.abs(error)).alias("abs_error"), F.avg(error * error).alias("sq_error"),
        F.var_pop(y).alias("variance"))
    r2 = F.when(F.col("variance") == 0, F.when(F.col("sq_error") == 0, 1.0).otherwise(0.0)).otherwise(
        1 - ratio("sq_error", "variance"))
    return sums.select(
        *(by or []),
        half_even("abs_error", 4).alias("mae"), half_even(F.sqrt("sq_error"), 4).alias("rmse"),
        half_even(r2, 4).alias("r2"))


def long_metrics(wide: DataFrame, names: list[str]) -> DataFrame:
    """One row per (model, metric) from one row per model."""
    return wide.select("model", F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])))


def select_best_model(metrics: DataFrame, metric: str, highest: bool, order: list[str]) -> DataFrame:
    """The model with the best value; of equals the first declared."""
    return model_leaderboard(metrics, metric, highest, order).filter(
        F.col("is_best") & (F.col("metric") == metric)).select("model", "metric", "value")
