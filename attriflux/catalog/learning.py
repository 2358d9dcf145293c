"""Registered queries on model preparation, training, evaluation and explanation."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.catalog.core import KEY, register
from attriflux.catalog.inputs import key_fraction_sql, once, r, sales_features, sql
from attriflux.explain import report as er
from attriflux.explain import shap as sh
from attriflux.functions.columns import half_even, rounded
from attriflux.ml import experiments as ex
from attriflux.ml import metrics as me
from attriflux.ml import models as mo
from attriflux.ml import prepare as pr
from attriflux.ml.node_table import OUTPUTS, NodeEnsemble
from attriflux.operators.reports import model_leaderboard as leaderboard
from attriflux.plans.runs import run_explainer as explainer_run
from attriflux.schemas import ANOMALY_FEATURES, FORECAST_FEATURES
from attriflux.session import fresh_path

# ---- preparation ----

_clean = lambda names: ", ".join(f"{r(f'coalesce({c}, 0)')} AS {c}" for c in names)


@register("clean_features", sql(f"SELECT {', '.join(KEY)}, {_clean(ANOMALY_FEATURES)} FROM features", "features"))
def clean_features(spark, folder):
    return rounded(pr.clean_features(sales_features(spark, folder), ANOMALY_FEATURES).select(*KEY, *ANOMALY_FEATURES))


@register("split_random", sql(f"SELECT {', '.join(KEY)}, split FROM randomsplit", "randomsplit"))
def split_random(spark, folder):
    return pr.split_random(sales_features(spark, folder)).select(*KEY, "split")


@register("split_stratified", sql(f"SELECT {', '.join(KEY)}, is_anomaly, split FROM stratified", "stratified"))
def split_stratified(spark, folder):
    return pr.split_stratified(sales_features(spark, folder), "is_anomaly").select(*KEY, "is_anomaly", "split")


_scaled = ", ".join(
    f"{r(f'(coalesce({c}, 0) - avg(coalesce({c}, 0)) FILTER (split = {chr(39)}train{chr(39)}) OVER ()) / (stddev_pop(coalesce({c}, 0)) FILTER (split = {chr(39)}train{chr(39)}) OVER ())')} AS {c}"
    for c in FORECAST_FEATURES)


@register("standard_scale", sql(f"SELECT {', '.join(KEY)}, split, {_scaled} FROM randomsplit", "randomsplit"))
def standard_scale(spark, folder):
    rows = pr.clean_features(pr.split_random(sales_features(spark, folder)), FORECAST_FEATURES)
    return rounded(pr.standard_scale(rows, FORECAST_FEATURES).select(*KEY, "split", *FORECAST_FEATURES))


@register("split_stats", sql(f"""
SELECT 'anomaly' AS task, split, count(*) AS n_rows, {r('avg(is_anomaly)')} AS mean_value FROM stratified GROUP BY 2
UNION ALL SELECT 'forecast' AS task, split, count(*) AS n_rows, {r('avg(roas)')} AS mean_value FROM randomsplit GROUP BY 2""",
                             "stratified", "randomsplit"))
def split_stats(spark, folder):
    rows = sales_features(spark, folder)
    anomaly = pr.split_stats(pr.split_stratified(rows, "is_anomaly"), "is_anomaly")
    forecast = pr.split_stats(pr.split_random(rows), "roas")
    return rounded(anomaly.select(F.lit("anomaly").alias("task"), "*").unionByName(
        forecast.select(F.lit("forecast").alias("task"), "*")))


# ---- metrics: simple rules and naive forecasts stand in for models, so that SQL can follow ----

RULES = {"roas_drop": "roas_wow < -0.2D", "ctr_drop": "ctr_wow < -0.2D", "spend_jump": "spend_wow > 0.2D"}
NAIVE = {"previous": "roas_prev", "rolling": "roas_rolling3", "rolling_ctr": "roas_prev * ctr / ctr_prev"}


def rule_predictions(spark: SparkSession, folder: str) -> DataFrame:
    rules = F.array(*[F.struct(F.lit(n).alias("model"), F.coalesce(F.expr(e), F.lit(False)).cast("int").alias("prediction"))
                      for n, e in RULES.items()])
    return sales_features(spark, folder).select(F.col("is_anomaly").alias("label"), F.inline(rules))


def naive_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    guesses = F.array(*[F.struct(F.lit(n).alias("model"), F.expr(e).alias("prediction")) for n, e in NAIVE.items()])
    return sales_features(spark, folder).select(F.col("roas").alias("label"), F.inline(guesses))


_rules = " UNION ALL ".join(
    f"SELECT '{n}' AS model, is_anomaly AS y, CASE WHEN {e.replace('D', '::DOUBLE')} THEN 1 ELSE 0 END AS p FROM features"
    for n, e in RULES.items())
_counts = f"""SELECT model, CAST(count(*) FILTER (WHERE y = 1 AND p = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE y = 0 AND p = 1) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (WHERE y = 1 AND p = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (WHERE y = 0 AND p = 0) AS DOUBLE) AS tn FROM ({_rules}) GROUP BY 1"""
_class_metrics = f"""SELECT model, {r('(tp + tn) / (tp + fp + fn + tn)', 4)} AS accuracy,
  {r('coalesce(tp / NULLIF(tp + fp, 0), 0)', 4)} AS precision, {r('coalesce(tp / NULLIF(tp + fn, 0), 0)', 4)} AS recall,
  {r('coalesce(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0)', 4)} AS f1 FROM ({_counts})"""


@register("classification_metrics", sql(_class_metrics, "features"))
def classification_metrics(spark, folder):
    return me.classification_metrics(rule_predictions(spark, folder), by=["model"])


_report = f"""
SELECT CAST(c AS VARCHAR) AS class, coalesce(hits / NULLIF(guessed, 0), 0) AS precision, coalesce(hits / NULLIF(support, 0), 0) AS recall,
  coalesce(2 * hits / NULLIF(guessed + support, 0), 0) AS f1, support
FROM (SELECT c, CAST(count(*) FILTER (WHERE y = c) AS DOUBLE) AS support, CAST(count(*) FILTER (WHERE p = c) AS DOUBLE) AS guessed,
  CAST(count(*) FILTER (WHERE y = c AND p = c) AS DOUBLE) AS hits FROM ({_rules}), (VALUES (0), (1)) AS v(c) WHERE model = 'roas_drop' GROUP BY c)"""
_report_sql = sql(f"""SELECT class, {r('precision', 4)} AS precision, {r('recall', 4)} AS recall, {r('f1', 4)} AS f1, CAST(support AS BIGINT) AS support FROM (
  SELECT * FROM ({_report})
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM ({_report})
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM ({_report}))""", "features")


@register("classification_report", _report_sql)
def classification_report(spark, folder):
    return me.classification_report(rule_predictions(spark, folder).filter("model = 'roas_drop'"))


_naive = " UNION ALL ".join(f"SELECT '{n}' AS model, roas AS y, {e} AS p FROM features" for n, e in NAIVE.items())
_reg_metrics = f"""SELECT model, {r('avg(abs(y - p))', 4)} AS mae, {r('sqrt(avg((y - p) * (y - p)))', 4)} AS rmse,
  {r('1 - avg((y - p) * (y - p)) / var_pop(y)', 4)} AS r2 FROM ({_naive}) GROUP BY model"""


@register("regression_metrics", sql(_reg_metrics, "features"))
def regression_metrics(spark, folder):
    return me.regression_metrics(naive_forecasts(spark, folder), by=["model"])


def _long(names):
    return " UNION ALL ".join(f"SELECT model, '{n}' AS metric, {n} AS value FROM m" for n in names)


@register("model_leaderboard", sql(f"""SELECT l.model, metric, value, k.model_rank = 1 AS is_best, k.model_rank
FROM (WITH m AS ({_class_metrics}) {_long(mo.CLASS_METRICS)}) l
JOIN (SELECT model, row_number() OVER (ORDER BY f1 DESC, model = 'spend_jump', model = 'ctr_drop') AS model_rank FROM ({_class_metrics})) k
ON l.model = k.model""", "features"))
def model_leaderboard(spark, folder):
    wide = me.classification_metrics(rule_predictions(spark, folder), by=["model"])
    out = leaderboard(me.long_metrics(wide, mo.CLASS_METRICS), "f1", True, list(RULES))
    return out.withColumn("model_rank", F.col("model_rank").cast("bigint"))


@register("select_best_model", sql(
    f"SELECT model, 'mae' AS metric, mae AS value FROM ({_reg_metrics}) ORDER BY mae LIMIT 1", "features"))
def select_best_model(spark, folder):
    wide = me.regression_metrics(naive_forecasts(spark, folder), by=["model"])
    return me.select_best_model(me.long_metrics(wide, mo.REGRESSION_METRICS), "mae", False, list(NAIVE))


# ---- training ----

TASKS = {"anomaly": (mo.prepare_anomaly, mo.ANOMALY_TRAINERS), "forecast": (mo.prepare_forecast, mo.FORECAST_TRAINERS)}


def prepared_rows(spark: SparkSession, folder: str, task: str) -> mo.Prepared:
    return once(spark, folder, f"prepared-{task}", lambda: TASKS[task][0](written_features(spark, folder)))


def fitted(spark: SparkSession, folder: str, task: str, name: str) -> mo.Trained:
    return once(spark, folder, f"{task}-{name}", lambda: TASKS[task][1][name](prepared_rows(spark, folder, task)))


def fit_models(spark: SparkSession, folder: str, *models: tuple[str, str]) -> list[mo.Trained]:
    """The models by (task, name), several at once; those that are fitted already are taken as they are."""
    rows = max(prepared_rows(spark, folder, task).rows.count() for task in {task for task, _ in models})
    return [*mo.fit_all({(task, name): partial(fitted, spark, folder, task, name) for task, name in models}, rows).values()]


def _comparison(spark: SparkSession, folder: str, task: str) -> mo.Comparison:
    names = list(TASKS[task][1])
    return once(spark, folder, task, lambda: mo.compare(
        prepared_rows(spark, folder, task), dict(zip(names, fit_models(spark, folder, *[(task, name) for name in names])))))


def both_comparisons(spark: SparkSession, folder: str) -> tuple[mo.Comparison, mo.Comparison]:
    fit_models(spark, folder, *[(task, name) for task, (_, trainers) in TASKS.items() for name in trainers])
    return anomaly_comparison(spark, folder), forecast_comparison(spark, folder)


def anomaly_comparison(spark: SparkSession, folder: str) -> mo.Comparison:
    return _comparison(spark, folder, "anomaly")


def forecast_comparison(spark: SparkSession, folder: str) -> mo.Comparison:
    return _comparison(spark, folder, "forecast")


def written_features(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table as training reads it: written once, then scanned."""
    def write():
        path = fresh_path(spark, "training")
        sales_features(spark, folder).write.parquet(path)
        return path
    return spark.read.parquet(once(spark, folder, "features", write))


def _least_squares_metrics(features: list[str], target: str) -> str:
    """Least squares on the training rows and its errors on the test rows, by orthogonalising one feature after the other."""
    train = "FILTER (WHERE split = 'train') OVER ()"
    tables = [f"""z AS (SELECT split, CAST({target} AS DOUBLE) AS y, {', '.join(f'coalesce({c}, 0)::DOUBLE AS x{j}' for j, c in enumerate(features))}
  FROM randomsplit WHERE {target} IS NOT NULL)"""]
    before = "z"
    for j in range(len(features)):
        tables.append(f"c{j} AS MATERIALIZED (SELECT *, x{j} - avg(x{j}) {train} AS z{j}_0 FROM {before})")
        before = f"c{j}"
        for i in range(j):
            tables.append(f"c{j}_{i} AS MATERIALIZED (SELECT * EXCLUDE (z{j}_{i}), z{j}_{i} - z{i}_{i} * "
                          f"coalesce(sum(z{j}_{i} * z{i}_{i}) {train} / nullif(sum(z{i}_{i} * z{i}_{i}) {train}, 0), 0) AS z{j}_{i + 1} FROM {before})")
            before = f"c{j}_{i}"
    fitted_sql = " + ".join(f"z{j}_{j} * coalesce(sum((y - m) * z{j}_{j}) {train} / nullif(sum(z{j}_{j} * z{j}_{j}) {train}, 0), 0)" for j in range(len(features)))
    tables.append(f"f AS (SELECT split, y, m + {fitted_sql} AS p FROM (SELECT *, avg(y) {train} AS m FROM {before}))")
    return f"""SELECT * FROM (WITH {', '.join(tables)} SELECT 'linear_regression' AS model, {r('avg(abs(y - p))', 4)} AS mae,
  {r('sqrt(avg((y - p) * (y - p)))', 4)} AS rmse, {r('1 - avg((y - p) * (y - p)) / var_pop(y)', 4)} AS r2 FROM f WHERE split = 'test')"""


def _register_training() -> None:
    queries = {
        "train_logistic": ("anomaly", "logistic_regression"),
        "train_random_forest": ("anomaly", "random_forest"),
        "train_gbt_classifier": ("anomaly", "xgboost"),
        "train_isolation_forest": ("anomaly", "isolation_forest"),
        "train_linear": ("forecast", "linear_regression"),
        "train_gbt_regressor": ("forecast", "xgboost"),
        "train_leafwise_regressor": ("forecast", "lightgbm"),
    }
    oracles = {"train_linear": sql(_least_squares_metrics(FORECAST_FEATURES, "roas"), "randomsplit")}
    for query, (task, name) in queries.items():
        def run(spark, folder, task=task, name=name):
            """The model's metrics on the test rows."""
            return mo.evaluate_model(fitted(spark, folder, task, name), prepared_rows(spark, folder, task))
        register(query, oracles.get(query))(run)


_register_training()


@register("train_linear_one_feature", sql(f"""SELECT {r('regr_slope(roas, coalesce(ctr, 0))', 4)} AS slope,
  {r('regr_intercept(roas, coalesce(ctr, 0))', 4)} AS intercept FROM randomsplit WHERE split = 'train'""", "randomsplit"))
def train_linear_one_feature(spark, folder):
    """Least squares of ROAS on one feature, with the scaling taken back out of the coefficients."""
    rows = pr.clean_features(pr.split_random(written_features(spark, folder)), ["ctr"])
    scaler = pr.Scaler.fit(pr.train_part(rows), ["ctr"])
    model = mo.train_linear(mo.Prepared(rows, ["ctr"], "roas", scaler)).model
    slope = float(model.coefficients[0]) / scaler.scales[0]
    out = spark.createDataFrame([(slope, float(model.intercept) - slope * scaler.means[0])], "slope double, intercept double")
    return rounded(out, 4)


@register("train_linear_optimum", "SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', 0::DOUBLE)" for c in ["intercept", *FORECAST_FEATURES]) + ") AS v(feature, slope)")
def train_linear_optimum(spark, folder):
    """Slope of the squared error at the fitted coefficients over all training rows: nothing is left to gain."""
    trained = fitted(spark, folder, "forecast", "linear_regression")
    return _slopes(trained, pr.split_random(written_features(spark, folder)), F.col("prediction") - F.col("roas"), {})


@register("train_logistic_optimum", "SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', 0::DOUBLE)" for c in ["intercept", *ANOMALY_FEATURES]) + ") AS v(feature, slope)")
def train_logistic_optimum(spark, folder):
    """Slope of the penalised log loss at the fitted coefficients over all training rows."""
    trained = fitted(spark, folder, "anomaly", "logistic_regression")
    rows = pr.split_stratified(written_features(spark, folder), "is_anomaly")
    n = pr.train_part(rows).count()
    penalty = {c: float(w) / n for c, w in zip(ANOMALY_FEATURES, trained.model.coefficients)}
    return _slopes(trained, rows, vector_to_array("probability")[1] - F.col("is_anomaly"), penalty)


def _slopes(trained: mo.Trained, rows: DataFrame, error: F.Column, penalty: dict[str, float]) -> DataFrame:
    names = list(trained.scaler.features)
    train = pr.clean_features(pr.train_part(rows), names)
    scored = trained.model.transform(trained.scaler.assemble(train)).withColumn("error", error)
    scaled = trained.scaler.transform(scored)
    means = scaled.agg(F.avg("error").alias("intercept"), *[
        (F.avg(F.col("error") * F.col(c)) + F.lit(penalty.get(c, 0.0))).alias(c) for c in names])
    return means.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), (half_even(c, 3) + F.lit(0.0)).alias("slope"))
        for c in ["intercept", *names]])))


@register("isolation_forest_share", sql("SELECT CAST(ceil(0.3::DOUBLE * count(*)) AS BIGINT) AS flagged, count(*) AS n_rows FROM stratified WHERE split = 'train'", "stratified"))
def isolation_forest_share(spark, folder):
    """Training rows above the threshold: the share that was asked for, exactly."""
    rows = pr.train_part(pr.split_stratified(written_features(spark, folder), "is_anomaly"))
    scored = fitted(spark, folder, "anomaly", "isolation_forest").transform(rows)
    return scored.agg(F.sum("prediction").cast("bigint").alias("flagged"), F.count(F.lit(1)).alias("n_rows"))


@register("predict_anomaly_skipped", sql("""SELECT count(*) FILTER (WHERE roas IS NULL OR roas_wow IS NULL OR roas_rolling3 IS NULL) AS skipped,
  count(*) FILTER (WHERE roas IS NOT NULL AND roas_wow IS NOT NULL AND roas_rolling3 IS NOT NULL) AS predicted FROM allfeatures""", "allfeatures"))
def predict_anomaly_skipped(spark, folder):
    labels = predict_anomaly_best(spark, folder)
    return labels.agg(F.count(F.when(F.col("label") == "skipped", 1)).alias("skipped"),
                      F.count(F.when(F.col("label").isin("ANOMALY", "NORMAL"), 1)).alias("predicted"))


@register("run_anomaly_detection")
def run_anomaly_detection(spark, folder):
    result = anomaly_comparison(spark, folder)
    return leaderboard(result.metrics, "f1", True, mo.ANOMALY_MODELS)


@register("run_forecaster")
def run_forecaster(spark, folder):
    result = forecast_comparison(spark, folder)
    return leaderboard(result.metrics, "mae", False, mo.FORECAST_MODELS)


_copies_agree = sql(f"SELECT {', '.join(KEY)}, true AS agrees FROM features", "features")


def _agreement(spark: SparkSession, folder: str, trained: mo.Trained, copy: mo.Trained, shown: str) -> DataFrame:
    """Every row scored by the model and by its loaded copy."""
    rows = written_features(spark, folder)
    scored = trained.transform(rows).select(*rows.columns, F.col(shown).alias("first"))
    return copy.transform(scored).select(*KEY, F.col("first").eqNullSafe(F.col(shown)).alias("agrees"))


@register("save_model", _copies_agree)
def save_model(spark, folder):
    """The best anomaly model, saved with its metrics and loaded again."""
    result = anomaly_comparison(spark, folder)
    path = fresh_path(spark, "model")
    result.best.save(spark, path, result.metrics)
    return _agreement(spark, folder, result.best, mo.load_model(spark, path), "prediction")


@register("load_model", _copies_agree)
def load_model(spark, folder):
    """The isolation forest, which has its own file format, saved and loaded: compared by score."""
    path = fresh_path(spark, "model")
    trained = fitted(spark, folder, "anomaly", "isolation_forest")
    trained.save(spark, path)
    return _agreement(spark, folder, trained, mo.load_model(spark, path), "score")


# ---- scoring: saved trees with given nodes, so that SQL can walk them too ----

# (tree, node, feature, threshold, left, right, value) on scaled features
ROAS_NODES = [
    (0, 0, "cpc", 0.5, 1, 2, 0.0), (0, 1, "ctr", -0.2, 3, 4, 0.0), (0, 2, "ctr_rolling3", 0.1, 5, 6, 0.0),
    (0, 3, None, 0.0, -1, -1, 0.8), (0, 4, None, 0.0, -1, -1, 1.1), (0, 5, None, 0.0, -1, -1, 1.9), (0, 6, None, 0.0, -1, -1, 3.25),
    (1, 0, "spend_wow", 0.1, 1, 2, 0.0), (1, 1, None, 0.0, -1, -1, 0.12), (1, 2, "cpl", 0.4, 3, 4, 0.0),
    (1, 3, None, 0.0, -1, -1, -0.31), (1, 4, None, 0.0, -1, -1, 0.07)]
ANOMALY_NODES = [
    (0, 0, "roas_wow", -0.3, 1, 2, 0.0), (0, 1, None, 0.0, -1, -1, 0.9), (0, 2, "ctr_wow", -0.25, 3, 4, 0.0),
    (0, 3, None, 0.0, -1, -1, 0.4), (0, 4, None, 0.0, -1, -1, -0.6),
    (1, 0, "roas", 0.0, 1, 2, 0.0), (1, 1, None, 0.0, -1, -1, 0.35), (1, 2, None, 0.0, -1, -1, -0.2)]
GIVEN = {"roas": (ROAS_NODES, FORECAST_FEATURES, "number"), "is_anomaly": (ANOMALY_NODES, ANOMALY_FEATURES, "margin")}


def _given_scaler(features: list[str]) -> pr.Scaler:
    """Means and scales that differ by feature, as given as the nodes are."""
    return pr.Scaler(tuple(features), tuple(0.05 * i for i in range(len(features))), tuple(1.0 + i / 4 for i in range(len(features))))


def given_model(spark: SparkSession, folder: str, target: str) -> mo.Trained:
    """The given trees, saved like any model and loaded again."""
    def save() -> str:
        nodes, features, kind = GIVEN[target]
        rows = tuple((t, n, features.index(f) if f else -1, *rest) for t, n, f, *rest in nodes)
        path = fresh_path(spark, "given")
        mo.Trained("given_trees", NodeEnsemble(rows, kind, OUTPUTS[kind][1]), _given_scaler(features), target).save(spark, path)
        return path
    return mo.load_model(spark, once(spark, folder, f"given-{target}", save))


def _walk_sql(target: str, rows: str) -> str:
    """Every row of ``rows`` with ``total``: the trees as a table of nodes, joined once per level."""
    nodes, features, _ = GIVEN[target]
    scaler = _given_scaler(features)
    values = ", ".join(f"({t}, {n}, {repr(f) if f else 'NULL'}, {c}::DOUBLE, {left}, {right}, {v}::DOUBLE)" for t, n, f, c, left, right, v in nodes)
    value = "CASE feature " + " ".join(
        f"WHEN '{c}' THEN (coalesce({c}, 0)::DOUBLE - {m!r}::DOUBLE) / {s!r}::DOUBLE" for c, m, s in zip(features, scaler.means, scaler.scales)) + " END"
    step = f"CASE WHEN feature IS NULL THEN n.node WHEN {value} <= threshold THEN n.lo ELSE n.hi END"
    tables = [f"nodes AS (SELECT * FROM (VALUES {values}) AS v(tree, node, feature, threshold, lo, hi, val))",
              f"asked AS ({rows})", "w0 AS (SELECT asked.*, t.tree, 0 AS pos FROM asked CROSS JOIN (SELECT DISTINCT tree FROM nodes) t)"]
    for level in (1, 2, 3):
        tables.append(f"w{level} AS (SELECT w.* EXCLUDE (pos), {step} AS pos FROM w{level - 1} w JOIN nodes n ON n.tree = w.tree AND n.node = w.pos)")
    return f"WITH {', '.join(tables)} SELECT w.* EXCLUDE (tree, pos), val FROM w3 w JOIN nodes n ON n.tree = w.tree AND n.node = w.pos"


_key_list = ", ".join(KEY)


@register("predict_roas", sql(f"""SELECT {_key_list}, {', '.join(r(c) + ' AS ' + c for c in FORECAST_FEATURES)}, predicted_roas, 'given_trees' AS model_used
FROM (SELECT {_key_list}, {', '.join(FORECAST_FEATURES)}, {r('sum(val)', 4)} AS predicted_roas
  FROM ({_walk_sql('roas', f"SELECT {_key_list}, {', '.join(FORECAST_FEATURES)} FROM features")}) GROUP BY ALL)""", "features"))
def predict_roas(spark, folder):
    """Requests scored by a saved model."""
    requests = written_features(spark, folder).select(*KEY, *FORECAST_FEATURES)
    return rounded(mo.predict_roas(given_model(spark, folder, "roas"), requests))


@register("predict_anomaly", sql(f"""SELECT {_key_list}, {', '.join(r(c) + ' AS ' + c for c in ANOMALY_FEATURES)},
  CASE WHEN NOT whole THEN 'skipped' WHEN total > 0 THEN 'ANOMALY' ELSE 'NORMAL' END AS label,
  CASE WHEN whole THEN total > 0 END AS is_flagged, 'given_trees' AS model_used
FROM (SELECT {_key_list}, {', '.join(ANOMALY_FEATURES)}, sum(val) AS total,
    roas IS NOT NULL AND roas_wow IS NOT NULL AND roas_rolling3 IS NOT NULL AS whole
  FROM ({_walk_sql('is_anomaly', f"SELECT {_key_list}, {', '.join(ANOMALY_FEATURES)} FROM allfeatures")}) GROUP BY ALL)""", "allfeatures"))
def predict_anomaly(spark, folder):
    """All facts as requests to a saved model, those without a previous period included: they are skipped."""
    requests = sales_features(spark, folder, keep_incomplete=True).select(*KEY, *ANOMALY_FEATURES)
    return rounded(mo.predict_anomaly(given_model(spark, folder, "is_anomaly"), requests))


@register("predict_roas_best")
def predict_roas_best(spark, folder):
    requests = written_features(spark, folder).select(*KEY, *FORECAST_FEATURES)
    return mo.predict_roas(forecast_comparison(spark, folder).best, requests)


@register("predict_anomaly_best")
def predict_anomaly_best(spark, folder):
    requests = sales_features(spark, folder, keep_incomplete=True).select(*KEY, *ANOMALY_FEATURES)
    return mo.predict_anomaly(anomaly_comparison(spark, folder).best, requests)


_runs_sql = """SELECT * FROM (VALUES
  ('anomaly_detection', 'logistic_regression', 'LogisticRegression', 'max_iter=1000', 'accuracy,f1,precision,recall'),
  ('anomaly_detection', 'random_forest', 'RandomForest', 'max_depth=10,n_estimators=100,random_state=42', 'accuracy,f1,precision,recall'),
  ('anomaly_detection', 'xgboost', 'XGBoost',
   'learning_rate=0.1,max_bins=32,max_depth=4,min_rows_per_leaf=1,n_estimators=100,random_state=42', 'accuracy,f1,precision,recall'),
  ('anomaly_detection', 'isolation_forest', 'IsolationForest', 'contamination=0.3,n_estimators=100,random_state=42',
   'accuracy,f1,precision,recall'),
  ('roas_forecasting', 'linear_regression', 'LinearRegression', 'penalty=0.0,solver=normal', 'mae,r2,rmse'),
  ('roas_forecasting', 'xgboost_regressor', 'XGBoostRegressor',
   'learning_rate=0.1,max_bins=32,max_depth=4,min_rows_per_leaf=1,n_estimators=100,random_state=42', 'mae,r2,rmse'),
  ('roas_forecasting', 'lightgbm_regressor', 'LightGBM',
   'learning_rate=0.1,max_bins=255,max_depth=4,min_rows_per_leaf=20,n_estimators=100,random_state=42', 'mae,r2,rmse')
) AS v(experiment, run_name, model_type, params, metrics)"""


@register("log_experiment_run", _runs_sql)
def log_experiment_run(spark, folder):
    """All runs of both experiments, logged and read back; shown are the names of their metrics."""
    path = fresh_path(spark, "runs")
    ex.log_comparisons(*both_comparisons(spark, folder), path)
    pairs = F.transform(F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return ex.read_runs(spark, path).select(
        "experiment", "run_name", "model_type", F.array_join(F.array_sort(pairs), ",").alias("params"),
        F.array_join(F.array_sort(F.map_keys("metrics")), ",").alias("metrics"))


@register("experiment_metrics")
def experiment_metrics(spark, folder):
    path = fresh_path(spark, "runs")
    ex.log_comparisons(*both_comparisons(spark, folder), path)
    return ex.read_runs(spark, path).select("experiment", "run_name", F.explode("metrics").alias("metric", "value"))


# ---- explanation: a linear score with given weights stands in for a model, so that SQL can follow ----

WEIGHTS = [0.5, -0.0001, 0.3, -0.00005, 0.8, 0.6, 0.4, -0.2, 0.1, 0.9]


def linear_shap(spark: SparkSession, folder: str) -> DataFrame:
    rows = pr.clean_features(sales_features(spark, folder), ANOMALY_FEATURES)
    return sh.shap_linear(rows, ANOMALY_FEATURES, WEIGHTS)


_phi = ", ".join(
    f"CAST({w} AS DOUBLE) * ({c} - avg({c}) OVER ()) AS phi_{c}" for c, w in zip(ANOMALY_FEATURES, WEIGHTS))
_phi_rows = f"SELECT *, {_phi} FROM cleaned"
_phi_long = " UNION ALL ".join(
    f"SELECT {', '.join(KEY)}, is_anomaly, {i} AS pos, '{c}' AS feature, phi_{c} AS phi, {c} AS x FROM p"
    for i, c in enumerate(ANOMALY_FEATURES))
_phi_ranked = f"""SELECT *, row_number() OVER (PARTITION BY {', '.join(KEY)} ORDER BY abs(phi) DESC, pos) AS rank
FROM (WITH p AS ({_phi_rows}) {_phi_long})"""


@register("shap_linear", sql(
    f"SELECT {', '.join(KEY)}, " + ", ".join(f"{r(f'phi_{c}')} AS {c}" for c in ANOMALY_FEATURES) + f" FROM ({_phi_rows})", "cleaned"))
def shap_linear(spark, folder):
    values = linear_shap(spark, folder)
    return rounded(values.select(*KEY, *[F.col("shap_values")[i].alias(c) for i, c in enumerate(ANOMALY_FEATURES)]))


@register("feature_importance", sql(
    f"SELECT feature, {r('avg(abs(phi))', 4)} AS importance FROM ({_phi_ranked}) GROUP BY feature", "cleaned"))
def feature_importance(spark, folder):
    return rounded(er.feature_importance(linear_shap(spark, folder), ANOMALY_FEATURES), 4)


@register("top_features", sql(
    f"SELECT {', '.join(KEY)}, rank, feature, {r('phi', 4)} AS shap_value FROM ({_phi_ranked}) WHERE rank <= 3", "cleaned"))
def top_features(spark, folder):
    out = er.top_features(linear_shap(spark, folder), ANOMALY_FEATURES, KEY)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


_shortest = lambda e: f"regexp_replace(printf('%.4f', {r(e, 4)}), '(\\.\\d+?)0+$', '\\1')"
_line = (f"'  ' || rank || '. ' || feature || ' = ' || {_shortest('x')} || ' (SHAP: ' || printf('%+.4f', {r('phi', 4)}) || ') — ' || "
         f"CASE WHEN {r('phi', 4)} > 0 THEN 'pushes TOWARD anomaly' ELSE 'pushes AWAY from anomaly' END")


@register("explain_rows", sql(f"""SELECT {', '.join(KEY)}, 'Row ' || concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in KEY)}) || ':' || chr(10) ||
  '  Top 3 factors:' || chr(10) || string_agg({_line}, chr(10) ORDER BY rank) AS explanation
FROM ({_phi_ranked}) WHERE rank <= 3 GROUP BY {', '.join(KEY)}""", "cleaned"))
def explain_rows(spark, folder):
    values = linear_shap(spark, folder)
    name = F.concat_ws("|", *[F.col(k).cast("string") for k in KEY])
    return values.select(*KEY, er.explain_rows(values, ANOMALY_FEATURES, name).alias("explanation"))


@register("anomaly_explanations", sql(f"""SELECT {', '.join(KEY)}, 'Row ' || concat_ws('|', {', '.join(f'CAST({k} AS VARCHAR)' for k in KEY)}) || ':' || chr(10) ||
  '  Top 3 factors:' || chr(10) || string_agg({_line}, chr(10) ORDER BY rank) AS explanation
FROM ({_phi_ranked}) WHERE rank <= 3 AND (source, campaign_name, c_date) IN (
  SELECT (source, campaign_name, c_date) FROM features WHERE is_anomaly = 1) GROUP BY {', '.join(KEY)}""", "cleaned"))
def anomaly_explanations(spark, folder):
    """The texts of all anomalies, as the run of the explainer writes them."""
    flagged = sales_features(spark, folder).filter(F.col("is_anomaly") == 1).select(*KEY)
    values = linear_shap(spark, folder).join(flagged, KEY)
    name = F.concat_ws("|", *[F.col(k).cast("string") for k in KEY])
    return values.select(*KEY, er.explain_rows(values, ANOMALY_FEATURES, name).alias("explanation"))


@register("anomaly_explain_table", sql(f"""SELECT {', '.join(KEY)}, rank, feature, {r('phi', 4)} AS shap_value,
  CASE WHEN {r('phi', 4)} > 0 THEN 'TOWARD anomaly' ELSE 'AWAY from anomaly' END AS direction
FROM ({_phi_ranked}) WHERE rank <= 3 AND (source, campaign_name, c_date) IN (
  SELECT (source, campaign_name, c_date) FROM features WHERE is_anomaly = 1)""", "cleaned"))
def anomaly_explain_table(spark, folder):
    out = er.anomaly_explain_table(
        sales_features(spark, folder), linear_shap(spark, folder), ANOMALY_FEATURES, KEY)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


_saved_shap_sql = sql(f"""SELECT {', '.join(KEY)}, {r(' + '.join('phi_' + c for c in ANOMALY_FEATURES))} AS total,
  '{','.join(ANOMALY_FEATURES)}' AS names FROM ({_phi_rows})""", "cleaned")


@register("save_shap", _saved_shap_sql)
def save_shap(spark, folder):
    """Saved and read back: each row's SHAP values add up, in feature order, to its score minus the mean score."""
    path = fresh_path(spark, "shap")
    er.save_shap(linear_shap(spark, folder), ANOMALY_FEATURES, KEY, path)
    total = F.aggregate("shap_values", F.lit(0.0), lambda a, b: a + b)
    return rounded(er.load_shap(spark, path).select(*KEY, total.alias("total"), F.array_join("feature_names", ",").alias("names")))


@register("load_shap", sql(f"SELECT {', '.join(KEY)}, {r('phi_ctr_wow')} AS ctr_wow FROM ({_phi_rows})", "cleaned"))
def load_shap(spark, folder):
    path = fresh_path(spark, "shap")
    er.save_shap(linear_shap(spark, folder), ANOMALY_FEATURES, KEY, path)
    values = er.load_shap(spark, path)
    position = F.array_position("feature_names", F.lit("ctr_wow")).cast("int")
    return rounded(values.select(*KEY, F.element_at("shap_values", position).alias("ctr_wow")))


@register("shap_tree")
def shap_tree(spark, folder):
    model = fitted(spark, folder, "forecast", "lightgbm")
    return rounded(sh.explain(model, written_features(spark, folder)).select(
        *KEY, *[F.col("shap_values")[i].alias(c) for i, c in enumerate(FORECAST_FEATURES)]))


@register("shap_tree_adds_up", sql(f"SELECT {', '.join(KEY)}, 0::DOUBLE AS difference FROM features", "features"))
def shap_tree_adds_up(spark, folder):
    """Per row: SHAP values plus the mean output, less the model's own output."""
    trained = fitted(spark, folder, "forecast", "lightgbm")
    base = sh.expected_value(sh.leaf_rules(sh.read_trees(spark, trained.model)))
    explained = sh.explain(trained, written_features(spark, folder)).withColumn(
        "features", array_to_vector(F.array(*trained.scaler.features)))
    total = F.aggregate("shap_values", F.lit(base), lambda a, b: a + b)
    out = trained.model.transform(explained).select(*KEY, half_even(total - F.col("prediction"), 6).alias("difference"))
    return _no_negative_zero(out, ["difference"])


def clipped_score(x: np.ndarray) -> np.ndarray:
    """A model with no closed-form explanation: a bounded score of two interacting features."""
    return np.clip(x[:, 0] * x[:, 3] * 10.0, -1.0, 1.0) + np.maximum(x[:, 4], x[:, 5])


_g = lambda a, b: f"greatest(-1::DOUBLE, least(1::DOUBLE, {a}.ctr * {b}.conversion_rate * 10::DOUBLE))"
_h = lambda a, b: f"greatest({a}.ctr_wow, {b}.spend_wow)"


def _pair(f, first: str, second: str) -> str:
    """Shapley values of a function of two features; the mean is over the background rows."""
    alone, other = f"avg({f('x', 'b')})", f"avg({f('b', 'x')})"
    both, none = f"avg({f('x', 'x')})", f"avg({f('b', 'b')})"
    return (f"{r(f'0.5::DOUBLE * ({alone} - {none} + {both} - {other})')} AS {first}, "
            f"{r(f'0.5::DOUBLE * ({other} - {none} + {both} - {alone})')} AS {second}")


_kernel_sql = sql(f"""SELECT x.source, x.campaign_name, x.c_date, {_pair(_g, 'ctr', 'conversion_rate')}, {_pair(_h, 'ctr_wow', 'spend_wow')},
  0::DOUBLE AS cpc, 0::DOUBLE AS cpl, 0::DOUBLE AS ctr_rolling3
FROM cleaned x, (SELECT * FROM cleaned ORDER BY {key_fraction_sql("'background'", *KEY)} LIMIT {sh.BACKGROUND_ROWS}) b
GROUP BY 1, 2, 3""", "cleaned")


@register("shap_kernel", _kernel_sql)
def shap_kernel(spark, folder):
    rows = pr.clean_features(sales_features(spark, folder), FORECAST_FEATURES)
    out = sh.shap_kernel(rows, FORECAST_FEATURES, clipped_score).select(
        *KEY, *[F.col("shap_values")[i].alias(c) for i, c in enumerate(FORECAST_FEATURES)])
    return _no_negative_zero(rounded(out), FORECAST_FEATURES)


def _no_negative_zero(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c) + F.lit(0.0) for c in names})


@register("explain_dispatch")
def explain_dispatch(spark, folder):
    """Importances of models of three kinds, each explained by the method that suits it."""
    rows = written_features(spark, folder)
    models = fit_models(spark, folder, ("anomaly", "logistic_regression"), ("anomaly", "xgboost"), ("forecast", "linear_regression"))
    out = None
    for model in models:
        part = er.feature_importance(sh.explain(model, rows), list(model.scaler.features)).select(
            F.lit(model.name).alias("model"), "feature", half_even("importance", 4).alias("importance"))
        out = part if out is None else out.unionByName(part)
    return out


@register("run_explainer")
def run_explainer(spark, folder):
    """Importances of both models, and in how many of the anomalies' explanations a feature is named."""
    anomaly, forecast = both_comparisons(spark, folder)
    result = explainer_run(written_features(spark, folder), anomaly.best, forecast.best, fresh_path(spark, "explained"))
    anomaly = result["anomaly"].join(F.broadcast(result["named"]), "feature")           # a row per feature
    return anomaly.select(F.lit("anomaly").alias("task"), "feature", "importance", "explained").unionByName(
        result["forecaster"].select(F.lit("forecaster").alias("task"), "*", F.lit(None).cast("bigint").alias("explained")))
