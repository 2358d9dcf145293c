"""Training, saving and scoring of the anomaly classifiers and ROAS regressors."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
    RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.regression import (
    GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.functions.columns import half_even
from attriflux.ml.isolation_forest import IsolationForest
from attriflux.ml.metrics import classification_metrics, long_metrics, regression_metrics, select_best_model
from attriflux.ml.node_table import NodeEnsemble
from attriflux.ml.prepare import (
    SEED, Scaler, business_key, clean_features, split_random, split_stratified, test_part, train_part)
from attriflux.schemas import ANOMALY_FEATURES, FORECAST_FEATURES
from attriflux.session import fresh_path, use_checkpoints

# Model names in the order in which they are declared.
ANOMALY_MODELS = ["logistic_regression", "random_forest", "xgboost", "isolation_forest"]
FORECAST_MODELS = ["linear_regression", "xgboost", "lightgbm"]
CLASS_METRICS = ["accuracy", "precision", "recall", "f1"]
REGRESSION_METRICS = ["mae", "rmse", "r2"]

ROWS_PER_TASK = 100_000
MOST_ROWS = 1_000_000
AT_ONCE_ROWS = 4_000_000        # rows of all models that are trained at once
ALONE = {"random_forest"}       # keeps a number per row and tree in memory and has few, long jobs
BOOSTING = {"maxIter": 100, "maxDepth": 4, "stepSize": 0.1, "seed": SEED}

MODEL_CLASSES = {c.__name__: c for c in (
    LogisticRegressionModel, RandomForestClassificationModel, GBTClassificationModel,
    LinearRegressionModel, GBTRegressionModel, IsolationForest, NodeEnsemble)}


@dataclass(frozen=True)
class Trained:
    """A fitted model with the scaler of its inputs."""

    name: str
    model: Any
    scaler: Scaler
    target: str

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` to raw feature rows."""
        df = clean_features(df, list(self.scaler.features))
        if isinstance(self.model, IsolationForest):
            scaled = df.select(F.struct("*").alias("_row"), *self.scaler.columns())
            return self.model.transform(scaled).select("_row.*", "score", "prediction")
        if isinstance(self.model, NodeEnsemble):
            return self.model.transform(df, self.scaler.columns()).drop("score")
        return self.model.transform(self.scaler.assemble(df)).drop("features")

    def save(self, spark: SparkSession, path: str, metrics: DataFrame | None = None) -> None:
        if isinstance(self.model, (IsolationForest, NodeEnsemble)):
            self.model.save(spark, f"{path}/model")
        else:
            self.model.write().overwrite().save(f"{path}/model")
        about = json.dumps({
            "name": self.name, "class": type(self.model).__name__, "target": self.target,
            "features": self.scaler.features, "means": self.scaler.means, "scales": self.scaler.scales})
        spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(f"{path}/about")
        if metrics is not None:
            metrics.write.mode("overwrite").parquet(f"{path}/metrics")


def load_model(spark: SparkSession, path: str) -> Trained:
    about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
    cls = MODEL_CLASSES[about["class"]]
    model = cls.load(spark, f"{path}/model") if cls in (IsolationForest, NodeEnsemble) else cls.load(f"{path}/model")
    scaler = Scaler(tuple(about["features"]), tuple(about["means"]), tuple(about["scales"]))
    return Trained(about["name"], model, scaler, about["target"])


@dataclass(frozen=True)
class Prepared:
    """Cleaned rows with their split, and the scaler fitted on the training rows."""

    rows: DataFrame
    features: list[str]
    target: str
    scaler: Scaler

    @property
    def train(self) -> DataFrame:
        return train_part(self.rows)

    @property
    def test(self) -> DataFrame:
        return test_part(self.rows)

    def vectors(self, part: DataFrame) -> DataFrame:
        return self.scaler.assemble(part).select("features", F.col(self.target).cast("double").alias("label"))


def _prepare(df: DataFrame, features: list[str], target: str, stratified: bool) -> Prepared:
    rows = df.filter(F.col(target).isNotNull())
    rows = split_stratified(rows, target) if stratified else split_random(rows)
    # the target may be cleaned with the features (roas is one of the anomaly features)
    path = fresh_path(df.sparkSession, "prepared")
    clean_features(rows, features).write.parquet(path)      # every model reads them: the split is made once
    rows = df.sparkSession.read.schema(rows.schema).parquet(path)
    return Prepared(rows, features, target, Scaler.fit(train_part(rows), features))


def prepare_anomaly(df: DataFrame) -> Prepared:
    return _prepare(df, ANOMALY_FEATURES, "is_anomaly", stratified=True)


def prepare_forecast(df: DataFrame) -> Prepared:
    return _prepare(df, FORECAST_FEATURES, "roas", stratified=False)


def even_tasks(rows: int, cores: int) -> int:
    """Tasks of a training: sized by rows, not by the shuffle's default, as boosting runs hundreds of short jobs.

    Every task costs the same again in each round (starting it, and estimating the size of what it keeps), so
    there are no more of them than cores, unless they would have more than ``MOST_ROWS`` rows.
    """
    return max(1, -(-rows // MOST_ROWS), min(-(-rows // ROWS_PER_TASK), cores))


def _fit(prepared: Prepared, name: str, estimator: Any) -> Trained:
    use_checkpoints(prepared.rows.sparkSession)   # boosting cuts its lineage every tenth tree
    tasks = even_tasks(prepared.train.count(), prepared.rows.sparkSession.sparkContext.defaultParallelism)
    # trees keep their own binned rows in memory; these are read a few times only
    even = prepared.vectors(prepared.train).repartition(tasks).persist(StorageLevel.DISK_ONLY)
    try:
        model = estimator.fit(even)
    finally:
        even.unpersist()
    return Trained(name, model, prepared.scaler, prepared.target)


def train_logistic(prepared: Prepared) -> Trained:
    """L2 with C = 1. Spark divides the loss by the number of rows, hence the penalty 1/n."""
    n = prepared.train.count()
    return _fit(prepared, "logistic_regression", LogisticRegression(
        regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False, maxIter=1000))


def train_random_forest(prepared: Prepared, max_depth: int = 10) -> Trained:
    return _fit(prepared, "random_forest", RandomForestClassifier(
        numTrees=100, featureSubsetStrategy="sqrt", maxDepth=max_depth, seed=SEED))


def train_gbt_classifier(prepared: Prepared) -> Trained:
    return _fit(prepared, "xgboost", GBTClassifier(**BOOSTING, checkpointInterval=10))


def train_isolation_forest(prepared: Prepared) -> Trained:
    """Unsupervised: the label is not looked at."""
    key = business_key(prepared.rows)
    scaled = prepared.scaler.transform(prepared.train)
    return Trained("isolation_forest", IsolationForest.fit(scaled, prepared.features, key),
                   prepared.scaler, prepared.target)


def train_linear(prepared: Prepared) -> Trained:
    """Ordinary least squares by the normal equations."""
    return _fit(prepared, "linear_regression", LinearRegression(solver="normal", regParam=0.0))


def train_gbt_regressor(prepared: Prepared) -> Trained:
    return _fit(prepared, "xgboost", GBTRegressor(**BOOSTING, checkpointInterval=10))


def train_leafwise_regressor(prepared: Prepared) -> Trained:
    """Leaf-wise boosting with 31 leaves at most. At depth 4 (16 leaves) the leaf limit never
    binds, so it is level-wise boosting with finer bins and at least 20 rows per leaf."""
    return _fit(prepared, "lightgbm", GBTRegressor(
        **BOOSTING, checkpointInterval=10, maxBins=255, minInstancesPerNode=20))


ANOMALY_TRAINERS = dict(zip(ANOMALY_MODELS, (
    train_logistic, train_random_forest, train_gbt_classifier, train_isolation_forest)))
FORECAST_TRAINERS = dict(zip(FORECAST_MODELS, (
    train_linear, train_gbt_regressor, train_leafwise_regressor)))


def evaluate_model(trained: Trained, prepared: Prepared) -> DataFrame:
    """One row of metrics on the test rows."""
    scored = trained.transform(prepared.test.withColumn("label", F.col(prepared.target).cast("double")))
    metrics = classification_metrics if prepared.target == "is_anomaly" else regression_metrics
    return metrics(scored).select(F.lit(trained.name).alias("model"), "*")


@dataclass(frozen=True)
class Comparison:
    """All models of one task with their metrics and the best of them."""

    models: dict[str, Trained]
    metrics: DataFrame
    best: Trained


def compare(prepared: Prepared, models: dict[str, Trained]) -> Comparison:
    """Metrics of the models on the test rows, and the best: highest f1, or lowest mean absolute error.

    Of equals the first wins. Metrics are a few numbers per model, kept as a
    small local table, so that the models are scored once.
    """
    anomaly = prepared.target == "is_anomaly"
    names = CLASS_METRICS if anomaly else REGRESSION_METRICS
    rows = [evaluate_model(m, prepared).first().asDict() for m in models.values()]
    wide = prepared.rows.sparkSession.createDataFrame(rows, "model string, " + ", ".join(f"{n} double" for n in names))
    metrics = long_metrics(wide, names)
    best = select_best_model(metrics, "f1" if anomaly else "mae", anomaly, list(models)).first()["model"]
    return Comparison(models, metrics, models[best])


def fit_all(fits: dict[tuple[str, str], Callable[[], Trained]], rows: int) -> dict[tuple[str, str], Trained]:
    """The fits by (task, model): those of ``ALONE`` one after the other, then the others, several at once.

    Boosting runs hundreds of short jobs, one waiting for the other; several models at once keep
    all cores busy meanwhile. They hold their rows in memory, so together they get ``AT_ONCE_ROWS``; tables with
    more keep the cores busy alone. What each fit does is the same.
    """
    made = {key: fit() for key, fit in fits.items() if key[1] in ALONE}
    rest = {key: fit for key, fit in fits.items() if key not in made}
    with ThreadPoolExecutor(max(1, min(len(rest), AT_ONCE_ROWS // max(1, rows)))) as threads:
        running = {key: threads.submit(inheritable_thread_target(fit)) for key, fit in rest.items()}
        made |= {key: run.result() for key, run in running.items()}
    return {key: made[key] for key in fits}


def _train_and_compare(prepared: Prepared, trainers: dict) -> Comparison:
    fits = {(prepared.target, name): partial(train, prepared) for name, train in trainers.items()}
    made = fit_all(fits, prepared.rows.count())
    return compare(prepared, {name: trained for (_, name), trained in made.items()})


def compare_anomaly_models(df: DataFrame) -> Comparison:
    """Train and compare all four anomaly models."""
    return _train_and_compare(prepare_anomaly(df), ANOMALY_TRAINERS)


def compare_forecast_models(df: DataFrame) -> Comparison:
    """Train and compare all three ROAS models."""
    return _train_and_compare(prepare_forecast(df), FORECAST_TRAINERS)


def predict_roas(trained: Trained, requests: DataFrame) -> DataFrame:
    """Add predicted_roas (4 digits) and the model's name; the request's own columns stay as they came."""
    scored = trained.transform(requests.withColumn("_request", F.struct("*")))
    return scored.select(
        *[F.col("_request")[c].alias(c) for c in requests.columns], half_even("prediction", 4).alias("predicted_roas"), F.lit(trained.name).alias("model_used"))


def predict_anomaly(trained: Trained, requests: DataFrame) -> DataFrame:
    """Add label ANOMALY or NORMAL; ``skipped`` where roas, roas_wow or roas_rolling3 is missing."""
    complete = F.col("roas").isNotNull() & F.col("roas_wow").isNotNull() & F.col("roas_rolling3").isNotNull()
    scored = trained.transform(requests.withColumn("_complete", complete).withColumn("_request", F.struct(*requests.columns)))
    label = (F.when(~F.col("_complete"), "skipped").when(F.col("prediction") == 1, "ANOMALY").otherwise("NORMAL"))
    return scored.select(
        *[F.col("_request")[c].alias(c) for c in requests.columns], label.alias("label"),
        F.when(F.col("_complete"), F.col("prediction") == 1).alias("is_flagged"),
        F.lit(trained.name).alias("model_used"))
