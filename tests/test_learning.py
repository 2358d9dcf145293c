from itertools import combinations
from math import factorial
from time import perf_counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from attriflux.catalog import learning as le
from attriflux.explain import report as er
from attriflux.explain import shap as sh
from attriflux.ml import experiments as ex
from attriflux.ml import isolation_forest as iso
from attriflux.ml import metrics as me
from attriflux.ml import models as mo
from attriflux.ml import prepare as pr
from attriflux.schemas import ANOMALY_FEATURES, FORECAST_FEATURES


@pytest.fixture(scope="module")
def rows(spark, folder):
    return le.written_features(spark, folder)


@pytest.fixture(scope="module")
def anomaly(spark, folder):
    return le.anomaly_comparison(spark, folder)


@pytest.fixture(scope="module")
def forecast(spark, folder):
    return le.forecast_comparison(spark, folder)


def test_split_keeps_class_ratio(rows):
    out = pr.split_stratified(rows, "is_anomaly")
    stats = {r.split: r for r in pr.split_stats(out, "is_anomaly").collect()}
    assert abs(stats["train"].mean_value - stats["test"].mean_value) < 0.01
    assert stats["test"].n_rows == pytest.approx(0.2 * rows.count(), abs=2)


def test_splits_do_not_depend_on_partitions(rows):
    for split in (pr.split_random, lambda d: pr.split_stratified(d, "is_anomaly")):
        a = split(rows).select("campaign_name", "c_date", "split")
        b = split(rows.repartition(5)).select("campaign_name", "c_date", "split")
        assert a.exceptAll(b).count() == 0


def test_clean_features_leaves_no_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (2.0,)], "x double")
    assert [r.x for r in pr.clean_features(df, ["x"]).collect()] == [0.0, 0.0, 0.0, 2.0]


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaler = pr.Scaler.fit(df, ["a", "b"])
    assert scaler.scales == (pytest.approx(np.std([1, 2, 3])), 1.0)
    assert [r.b for r in scaler.transform(df).collect()] == [0.0] * 3


def test_no_leakage():
    assert not any("roas" in f for f in FORECAST_FEATURES)


def test_metrics_in_range(anomaly, forecast):
    assert {r.model for r in anomaly.metrics.collect()} == set(mo.ANOMALY_MODELS)
    assert all(0 <= r.value <= 1 for r in anomaly.metrics.collect())
    found = {(r.model, r.metric): r.value for r in forecast.metrics.collect()}
    for m in mo.FORECAST_MODELS:
        assert 0 <= found[m, "mae"] <= found[m, "rmse"] and np.isfinite(found[m, "r2"])


def test_best_models(anomaly, forecast):
    f1 = {r.model: r.value for r in anomaly.metrics.filter("metric = 'f1'").collect()}
    assert f1[anomaly.best.name] == max(f1.values())
    mae = {r.model: r.value for r in forecast.metrics.filter("metric = 'mae'").collect()}
    assert mae[forecast.best.name] == min(mae.values())


def test_saved_model_predicts_the_same(spark, rows, anomaly, tmp_path):
    for name in ("logistic_regression", "isolation_forest"):
        model = anomaly.models[name]
        model.save(spark, str(tmp_path / name), anomaly.metrics)
        loaded = mo.load_model(spark, str(tmp_path / name))
        a = model.transform(rows).select("campaign_name", "c_date", "prediction")
        b = loaded.transform(rows).select("campaign_name", "c_date", "prediction")
        assert loaded.name == name and a.exceptAll(b).count() == 0


def test_prediction_is_skipped_without_roas(anomaly, rows):
    requests = rows.limit(4).withColumn("roas", F.when(F.col("c_date") == rows.agg(F.min("c_date")).first()[0], None).otherwise(F.col("roas")))
    some = requests.withColumn("roas_wow", F.lit(None).cast("double"))
    assert {r.label for r in mo.predict_anomaly(anomaly.best, some).collect()} == {"skipped"}
    assert {r.label for r in mo.predict_anomaly(anomaly.best, rows).collect()} <= {"ANOMALY", "NORMAL"}


def test_metric_formulas(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (1, 1)], "label int, prediction int")
    row = me.classification_metrics(df).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.6, 0.6667, 0.6667, 0.6667)
    none = me.classification_metrics(spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)
    reg = me.regression_metrics(spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "label double, prediction double")).first()
    assert (reg.mae, reg.rmse, reg.r2) == (0.5, round(np.sqrt(1.25 / 3), 4), 0.375)
    report = {r["class"]: r for r in me.classification_report(df).collect()}
    assert report["0"].support == 2 and report["1"].support == 3 and report["macro avg"].support == 5


def test_isolation_forest_finds_outliers(spark):
    rng = np.random.default_rng(0)
    usual = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    far = [(1000 + i, 12.0 + i, -15.0 - i) for i in range(5)]
    df = spark.createDataFrame(usual + far, "id long, a double, b double")
    forest = iso.IsolationForest.fit(df, ["a", "b"], ["id"], trees=40, contamination=0.05)
    top = forest.score(df).orderBy(F.desc("score")).limit(5).collect()
    assert {r.id for r in top} == {1000, 1001, 1002, 1003, 1004}
    flagged = forest.transform(df).filter("prediction = 1").count()
    assert flagged == pytest.approx(0.05 * 405, abs=3)
    assert all(t["feature"].size <= 2 * iso.SAMPLE_ROWS for t in forest.trees)
    again = iso.IsolationForest.fit(df.repartition(5), ["a", "b"], ["id"], trees=40, contamination=0.05)
    assert again.threshold == pytest.approx(forest.threshold)


# ---- SHAP ----

def brute_tree_shap(nodes, row):
    """Expectation over unknown features by cover, summed over all coalitions."""
    def value(i, known):
        n = nodes[i]
        if n["left"] < 0:
            return n["value"]
        if n["feature"] in known:
            return value(n["left"] if row[n["feature"]] <= n["threshold"] else n["right"], known)
        return sum(nodes[c]["cover"] * value(c, known) for c in (n["left"], n["right"])) / n["cover"]
    k = len(row)
    phi = np.zeros(k)
    for i in range(k):
        others = [j for j in range(k) if j != i]
        for s in range(k):
            for sub in combinations(others, s):
                w = factorial(s) * factorial(k - s - 1) / factorial(k)
                phi[i] += w * (value(0, {*sub, i}) - value(0, set(sub)))
    return phi


def test_tree_shap_equals_all_coalitions():
    def node(feature=0, threshold=0.0, left=-1, right=-1, cover=1, value=0.0):
        return dict(feature=feature, threshold=threshold, left=left, right=right, cover=cover, value=value)
    nodes = [node(0, 0.0, 1, 2, 10), node(1, 1.0, 3, 4, 6), node(0, 2.0, 5, 6, 4),
             node(cover=2, value=1.0), node(2, -1.0, 7, 8, 4), node(cover=3, value=-2.0), node(cover=1, value=5.0),
             node(cover=1, value=3.0), node(cover=3, value=0.5)]
    leaves = sh.leaf_rules([(1.0, nodes)])
    x = np.random.default_rng(1).normal(size=(20, 3)) * 2
    assert np.allclose(sh.tree_shap_values(sh.leaf_arrays(leaves, x.shape[1]), x), [brute_tree_shap(nodes, r) for r in x])


def random_tree(draws, depth, cuts):
    """Nodes of a tree with splits at the given thresholds, covers of 1 or more."""
    nodes = []

    def grow(depth, cover):
        at, f = len(nodes), int(draws.integers(len(cuts)))
        nodes.append(dict(value=draws.normal(), cover=cover, left=-1, right=-1, feature=f, threshold=float(draws.choice(cuts[f]))))
        if depth and cover > 1:
            part = int(draws.integers(1, cover))
            nodes[at].update(left=grow(depth - 1, part), right=grow(depth - 1, cover - part))
        return at

    grow(depth, 500)
    return nodes


def test_tree_shap_of_many_trees_on_their_thresholds():
    """Rows that lie on thresholds, trees without a split, and a deep one whose paths visit features again and again."""
    draws = np.random.default_rng(4)
    cuts = draws.normal(size=(5, 6))
    trees = [random_tree(draws, depth, cuts) for depth in (0, 1, 4, 4, 4, 9)]
    x = draws.normal(size=(30, 5))
    x[:6] = cuts.T
    leaves = sh.leaf_arrays(sh.leaf_rules([(0.5, t) for t in trees]), 5)
    phi = sh.tree_shap_values(leaves, x)
    assert np.allclose(phi, [0.5 * sum(brute_tree_shap(t, r) for t in trees) for r in x])
    assert np.allclose(sh.tree_shap_values(leaves, x[:0]).shape, (0, 5))


def test_tree_shap_looks_rows_up():
    """What rows cost besides the tables: 20,000 rows of 1,600 leaves once took 4 s and more."""
    draws = np.random.default_rng(6)
    cuts = draws.normal(size=(10, 31))
    leaves = sh.leaf_arrays(sh.leaf_rules([(0.1, random_tree(draws, 4, cuts)) for _ in range(100)]), 10)
    x = draws.normal(size=(20_000, 10))
    tables = sh.LeafTables(*sh.leaf_ranks(leaves))
    tables.values(x[:1])
    assert tables.kept is not None and len(tables.kept) < 400
    started = perf_counter()
    tables.values(x)
    assert perf_counter() - started < 2


def test_kernel_shap_of_a_linear_function():
    w = np.array([1.0, -2.0, 0.5])
    x, background = np.random.default_rng(2).normal(size=(6, 3)), np.random.default_rng(3).normal(size=(20, 3))
    phi = sh.kernel_shap_values(lambda m: m @ w + 4.0, background, x)
    assert np.allclose(phi, w * (x - background.mean(axis=0)))


@pytest.mark.parametrize("name", ["logistic_regression", "random_forest", "xgboost"])
def test_shap_adds_up_for_classifiers(spark, rows, anomaly, name):
    trained = anomaly.models[name]
    total = F.aggregate("shap_values", F.lit(0.0), lambda a, b: a + b)
    explained = sh.explain(trained, rows).select("campaign_name", "c_date", total.alias("s"))
    scored = trained.transform(rows).select("campaign_name", "c_date", "rawPrediction", "probability").join(
        explained, ["campaign_name", "c_date"]).collect()
    output = {"logistic_regression": lambda r: r.rawPrediction[1], "random_forest": lambda r: r.probability[1],
              "xgboost": lambda r: 2 * r.rawPrediction[1]}[name]
    base = [output(r) - r.s for r in scored]
    assert len(base) == rows.count() and np.ptp(base) < 1e-8


def test_shap_adds_up_for_regressors(rows, forecast):
    total = F.aggregate("shap_values", F.lit(0.0), lambda a, b: a + b)
    for trained in forecast.models.values():
        explained = sh.explain(trained, rows).select("campaign_name", "c_date", total.alias("s"))
        scored = trained.transform(rows).join(explained, ["campaign_name", "c_date"]).collect()
        assert np.ptp([r.prediction - r.s for r in scored]) < 1e-8


def test_isolation_forest_is_explained_by_coalitions(rows, anomaly):
    few = rows.orderBy("campaign_name", "c_date").limit(2)
    values = sh.explain(anomaly.models["isolation_forest"], few).collect()
    assert all(len(r.shap_values) == len(ANOMALY_FEATURES) and np.isfinite(r.shap_values).all() for r in values)


def test_importance_and_ranks(spark):
    df = spark.createDataFrame([(1, 0.5, 2.0, 0.0001, [0.1, -0.7, 0.02]), (2, 1.0, 3.0, -4.0, [0.3, 0.1, -0.02])],
                               "id int, a double, b double, c double, shap_values array<double>")
    out = er.feature_importance(df, ["a", "b", "c"]).collect()
    assert [r.feature for r in out] == ["b", "a", "c"] and out[0].importance == pytest.approx(0.4)
    top = er.top_features(df, ["a", "b", "c"], ["id"], top_n=2).filter("id = 1").orderBy("rank").collect()
    assert [(r.rank, r.feature, r.shap_value) for r in top] == [(1, "b", -0.7), (2, "a", 0.1)]
    text = df.select(er.explain_rows(df, ["a", "b", "c"], F.col("id").cast("string")).alias("t")).first().t
    assert text.split("\n") == [
        "Row 1:", "  Top 3 factors:", "  1. b = 2.0 (SHAP: -0.7000) — pushes AWAY from anomaly",
        "  2. a = 0.5 (SHAP: +0.1000) — pushes TOWARD anomaly", "  3. c = 0.0001 (SHAP: +0.0200) — pushes TOWARD anomaly"]


@pytest.mark.parametrize("name", ["shap_kernel", "explain_dispatch", "run_explainer", "log_experiment_run",
                                  "predict_roas", "predict_anomaly", "run_anomaly_detection", "run_forecaster"])
def test_registered_without_sql(spark, folder, name):
    from __spark_entry__ import queries
    assert queries()[name](spark, folder).count() > 0


def test_logged_runs_name_the_model_and_its_parameters(spark, forecast, rows, tmp_path):
    path = str(tmp_path / "runs")
    ex.log_experiment_run(ex.FORECAST_EXPERIMENT, forecast, path)
    runs = {r.run_name: r for r in ex.read_runs(spark, path).collect()}
    assert set(runs) == {"linear_regression", "xgboost_regressor", "lightgbm_regressor"}
    assert runs["lightgbm_regressor"].params["min_rows_per_leaf"] == "20"
    for r, trained in zip((runs[n] for n in ("linear_regression", "xgboost_regressor", "lightgbm_regressor")),
                          (forecast.models[n] for n in ("linear_regression", "xgboost", "lightgbm"))):
        metric = forecast.metrics.filter((F.col("model") == trained.name) & (F.col("metric") == "mae")).first()["value"]
        assert r.metrics["mae"] == metric
        again = mo.load_model(spark, r.model_path).transform(rows).agg(F.sum("prediction")).first()[0]
        assert again == pytest.approx(trained.transform(rows).agg(F.sum("prediction")).first()[0])


def test_tree_samples_are_the_first_rows_of_each_order(spark):
    """Against a sort of all rows, for any division into tasks; a row that fills a third of the table stays bounded."""
    rows = [(int(k), [float(k % 97), float(i)]) for i, k in enumerate(np.random.default_rng(5).integers(-2**62, 2**62, 9000))]
    rows += [(4711, [1.0, 2.0])] * 4500
    samples = []
    for parts in (1, 13):
        df = spark.createDataFrame(rows, "key long, x array<double>").repartition(parts)
        out = iso.tree_samples(df, 7, 42, 64).collect()
        assert len(out) <= 7 * 64 * parts
        found = {}
        for r in out:
            found.setdefault(r.tree, []).append((r["at"], tuple(r.x)))
        samples.append({t: sorted(v)[:64] for t, v in found.items()})
    keys = np.array([k for k, _ in rows])
    for tree in range(7):
        at = iso._mixed(keys, tree, 42)
        want = sorted((int(a), tuple(x)) for a, (_, x) in zip(at, rows))[:64]
        assert samples[0][tree] == samples[1][tree] == want


def test_flagged_share_is_exact(spark):
    draws = np.random.default_rng(9)
    rows = [(i, *map(float, v)) for i, v in enumerate(draws.normal(size=(1237, 3)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    for share in (0.3, 0.01, 0.5):
        forest = iso.IsolationForest.fit(df, ["a", "b", "c"], ["id"], trees=30, contamination=share)
        assert forest.transform(df).filter("prediction = 1").count() == int(np.ceil(share * 1237))
    with pytest.raises(ValueError, match="no rows"):
        iso.IsolationForest.fit(df.limit(0), ["a", "b", "c"], ["id"])


def test_sampled_coalitions_come_near_all_of_them():
    """Ten features: mean error below 1 % of the spread of the values, largest below 5 %, with 4,096 draws of 1,022; also with 400."""
    draws = np.random.default_rng(3)
    background, rows = draws.normal(size=(20, 10)), draws.normal(size=(6, 10))
    mixing = draws.normal(size=(10, 10)) / 3
    predict = lambda x: np.tanh(x @ mixing).sum(axis=1) + x[:, 0] * x[:, 1] + np.maximum(x[:, 2], x[:, 3])
    exact = sh.kernel_shap_values(predict, background, rows)
    spread = np.abs(exact).max()
    assert np.abs(sh.kernel_shap_values(predict, background, rows, sh.sampled_coalitions(10, 4096)) - exact).max() < 1e-9 * spread
    error = np.abs(sh.kernel_shap_values(predict, background, rows, sh.sampled_coalitions(10, 400)) - exact)
    assert error.mean() < 0.01 * spread and error.max() < 0.05 * spread


def test_kernel_for_forty_features(spark):
    draws = np.random.default_rng(4)
    names = [f"f{i}" for i in range(40)]
    values, weights = draws.normal(size=(30, 40)), draws.normal(size=40)
    df = spark.createDataFrame([tuple(map(float, v)) for v in values], ", ".join(f"{n} double" for n in names))
    background = values[:5]
    predict = lambda x: x @ weights + 0.1 * x[:, 0] * x[:, 1]
    rows = sh.shap_kernel(df, names, predict, background).collect()
    for r in rows:
        x, phi = np.array([r[n] for n in names]), np.array(r.shap_values)
        assert phi.sum() == pytest.approx(predict(x[None])[0] - predict(background).mean())
        assert np.allclose(phi[2:], weights[2:] * (x - background.mean(axis=0))[2:], atol=0.02)


def test_every_step_of_the_explainer_counts(spark, rows, forecast, anomaly, tmp_path):
    """Importances come from the saved SHAP values, and the explanations are written and counted."""
    from attriflux.plans.runs import run_explainer
    path = str(tmp_path / "explained")
    out = run_explainer(rows, anomaly.models["logistic_regression"], forecast.models["linear_regression"], path)
    for task in ("anomaly", "forecaster"):
        assert all(f"/{task}_shap/" in f for f in out[task].inputFiles())
    texts = [r.explanation for r in spark.read.parquet(f"{path}/explanations").collect()]
    assert len(texts) == rows.filter("is_anomaly = 1").count() > 0
    named = {r.feature: r.explained for r in out["named"].collect()}
    assert named == {c: sum(any(line.split(". ")[1].startswith(f"{c} =") for line in t.split("\n")[2:]) for t in texts)
                     for c in ANOMALY_FEATURES}
    assert sum(named.values()) == 3 * len(texts)


def test_run_explainer_shows_its_explanations(spark, folder):
    got = le.run_explainer(spark, folder).collect()
    assert sum(r.explained for r in got if r.task == "anomaly") == 3 * le.written_features(spark, folder).filter("is_anomaly = 1").count()
    assert {r.feature for r in got if r.task == "forecaster" and r.explained is None} == set(FORECAST_FEATURES)


def test_rows_are_split_once_for_all_models(rows):
    """Every training once made the split again: a hash of all keys, four passes and a join."""
    for prepare in (mo.prepare_anomaly, mo.prepare_forecast):
        prepared = prepare(rows)
        plan = prepared.train._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "xxhash64" not in plan and all("/prepared-" in f for f in prepared.rows.inputFiles())
        assert prepared.train.count() + prepared.test.count() == rows.filter(F.col(prepared.target).isNotNull()).count()


def test_tasks_of_a_training():
    """Each task costs the same again in every round, so there are no more than cores, and no task without a bound."""
    assert [mo.even_tasks(n, 8) for n in (0, 1, 100_000, 100_001, 650_000, 4_000_000, 24_000_000)] == [1, 1, 1, 2, 7, 8, 24]


def test_models_are_fitted_at_once():
    from threading import Barrier, Event
    both, done = Barrier(2, timeout=60), Event()

    def alone():
        done.set()
        return "forest"

    def together(name):
        assert done.is_set()
        both.wait()             # a fit that waits for the other ends only if they run at once
        return name

    fits = {("t", "a"): lambda: together("a"), ("t", "random_forest"): alone, ("t", "b"): lambda: together("b")}
    assert list(mo.fit_all(fits, 1000).items()) == [(("t", "a"), "a"), (("t", "random_forest"), "forest"), (("t", "b"), "b")]
    one = Event()

    def single(name):
        assert not one.is_set()
        one.set()
        one.clear()
        return name

    assert list(mo.fit_all({("t", n): lambda n=n: single(n) for n in "ab"}, mo.AT_ONCE_ROWS).values()) == ["a", "b"]
    with pytest.raises(ValueError):
        mo.fit_all({("t", "a"): lambda: int("x")}, 10)
