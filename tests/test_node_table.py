import numpy as np
import pytest
from pyspark.sql import functions as F

from attriflux.catalog import learning as le
from attriflux.ml import models as mo
from attriflux.ml.node_table import NodeEnsemble, walk


@pytest.mark.parametrize("task,name", [("anomaly", "xgboost"), ("anomaly", "isolation_forest"), ("forecast", "lightgbm")])
def test_walks_agree_with_the_fitted_model(spark, folder, task, name):
    trained, prepared = le.fitted(spark, folder, task, name), le.prepared_rows(spark, folder, task)
    ensemble = NodeEnsemble.of(spark, trained.model)
    assert ensemble.trees == 100 and ensemble.depth() >= 4
    rows = prepared.rows.limit(300).select(*le.KEY, *trained.scaler.features).persist()
    theirs = {tuple(r[k] for k in le.KEY): r.prediction for r in trained.transform(rows).collect()}
    mine = {tuple(r[k] for k in le.KEY): r.prediction for r in mo.Trained(name, ensemble, trained.scaler, trained.target).transform(rows).collect()}
    assert mine.keys() == theirs.keys() and all(mine[k] == pytest.approx(theirs[k], abs=1e-9) for k in mine)


def test_no_python_and_no_shuffle_of_rows(spark, folder):
    trained = le.given_model(spark, folder, "roas")
    rows = spark.range(100).select(*[F.col("id").cast("double").alias(c) for c in trained.scaler.features])
    plan = trained.transform(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastNestedLoopJoin" in plan


def test_saved_nodes_come_back_and_score_like_the_plain_walk(spark, tmp_path):
    draws = np.random.default_rng(2)
    nodes = []
    for tree in range(5):
        for node in range(15):
            leaf = node >= 7
            nodes.append((tree, node, -1 if leaf else int(draws.integers(3)), float(draws.normal()), -1 if leaf else 2 * node + 1,
                          -1 if leaf else 2 * node + 2, float(draws.normal()) if leaf else 0.0))
    nodes.append((5, 0, -1, 0.0, -1, -1, 0.25))         # a tree that is a leaf
    ensemble = NodeEnsemble(tuple(nodes), "margin", 0.0)
    ensemble.save(spark, str(tmp_path))
    loaded = NodeEnsemble.load(spark, str(tmp_path))
    assert loaded == ensemble and ensemble.depth() == 3
    x = draws.normal(size=(200, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    out = sorted((r.id, r.score, r.prediction) for r in loaded.transform(df, [F.col(c) for c in "abc"]).collect())
    want = walk(x, ensemble.nodes)
    assert np.allclose([s for _, s, _ in out], want) and [p for _, _, p in out] == [float(w > 0) for w in want]


def test_other_models_are_refused(spark, folder):
    with pytest.raises(TypeError):
        NodeEnsemble.of(spark, le.fitted(spark, folder, "forecast", "linear_regression").model)
