"""Tree ensembles as tables of nodes, scored in the JVM.

A node is a row: tree, node, feature (its place, -1 for a leaf), threshold, the
children of rows at most, and above, the threshold, and the value of a leaf. For
scoring, the nodes of all trees are packed into one row, which every row
of the data meets; each walks its trees inside expressions, so that no row is
multiplied, shuffled or sent to Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.ml.isolation_forest import IsolationForest, average_path
from attriflux.session import fresh_path

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double"
MOST_NODES = 4_000_000      # of an ensemble that is sent to every task, about 150 MB

# how an ensemble's sum of leaf values becomes its output, and the output a prediction
OUTPUTS = {
    "number": (lambda s, trees, scale: s, None),                                # boosted regression
    "margin": (lambda s, trees, scale: s, 0.0),                                 # boosted classification: 1 above 0
    "share": (lambda s, trees, scale: s / F.lit(float(trees)), 0.5),            # forest: mean share of class 1
    "depth": (lambda s, trees, scale: F.pow(F.lit(2.0), -s / F.lit(float(trees)) / F.lit(scale)), None),     # isolation forest
}


@dataclass(frozen=True)
class NodeEnsemble:
    """Nodes of all trees (by tree, then node, each tree from 0), with what makes their sum a prediction.

    Class 1 is predicted where the output is above ``cut``; without a cut the output is the prediction.
    """

    nodes: tuple[tuple, ...]
    kind: str
    cut: float | None = None
    scale: float = 1.0

    def __post_init__(self):
        if len(self.nodes) > MOST_NODES:
            raise ValueError(f"{len(self.nodes)} nodes; at most {MOST_NODES} are sent to tasks")

    @property
    def trees(self) -> int:
        return len({n[0] for n in self.nodes})

    @classmethod
    def of(cls, spark: SparkSession, model: Any) -> NodeEnsemble:
        """The nodes of a fitted model: Spark's boosted trees and random forest, or the isolation forest."""
        if isinstance(model, IsolationForest):
            nodes = []
            for i, t in enumerate(model.trees):
                for j in range(len(t["feature"])):
                    nodes.append((i, j, int(t["feature"][j]), float(t["threshold"][j]), int(t["left"][j]), int(t["right"][j]),
                                  float(t["depth"][j])))
            return cls(tuple(nodes), "depth", model.threshold, float(average_path(model.sample_rows)) or 1.0)
        kinds = {GBTClassificationModel: "margin", GBTRegressionModel: "number", RandomForestClassificationModel: "share"}
        if type(model) not in kinds:
            raise TypeError(f"{type(model).__name__} has no trees that are read here")
        kind = kinds[type(model)]
        path = fresh_path(spark, "nodes")
        model.write().save(path)
        rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()   # the model
        weights, nodes = list(model.treeWeights), []
        for r in rows:
            leaf = r["leftChild"] < 0
            value = r["impurityStats"][1] / sum(r["impurityStats"]) if kind == "share" else r["prediction"] * weights[r["treeID"]]
            cuts = [] if leaf else r["split"]["leftCategoriesOrThreshold"]
            nodes.append((r["treeID"], r["id"], -1 if leaf else r["split"]["featureIndex"], float(cuts[0]) if cuts else 0.0,
                          r["leftChild"], r["rightChild"], float(value)))
        return cls(tuple(nodes), kind, OUTPUTS[kind][1])

    # ---- as a table ----

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.nodes), NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        about = [(self.kind, self.cut, self.scale)]
        self.table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(about, "kind string, cut double, scale double").write.mode("overwrite").parquet(f"{path}/kind")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NodeEnsemble:
        rows = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()
        about = spark.read.parquet(f"{path}/kind").first()
        return cls(tuple(tuple(r) for r in rows), about.kind, about.cut, about.scale)

    # ---- scoring ----

    def depth(self) -> int:
        """Steps from a root to the lowest leaf."""
        below: dict[tuple[int, int], int] = {}
        for tree, node, feature, _, left, right, _ in reversed(self.nodes):     # children come after their parents
            below[tree, node] = 0 if feature < 0 else 1 + max(below[tree, left], below[tree, right])
        return max((d for (_, node), d in below.items() if node == 0), default=0)

    def packed(self, spark: SparkSession) -> DataFrame:
        """All trees in one row: for each, arrays over its nodes."""
        names = ("feature", "threshold", "left", "right", "value")
        per_tree = self.table(spark).groupBy("tree").agg(*[F.array_sort(F.collect_list(F.struct("node", c))).alias(c) for c in names])
        tree = F.struct("tree", *[F.col(f"{c}.{c}").alias(c) for c in names])       # of each node the field, in the nodes' order
        return per_tree.select(tree.alias("t")).agg(F.array_sort(F.collect_list("t")).alias("_trees"))

    def total(self, x: Column) -> Column:
        """Sum of the leaf values that the features ``x`` (an array) reach in the packed trees."""
        steps = F.sequence(F.lit(1), F.lit(max(1, self.depth())))

        def leaf(t: Column) -> Column:
            # Spark's trees send a row to the left if its value is at most the threshold
            go = lambda node, _: F.when(t["feature"][node] < 0, node).when(
                F.get(x, t["feature"][node]) <= t["threshold"][node], t["left"][node]).otherwise(t["right"][node])
            return t["value"][F.aggregate(steps, F.lit(0), go)]

        return F.aggregate("_trees", F.lit(0.0), lambda total, t: total + leaf(t))

    def transform(self, df: DataFrame, features: list[Column]) -> DataFrame:
        """Add ``score`` (the ensemble's output) and ``prediction``. The one row of trees is as large as the model."""
        make, _ = OUTPUTS[self.kind]
        x = F.array(*[c.cast("double") for c in features])
        joined = df.withColumn("_x", x).join(F.broadcast(self.packed(df.sparkSession)))
        scored = joined.withColumn("score", make(self.total(F.col("_x")), max(1, self.trees), self.scale))
        predicted = F.col("score") if self.cut is None or math.isnan(self.cut) else (F.col("score") > F.lit(self.cut)).cast("double")
        return scored.withColumn("prediction", predicted).drop("_x", "_trees")


def walk(rows: np.ndarray, nodes: tuple[tuple, ...]) -> np.ndarray:
    """Sum of the leaf values that each row reaches, one node after the other: the plain definition, for small inputs."""
    at = {(n[0], n[1]): n for n in nodes}
    out = np.zeros(len(rows))
    for i, x in enumerate(rows):
        for tree in sorted({n[0] for n in nodes}):
            node = at[tree, 0]
            while node[2] >= 0:
                node = at[tree, node[4] if x[node[2]] <= node[3] else node[5]]
            out[i] += node[6]
    return out
