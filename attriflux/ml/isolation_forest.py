"""Isolation forest: trees grown on small samples, one tree per task; rows scored in batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from attriflux.functions.arrays import to_matrix
from attriflux.ml.prepare import cuts
from attriflux.session import fresh_path

TREES = 100
SAMPLE_ROWS = 256
CONTAMINATION = 0.3
SEED = 42
EULER_GAMMA = 0.5772156649015329   # fixed value

TREE_SCHEMA = "tree int, n_rows int, feature array<int>, threshold array<double>, left array<int>, right array<int>, depth array<double>"


def _as_arrays(row) -> dict[str, np.ndarray]:
    """A tree's row as arrays over its nodes."""
    kinds = {"feature": "int64", "threshold": "float64", "left": "int64", "right": "int64", "depth": "float64"}
    return {c: np.array(row[c], dtype=kind) for c, kind in kinds.items()}


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth at which a search in a random tree of n rows ends."""
    n = np.asarray(n, dtype="float64")
    safe = np.maximum(n, 3.0)
    usual = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, usual))


def grow_tree(rows: np.ndarray, rng: np.random.Generator) -> dict[str, list]:
    """Split at random features and values until rows are alone, equal, or the depth limit is met."""
    limit = int(np.ceil(np.log2(max(len(rows), 2))))
    tree: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "depth": []}
    pending = [(rows, 0, None, "")]
    while pending:
        part, depth, parent, side = pending.pop()
        node = len(tree["feature"])
        if parent is not None:
            tree[side][parent] = node
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        inner = depth < limit and len(part) > 1 and len(usable) > 0
        feature = int(rng.choice(usable)) if inner else -1
        threshold = float(rng.uniform(low[feature], high[feature])) if inner else 0.0
        tree["feature"].append(feature)
        tree["threshold"].append(threshold)
        tree["left"].append(-1)
        tree["right"].append(-1)
        tree["depth"].append(float(depth + average_path(len(part))))
        if inner:
            goes_left = part[:, feature] <= threshold
            pending.append((part[~goes_left], depth + 1, node, "right"))
            pending.append((part[goes_left], depth + 1, node, "left"))
    return tree


def path_lengths(trees: tuple[dict, ...], rows: np.ndarray) -> np.ndarray:
    """Mean depth of each row over all trees, a whole batch at a time."""
    total = np.zeros(len(rows))
    everyone = np.arange(len(rows))
    for t in trees:
        node = np.zeros(len(rows), dtype="int64")
        while True:
            feature = t["feature"][node]
            inner = feature >= 0
            if not inner.any():
                break
            left = rows[everyone, np.maximum(feature, 0)] <= t["threshold"][node]
            node = np.where(inner, np.where(left, t["left"][node], t["right"][node]), node)
        total += t["depth"][node]
    return total / len(trees)


def anomaly_scores(trees: tuple[dict, ...], sample_rows: int, rows: np.ndarray) -> np.ndarray:
    norm = float(average_path(sample_rows)) or 1.0
    return np.power(2.0, -path_lengths(trees, rows) / norm)


def _mixed(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A tree's own order of all rows, from their key hashes: uniform 63-bit numbers."""
    h = keys.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed * TREES + tree + 1)) & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def tree_samples(rows: DataFrame, trees: int, seed: int, size: int = SAMPLE_ROWS) -> DataFrame:
    """(tree, at, x): of every tree's order the first ``size`` rows of (key, x), and a few more for certain.

    A task keeps the first rows of each tree's order as it reads, so it gives at
    most trees x size rows, and parts of any division merge to the same sample. Rows that come
    after four times the share that is wanted cannot be among the first and are not sent; so what a
    tree's task receives does not grow with the table.
    """
    n = rows.count()
    cut = (1 << 63) - 1 if n <= 4 * size else int((1 << 63) * (4.0 * size / n))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, pa.Array | None]] = [(np.zeros(0, np.int64), None)] * trees
        for batch in batches:
            keys, x = batch.column("key").to_numpy(), batch.column("x")
            for tree in range(trees):
                at = _mixed(keys, tree, seed)
                own = np.flatnonzero(at <= cut)
                if len(own):
                    have, lists = held[tree]
                    at, more = np.concatenate([have, at[own]]), x.take(pa.array(own))
                    lists = more if lists is None else pa.concat_arrays([lists, more])
                    if len(at) > 2 * size:                  # now and then, not for every batch
                        best = np.argsort(at, kind="stable")[:size]
                        at, lists = at[best], lists.take(pa.array(best))
                    held[tree] = (at, lists)
        for tree, (at, lists) in enumerate(held):
            if len(at):
                best = pa.array(np.argsort(at, kind="stable")[:size])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best), tree, np.int32)), pa.array(at).take(best), lists.take(best)], ["tree", "at", "x"])

    return rows.select("key", "x").mapInArrow(first, "tree int, at bigint, x array<double>")


@dataclass(frozen=True)
class IsolationForest:
    """A fitted forest. A row is anomalous if its score is above the threshold."""

    features: tuple[str, ...]
    trees: tuple[dict, ...]
    sample_rows: int
    threshold: float = float("inf")
    contamination: float = CONTAMINATION
    seed: int = SEED

    @classmethod
    def fit(cls, train: DataFrame, features: list[str], key: list[str], trees: int = TREES,
            contamination: float = CONTAMINATION, seed: int = SEED) -> IsolationForest:
        """Grow every tree on its own sample of all rows, then place the threshold on all training rows.

        A tree takes the first 256 rows of its own order, given by hashes of the
        key. The forest, at most trees x 512 nodes, comes back to the
        driver. The threshold lets exactly the share ``contamination`` of the
        rows pass, rounded up, and those with the last one's score. An empty table cannot be fitted.
        """
        x = F.array(*[F.col(c).cast("double") for c in features]).alias("x")
        rows = train.select(F.xxhash64(F.lit(seed), *key).alias("key"), x)

        schema = to_arrow_schema(T.StructType.fromDDL(TREE_SCHEMA))

        def grow(keys: tuple, sample: pa.Table) -> pa.Table:
            tree = int(keys[0].as_py())
            values = to_matrix(sample["x"].combine_chunks(), len(features))
            order = np.lexsort((*values.T[::-1], sample["at"].to_numpy()))[:SAMPLE_ROWS]
            grown = grow_tree(values[order], np.random.default_rng([seed, tree]))
            return pa.Table.from_pylist([{"tree": tree, "n_rows": len(order), **grown}], schema=schema)

        found = tree_samples(rows, trees, seed).groupBy("tree").applyInArrow(grow, TREE_SCHEMA).orderBy("tree").collect()
        if not found:
            raise ValueError("there are no rows to fit a forest to")
        grown = tuple(_as_arrays(r) for r in found)
        forest = cls(tuple(features), grown, max(r["n_rows"] for r in found), contamination=contamination, seed=seed)
        path = fresh_path(train.sparkSession, "forest-scores")
        forest.score(train).select(F.lit(0).alias("_class"), (-F.col("score")).alias("_draw")).write.parquet(path)
        scores = train.sparkSession.read.parquet(path)
        lowest = -float(cuts(scores, contamination).first()["_cut"])
        return replace(forest, threshold=float(np.nextafter(lowest, -np.inf)))

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Anomaly score in (0, 1]; higher is more unusual."""
        sent = df.sparkSession.sparkContext.broadcast(self.trees)
        sample_rows = self.sample_rows

        width = len(self.features)

        @F.arrow_udf("double")
        def scored(rows: pa.Array) -> pa.Array:
            return pa.array(anomaly_scores(sent.value, sample_rows, to_matrix(rows, width)))

        return df.withColumn(out, scored(F.array(*[F.col(c).cast("double") for c in self.features])))

    def transform(self, df: DataFrame) -> DataFrame:
        """prediction: 1 for anomalies, 0 for usual rows."""
        return self.score(df).withColumn("prediction", (F.col("score") > self.threshold).cast("double"))

    def save(self, spark, path: str) -> None:
        rows = [(i, self.sample_rows, *[t[c].tolist() for c in ("feature", "threshold", "left", "right", "depth")],
                 self.threshold, list(self.features), self.contamination, self.seed) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, TREE_SCHEMA + ", cut double, names array<string>, contamination double, seed bigint").write.mode(
            "overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> IsolationForest:
        rows = spark.read.parquet(path).orderBy("tree").collect()
        return cls(tuple(rows[0]["names"]), tuple(_as_arrays(r) for r in rows), max(r["n_rows"] for r in rows), rows[0]["cut"],
                   rows[0]["contamination"], rows[0]["seed"])
