"""SHAP values: closed form for linear models, exact for trees, exact over coalitions for the rest."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb, factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel)
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.functions.arrays import from_matrix, to_matrix
from attriflux.functions.columns import key_fraction
from attriflux.ml.isolation_forest import IsolationForest, anomaly_scores
from attriflux.ml.models import Trained
from attriflux.ml.prepare import business_key, clean_features
from attriflux.session import fresh_path

BACKGROUND_ROWS = 50
EXACT_FEATURES = 12         # up to so many features every coalition is taken, 4,096 at most
COALITIONS = 4096           # sampled coalitions of more features
TABLE_CELLS = 512           # ways in which the rows of a group of leaves may differ
GROUP_LEAVES = 62           # leaves of a group: one bit each
KEPT_NUMBERS = 1 << 23      # numbers of tables that a task keeps from one batch to the next
KERNEL_CELLS = 1 << 21      # numbers of the mixed rows that one prediction call gets
BLOCK_ROWS = 16384          # rows that look up their cells at once


# ---- linear models ----

def shap_linear(df: DataFrame, features: list[str], weights: list[float], means: list[float] | None = None,
                out: str = "shap_values") -> DataFrame:
    """weight x (value - mean of the feature); the log-odds scale for a logistic model."""
    if means is None:
        row = df.agg(*[F.avg(c) for c in features]).first()
        means = [float(v or 0.0) for v in row]
    parts = [F.lit(float(w)) * (F.col(c) - F.lit(m)) for c, w, m in zip(features, weights, means)]
    return df.withColumn(out, F.array(*parts))


# ---- tree ensembles ----

def read_trees(spark: SparkSession, model) -> list[tuple[float, list[dict]]]:
    """(weight, nodes) of every tree, from the node table that Spark's model writer saves.

    Values are on the scale that is explained: the probability of class 1 for
    a random forest, the log-odds (twice the margin) for boosted
    classification, the prediction for regression.
    """
    path = fresh_path(spark, "trees")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    weights = {i: w for i, w in enumerate(model.treeWeights)}
    forest = isinstance(model, RandomForestClassificationModel)
    scale = 2.0 if isinstance(model, GBTClassificationModel) else 1.0
    trees: dict[int, list[dict]] = {}
    for r in rows:
        stats = r["impurityStats"]
        value = stats[1] / sum(stats) if forest else r["prediction"]
        trees.setdefault(r["treeID"], []).append({
            "value": value, "cover": r["rawCount"], "left": r["leftChild"], "right": r["rightChild"],
            "feature": r["split"]["featureIndex"],
            "threshold": r["split"]["leftCategoriesOrThreshold"][0] if r["leftChild"] >= 0 else 0.0})
    share = sum(weights.values()) if forest else 1.0
    return [(scale * weights[t] / share, nodes) for t, nodes in sorted(trees.items())]


def leaf_rules(trees: list[tuple[float, list[dict]]]) -> list[tuple]:
    """Every leaf as (features, lower bounds, upper bounds, cover shares, weighted value).

    A path visits a feature once or more; its bounds are intersected and its
    cover shares multiplied, so a leaf has one entry per distinct feature.
    """
    leaves = []
    for weight, nodes in trees:
        pending = [(0, {})]
        while pending:
            i, path = pending.pop()
            node = nodes[i]
            if node["left"] < 0:
                items = sorted(path.items())
                leaves.append((
                    np.array([f for f, _ in items], dtype="int64"), np.array([v[0] for _, v in items]),
                    np.array([v[1] for _, v in items]), np.array([v[2] for _, v in items]),
                    weight * node["value"]))
                continue
            low, high, share = path.get(node["feature"], (-np.inf, np.inf, 1.0))
            for child, bounds in ((node["left"], (low, min(high, node["threshold"]))),
                                  (node["right"], (max(low, node["threshold"]), high))):
                part = share * nodes[child]["cover"] / node["cover"]
                pending.append((child, {**path, node["feature"]: (*bounds, part)}))
    return leaves


def _orders(d: int) -> np.ndarray:
    """Shapley weights s! (d-s-1)! / d! for s = 0..d-1."""
    return np.array([factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)])


def leaf_arrays(leaves: list[tuple], features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower bounds, upper bounds and cover shares as (feature, leaf) matrices, and the leaves' values.

    A feature that a path does not visit has no bounds and the share 1, so its factor below is always 1.
    """
    low, high = np.full((features, len(leaves)), -np.inf), np.full((features, len(leaves)), np.inf)
    share, values = np.ones((features, len(leaves))), np.zeros(len(leaves))
    for i, (at, lows, highs, shares, value) in enumerate(leaves):
        low[at, i], high[at, i], share[at, i], values[i] = lows, highs, shares, value
    return low, high, share, values


def expected_value(leaves: list[tuple]) -> float:
    return float(sum(value * np.prod(shares) for _, _, _, shares, value in leaves))


def grouped_leaves(first: np.ndarray, last: np.ndarray, ranks: np.ndarray) -> list[int]:
    """Where groups of neighbouring leaves begin, and the end: a group's rows differ in at most ``TABLE_CELLS`` ways, if it has two leaves."""
    starts, held, count = [0], [], 0
    for i in range(first.shape[1]):
        one = [{(a, b)} for a, b in zip(first[:, i].tolist(), last[:, i].tolist())]
        joined = [h | o for h, o in zip(held, one)] if count else one
        cells = 1
        for spans, top in zip(joined, ranks.tolist()):
            borders = {a for a, _ in spans} | {b + 1 for _, b in spans}
            inner = len(borders - {0, top + 1})
            cells *= min(inner, 1) + 1 if len(spans) == 1 else inner + 1
        if count and (cells > TABLE_CELLS or count == GROUP_LEAVES):
            starts.append(i)
            joined, count = one, 0
        held, count = joined, count + 1
    return [*starts, first.shape[1]]


def leaf_table(first: np.ndarray, last: np.ndarray, ranks: np.ndarray, share: np.ndarray,
               value: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """SHAP values by a group's leaves for every way in which rows can differ, and per feature what a rank adds to a row's cell.

    A feature outside a coalition counts with its cover share z, one inside
    with m = 0 or 1. The weight s! (d-s-1)! / d! of a coalition is the
    integral of t^s (1-t)^(d-1-s) over 0..1, so the sum over all coalitions
    of the other features is the integral of the product of their factors
    z (1-t) + m t. That is a polynomial in t, which Gauss-Legendre points
    integrate exactly: no coalition is ever listed.
    """
    used = np.flatnonzero(((first > 0) | (last < ranks[:, None])).any(axis=1))
    points, weights = np.polynomial.legendre.leggauss((len(used) + 1) // 2 or 1)
    points, weights = (points + 1) / 2, weights / 2
    product = (weights * value[:, None]).reshape(1, -1)         # cells x (leaf, point)
    digits, changes = [], []
    for f in used:
        borders = np.unique(np.concatenate([[0], first[f], last[f] + 1]))
        borders = borders[borders <= ranks[f]]
        met = (borders[:, None] >= first[f]) & (borders[:, None] <= last[f])
        # ranks that the same leaves meet are one digit
        _, at, digit = np.unique(met @ (1 << np.arange(met.shape[1])), return_index=True, return_inverse=True)
        met, z = met[at, :, None], share[f][:, None]
        factor = (z * (1 - points) + met * points).reshape(len(at), -1)
        changes.append(np.broadcast_to(met - z, (*met.shape[:2], len(points))).reshape(len(at), -1) / factor)
        digits.append(np.repeat(digit, np.diff([*borders, ranks[f] + 1])))
        product = (product[:, None, :] * factor).reshape(-1, product.shape[1])
    table, steps, below = np.zeros((len(product), len(ranks))), [], len(product)
    for f, digit, change in zip(used, digits, changes):
        below //= len(change)
        parts = product.reshape(-1, len(change), below, product.shape[1])
        table[:, f] = np.matmul(parts, change[:, :, None]).reshape(-1)
        steps.append((int(f), digit * below))
    return steps, table


def leaf_ranks(leaves: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> tuple:
    """What ``LeafTables`` is made of: thresholds per feature, the first and last rank inside each leaf's bounds, shares, values, groups."""
    low, high, share, value = leaves
    both = [np.concatenate([a, b]) for a, b in zip(low, high)]
    cuts = [np.unique(x[np.isfinite(x)]) for x in both]
    span = lambda bounds, side: np.array([np.searchsorted(c, x, side) for c, x in zip(cuts, bounds)], dtype="int64")
    first, last = span(low, "right"), span(high, "left")
    return cuts, first, last, share, value, grouped_leaves(first, last, np.array([len(c) for c in cuts]))


class LeafTables:
    """The trees as tables that rows are looked up in: a row's SHAP values are a sum of one table row per group of leaves.

    What a leaf gives depends on the features whose bounds a row meets, not on the row's numbers. So every value is told
    by its rank among the model's thresholds, a group of neighbouring leaves is worked out once for all cells of ranks
    that differ to it, and rows only look up their cells. Tables above ``KEPT_NUMBERS`` are made again for each call.
    """

    def __init__(self, cuts: list[np.ndarray], first: np.ndarray, last: np.ndarray, share: np.ndarray, value: np.ndarray,
                 starts: list[int]) -> None:
        self.cuts, self.first, self.last, self.share, self.value, self.starts = cuts, first, last, share, value, starts
        self.ranks = np.array([len(c) for c in cuts], dtype="int64")
        self.kept: list | None = None

    def tables(self) -> Iterator[tuple[list[tuple[int, np.ndarray]], np.ndarray]]:
        if self.kept is not None:
            yield from self.kept
            return
        made, numbers = [], 0
        for a, b in zip(self.starts, self.starts[1:]):
            one = leaf_table(self.first[:, a:b], self.last[:, a:b], self.ranks, self.share[:, a:b], self.value[a:b])
            numbers += one[1].size
            if numbers <= KEPT_NUMBERS:
                made.append(one)
            yield one
        if numbers <= KEPT_NUMBERS:
            self.kept = made

    def values(self, rows: np.ndarray) -> np.ndarray:
        at = [np.searchsorted(c, x) for c, x in zip(self.cuts, rows.T)]          # how many thresholds are below
        phi, cell, step, found = np.zeros(rows.shape), *np.zeros((2, len(rows)), dtype="int64"), np.empty(rows.shape)
        for steps, table in self.tables():
            cell[:] = 0
            for f, adds in steps:
                cell += np.take(adds, at[f], out=step, mode="clip")
            phi += np.take(table, cell, axis=0, out=found, mode="clip")
        return phi


def tree_shap_values(leaves: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """SHAP values of every row from the arrays of ``leaf_arrays``."""
    return LeafTables(*leaf_ranks(leaves)).values(rows)


def shap_tree(df: DataFrame, features: list[str], leaves: list[tuple], out: str = "shap_values") -> DataFrame:
    """Exact path-dependent SHAP values of the trees whose leaves are given.

    What is sent to the tasks is three numbers per leaf and feature. Tables are made in the tasks.
    """
    sent = df.sparkSession.sparkContext.broadcast(leaf_ranks(leaf_arrays(leaves, len(features))))   # as large as the model
    made: list[LeafTables] = []         # a task's own

    @F.arrow_udf("array<double>")
    def values(rows: pa.Array) -> pa.Array:
        matrix = to_matrix(rows, len(features))
        if not made:
            made.append(LeafTables(*sent.value))
        parts = [made[0].values(matrix[at:at + BLOCK_ROWS]) for at in range(0, len(matrix), BLOCK_ROWS)]
        return from_matrix(np.concatenate(parts) if parts else matrix)

    return df.withColumn(out, values(F.array(*[F.col(c).cast("double") for c in features])))


# ---- any other model ----

def coalition_weights(k: int) -> np.ndarray:
    """The k x 2^k matrix that turns the coalitions' values into Shapley values."""
    masks = (np.arange(2 ** k)[None, :] >> np.arange(k)[:, None]) & 1
    sizes = masks.sum(axis=0)
    orders = _orders(k)
    return np.where(masks == 1, orders[np.maximum(sizes - 1, 0)], -orders[np.minimum(sizes, k - 1)])


def sampled_coalitions(k: int, samples: int = COALITIONS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Coalitions (rows of 0 and 1, the empty and the full one last) and the k x n matrix that estimates Shapley values of them.

    Values are the weighted least squares fit of additive contributions, held to
    the sum that is to be explained. Sizes whose coalitions are few enough are listed whole, from the
    outermost inwards; of the others coalitions are drawn by their weight,
    each with its complement. Exact for additive functions; else the error falls with the square root of ``samples``.
    """
    draws = np.random.default_rng([seed, k])
    mass = {s: (k - 1) / (s * (k - s)) for s in range(1, k)}           # kernel weight of all coalitions of a size
    masks, weights, left = [], [], samples
    size = 1
    while size <= k - size:
        sides = {size, k - size}
        if comb(k, size) * len(sides) > left:
            break
        for members in combinations(range(k), size):
            row = np.zeros(k)
            row[list(members)] = 1
            for mask in ([row, 1 - row] if len(sides) == 2 else [row]):
                masks.append(mask)
                weights.append(mass[size] / comb(k, size))
        left -= comb(k, size) * len(sides)
        size += 1
    rest = list(range(size, k - size + 1))
    if rest and left >= 2:
        share = np.array([mass[s] for s in rest])
        sizes = draws.choice(rest, size=left // 2, p=share / share.sum())
        for s in sizes:
            row = np.zeros(k)
            row[draws.permutation(k)[:s]] = 1
            masks += [row, 1 - row]
            weights += [share.sum() / (2 * len(sizes))] * 2
    z, w = np.array(masks), np.array(weights)
    # the last contribution is what the others leave of the sum
    x = z[:, :-1] - z[:, -1:]
    solve = np.linalg.lstsq((x * w[:, None]).T @ x, (x * w[:, None]).T, rcond=None)[0]
    first = np.column_stack([solve, -(solve @ (1 - z[:, -1])), -(solve @ z[:, -1])])   # of v(S), then v(none), v(all)
    last = -first.sum(axis=0)
    last[-2:] += (-1, 1)
    return np.vstack([z, np.zeros(k), np.ones(k)]).astype(bool), np.vstack([first, last])


def coalitions(k: int) -> tuple[np.ndarray, np.ndarray]:
    """All coalitions up to ``EXACT_FEATURES`` features, sampled ones beyond, and what makes Shapley values of theirs."""
    if k > EXACT_FEATURES:
        return sampled_coalitions(k)
    return ((np.arange(2 ** k)[:, None] >> np.arange(k)[None, :]) & 1).astype(bool), coalition_weights(k)


def kernel_shap_values(predict: Callable[[np.ndarray], np.ndarray], background: np.ndarray, rows: np.ndarray,
                       chosen: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Features outside a coalition take the background rows' values."""
    k = rows.shape[1]
    masks, weights = chosen or coalitions(k)
    inside = masks[:, None, :]
    out = np.empty(rows.shape)
    block = max(1, KERNEL_CELLS // (background.size * len(masks)))
    for at in range(0, len(rows), block):
        mixed = np.where(inside, rows[at:at + block, None, None, :], background)
        scores = predict(mixed.reshape(-1, k)).reshape(*mixed.shape[:3])
        out[at:at + block] = scores.mean(axis=2) @ weights.T
    return out


def background_sample(df: DataFrame, features: list[str], rows: int = BACKGROUND_ROWS) -> np.ndarray:
    """The rows with the smallest key hashes: at most ``rows`` come back."""
    picked = df.orderBy(key_fraction(F.lit("background"), *business_key(df)), *features).limit(rows)
    return np.array([list(r) for r in picked.select(*[F.col(c).cast("double") for c in features]).collect()])


def shap_kernel(df: DataFrame, features: list[str], predict: Callable[[np.ndarray], np.ndarray],
                background: np.ndarray | None = None, out: str = "shap_values") -> DataFrame:
    """SHAP values of any vectorised prediction function, against a background of at most 50 rows.

    A row costs coalitions x background predictions, so this is for models
    that neither ``shap_linear`` nor ``shap_tree`` can explain. Up to
    ``EXACT_FEATURES`` features all coalitions are taken, beyond them ``COALITIONS``.
    """
    background = background_sample(df, features) if background is None else background
    sent = df.sparkSession.sparkContext.broadcast((background, coalitions(len(features))))

    @F.arrow_udf("array<double>")
    def values(rows: pa.Array) -> pa.Array:
        known, chosen = sent.value
        return from_matrix(kernel_shap_values(predict, known, to_matrix(rows, len(features)), chosen))

    return df.withColumn(out, values(F.array(*[F.col(c).cast("double") for c in features])))


# ---- choice by model ----

def explain(trained: Trained, df: DataFrame, out: str = "shap_values") -> DataFrame:
    """SHAP values of a trained model on scaled features, by the method that suits the model.

    The result holds the input columns with features cleaned and scaled, and
    the array of SHAP values in feature order.
    """
    features = list(trained.scaler.features)
    scaled = trained.scaler.transform(clean_features(df, features))
    model = trained.model
    if isinstance(model, (LinearRegressionModel, LogisticRegressionModel)):
        return shap_linear(scaled, features, list(model.coefficients), out=out)
    if isinstance(model, (RandomForestClassificationModel, GBTClassificationModel, GBTRegressionModel)):
        return shap_tree(scaled, features, leaf_rules(read_trees(df.sparkSession, model)), out)
    if isinstance(model, IsolationForest):
        trees, size, cut = model.trees, model.sample_rows, model.threshold
        return shap_kernel(
            scaled, features, lambda x: np.where(anomaly_scores(trees, size, x) > cut, -1.0, 1.0), out=out)
    raise TypeError(f"no explanation for {type(model).__name__}")
