"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Rows X (centred) are read by Spark alone; the driver holds vectors as long as
a row. Every step multiplies Xv, orthogonalises the product against all earlier
left vectors, and multiplies back by the transposed rows. A left vector is
always X p for a vector p as long as a row, so it is told by p and never
stored: tasks form it anew from their rows, and a lost executor loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attriflux.llm.shared import stored, totals

SCALE = 256                 # entries are read as whole numbers of this fraction
COMPONENTS = 4
TOLERANCE = 1e-13           # residual of a component, as a share of the largest singular value, that counts as none
PROBE_STEPS = 8             # further steps from a new start, which would show a component that the first start missed
NOTHING = 1e-14             # share of the variance that counts as none
EXACT = float(1 << 62)


def whole_numbers(vector: Column) -> Column:
    """floor(256 * entry) as long; what does not fit a long becomes the nearest that does."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(SCALE))).cast("bigint"))


def quantised(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and x of all rows whose vector is there and has finite entries only."""
    entries = F.col(vector).cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = table.filter(F.col(vector).isNotNull() & ~bad)
    return rows.select(F.col(id_column).alias("vec_id"), whole_numbers(F.col(vector)).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


@dataclass(frozen=True)
class Centre:
    """Number of fitted rows and their sums, exact."""

    n: int
    sums: tuple[int, ...]

    def shifted(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: in 64 bits where they suffice, else in Python's integers."""
        most = float(np.abs(x.astype(float)).max(initial=0)) * self.n + max((abs(s) for s in self.sums), default=0)
        if most < EXACT:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.shifted(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact squared distances n^2 |x - mean|^2; None where they do not fit a long."""
        far = self.shifted(x)
        if far.dtype != object and (np.square(far.astype(float)).sum(axis=1) < EXACT).all():
            return np.square(far).sum(axis=1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in far]
        return [v if v < 1 << 63 else None for v in exact]


def _column_sums(rows: DataFrame, width: int) -> Centre:
    schema = "at int, total decimal(38,0), n bigint"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            small = np.abs(x.astype(float)).max(initial=0) * len(x) < EXACT
            total = total + (x.sum(axis=0) if small else x.astype(object).sum(axis=0)).astype(object)
            n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([int(t) for t in total], pa.decimal128(38, 0)),
             pa.array([n] * width, pa.int64())], ["at", "total", "n"])

    found = rows.select("x").mapInArrow(partial, schema).groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    kept = {r["at"]: r for r in found.collect()}            # one row per dimension
    return Centre(int(kept[0]["n"]), tuple(int(kept[i]["total"]) for i in range(width)))


class Rows:
    """The centred fit list. Products with it are sums over tasks; only vectors as long as a row come back."""

    def __init__(self, fit: DataFrame, centre: Centre):
        self.fit, self.centre, self.width = fit.select("x"), centre, len(centre.sums)

    def _summed(self, size: int, of) -> np.ndarray:
        """Sums over all rows of what ``of`` makes of a block of centred rows: ``size`` numbers."""
        centre, width = self.centre, self.width
        return totals(self.fit, size, lambda batch: of(centre.centred(_matrix(batch.column("x"), width))))

    def variance(self) -> float:
        """Sum of all squared entries."""
        return float(self._summed(1, lambda y: np.array([(y * y).sum()]))[0])

    def multiply(self, q: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """For u = X q: products with the left vectors X p (columns of ``left``), its squared length, and X'u. One pass."""
        k = left.shape[1]

        def both(y: np.ndarray) -> np.ndarray:
            u = y @ q
            return np.concatenate([(y @ left).T @ u, [u @ u], y.T @ u])

        found = self._summed(k + 1 + self.width, both)
        return found[:k], float(found[k]), found[k + 1:]

    def moments(self, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Means and covariance (divisor n) of the rows' projections on the directions."""
        k = directions.shape[1]

        def both(y: np.ndarray) -> np.ndarray:
            z = y @ directions
            return np.concatenate([z.sum(axis=0), (z.T @ z).reshape(-1)])

        found = self._summed(k + k * k, both) / self.centre.n
        return found[:k], found[k:].reshape(k, k) - np.outer(found[:k], found[:k])


def _orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(rows: Rows, components: int = COMPONENTS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Singular values (falling) and unit right singular vectors (columns) of the centred rows, ``components`` at most.

    X V = U R holds for the right vectors V, the left vectors U = X P and an
    upper bidiagonal R, whose singular value decomposition gives the
    components. They are done when X'U differs from what R says by nothing in
    them. A start that is orthogonal to a component would never see it, nor
    does one start see both of two equal components; so the steps go on from
    a second start for a while, and as long as it brings anything new. R then has a
    few entries more beside its diagonals. At most as many steps as
    dimensions are taken, after which nothing is missing.
    """
    width, total = rows.width, rows.variance()
    draws = np.random.Generator(np.random.PCG64(13))
    right, left, back = np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((width, 0))
    r = np.zeros((0, 0))
    following, probed_from = None, None
    captured = 0.0
    while right.shape[1] < width and total > 0:
        if following is None:
            following = _orthogonal(draws.standard_normal(width), right)
            following /= np.linalg.norm(following)
        v = _orthogonal(following, right)
        v /= np.linalg.norm(v)
        column = np.zeros(left.shape[1])
        # the only left vector that should have a part in Xv is the last one; what is found of others is taken out as well
        if left.shape[1]:
            column = back.T @ v                             # U'Xv = (X'U)'v
        q = v - left @ column
        for _ in range(3):
            part, square, image = rows.multiply(q, left)
            rest = square - part @ part
            if np.sqrt(part @ part) <= 1e-9 * np.sqrt(max(rest, 0.0)) or rest <= NOTHING * total:
                break
            q, column = q - left @ part, column + part
        right = np.column_stack([right, v])
        r = np.column_stack([r, column])
        captured += column @ column + max(rest, 0.0)
        following = None
        if rest > NOTHING * total:
            alpha = np.sqrt(rest)
            left = np.column_stack([left, (q - left @ part) / alpha])
            r = np.vstack([r, np.append(np.zeros(r.shape[1] - 1), alpha)])
            r[:-1, -1] += part
            back = np.column_stack([back, (image - back @ part) / alpha])
            rest_of = _orthogonal(back[:, -1], right)
            beta = np.linalg.norm(rest_of)
            if beta > 1e-12 * np.sqrt(total):
                following = rest_of / beta
        if total - captured <= NOTHING * total and probed_from is None:
            break
        a, s, b = np.linalg.svd(r, full_matrices=False)
        top = min(components, len(s))
        if top and len(s) >= components:
            wrong = np.linalg.norm(back @ a[:, :top] - right @ (b[:top].T * s[:top]), axis=0).max()
            if wrong <= tolerance * s[0]:
                if probed_from is None:
                    probed_from, following = right.shape[1], None
                elif right.shape[1] >= probed_from + PROBE_STEPS:
                    break
    if not r.size:
        return np.zeros(0), np.zeros((width, 0))
    _, s, b = np.linalg.svd(r, full_matrices=False)
    real = s[:components] ** 2 > NOTHING * s[0] ** 2
    top = int(real.sum())
    return s[:top], right @ b[:top].T


def whiten(table: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: where the vector stands on the component, in standard deviations.

    vec_id, component (from 1, by falling variance), n (distinct vectors, to
    which the components are fitted), deviation (sum of (n*x - S)^2 over the dimensions, exact;
    null where it does not fit a long), whitened, explained (the component's share of the
    variance) and identity_error (largest entry by which the covariance of the
    whitened fit list differs from the identity, measured).

    Rows without a vector, or with a missing or infinite entry, are left out;
    repeated rows and null ids give rows each. Vectors that are shorter than the
    longest end in zeros. There are as many components as directions in which
    the vectors differ at all: none, and hence no rows, for an empty table or one
    distinct vector. Components of equal variance come in any rotation.
    Only the id and the vector are read, so further columns cannot clash.
    """
    rows = stored(quantised(table, id_column, vector), "whole-vectors")
    schema = (f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n bigint, deviation bigint, "
              "whitened double, explained double, identity_error double")
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return table.sparkSession.createDataFrame([], schema)
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("x")))
    fit = stored(rows.select(padded.alias("x")).distinct(), "distinct-vectors")
    centre = _column_sums(fit, width)
    of = Rows(fit, centre)
    values, directions = bidiagonalise(of, components)
    scaled = directions / (values / np.sqrt(centre.n))
    explained = values ** 2 / of.variance() if len(values) else values
    error = float(np.abs(of.moments(scaled)[1] - np.eye(len(values))).max()) if len(values) else 0.0

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), width)
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, centre.n)), pa.array(centre.deviations(x), pa.int64()).take(each),
                 pa.array((centre.centred(x) @ scaled).reshape(-1)), pa.array(np.tile(explained, m)),
                 pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(project, schema)
