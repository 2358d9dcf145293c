"""Dense text vectors from how words stand together: a truncated singular value decomposition of the documents' words.

The matrix of documents and words stays in Spark. A random start block is
multiplied by the matrix and its transpose in one pass, and again after every
orthogonalisation; what returns has a row per word of a bounded vocabulary and a column per
dimension. Words that are used alike get near vectors, so a question finds
documents that say the same with other words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.functions.arrays import from_matrix
from attriflux.operators.retrieval import DIMENSIONS
from attriflux.session import fresh_path

WORDS = 4096            # words that are known, those that most documents hold
OVERSAMPLED = 16        # columns of the block beyond the dimensions that are kept
PASSES = 3              # products with the matrix and its transpose
SEED = 7
BLOCK_ROWS = 256        # documents that a task multiplies at once
FOLDED = 8              # partial sums are added in so many groups first


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


@dataclass(frozen=True)
class DenseEncoder:
    """Known words with their weights, and a vector for each word (rows). A text is the weighted sum of its words' vectors, scaled to length 1."""

    words: tuple[str, ...]
    weights: np.ndarray
    vectors: np.ndarray
    values: np.ndarray          # singular values, falling

    @classmethod
    def fit(cls, df: DataFrame, text: str = "text", dimensions: int = DIMENSIONS, words: int = WORDS, passes: int = PASSES) -> DenseEncoder:
        """Learn from all texts. Reruns give the same vectors up to rounding; each has its largest entry above 0.

        There are as many dimensions as the texts' words can fill, ``dimensions`` at most.
        """
        spark = df.sparkSession
        told = fresh_path(spark, "words")
        df.select(words_of(F.coalesce(F.col(text), F.lit(""))).alias("words")).write.parquet(told)      # the texts are made once
        staged = spark.read.schema("words array<string>").parquet(told)
        counts = staged.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count()
        known = counts.orderBy(F.desc("count"), "word").limit(words).collect()          # at most ``words``
        total = staged.count()
        vocabulary = tuple(r["word"] for r in known)
        weights = np.array([np.log((total + 1.0) / (r["count"] + 1.0)) + 1.0 for r in known])
        path = fresh_path(spark, "word-rows")
        _counted(staged, vocabulary).write.parquet(path)
        rows = spark.read.parquet(path)
        width = min(len(vocabulary), dimensions + OVERSAMPLED)
        if not width:
            return cls((), weights, np.zeros((0, dimensions)), np.zeros(0))
        block = np.random.default_rng(SEED).standard_normal((len(vocabulary), width))
        for _ in range(passes):
            block, _ = np.linalg.qr(_multiplied(rows, weights, block))
        # what the matrix does within the block: its own decomposition
        inner = block.T @ _multiplied(rows, weights, block)
        squares, turned = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-squares, kind="stable")[:dimensions]
        real = order[squares[order] > 1e-10 * max(squares[order[0]], 1e-300)]
        vectors = block @ turned[:, real]
        vectors *= np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
        padded = np.zeros((len(vocabulary), dimensions))
        padded[:, :len(real)] = vectors
        return cls(vocabulary, weights, padded, np.sqrt(squares[real]))

    def embed(self, df: DataFrame, text: str = "text", out: str = "vec") -> DataFrame:
        """Add the vectors. A text without known words gets zeros."""
        table = self.weights[:, None] * self.vectors if len(self.words) else np.zeros((0, self.vectors.shape[1]))
        sent = df.sparkSession.sparkContext.broadcast((self.words, table))          # ``WORDS`` x ``DIMENSIONS`` numbers at most

        @F.arrow_udf("array<double>")
        def encode(words: pa.Array) -> pa.Array:
            known, vectors = sent.value
            return from_matrix(_encoded(words, pa.array(known, pa.string()), vectors))

        return df.withColumn(out, encode(words_of(F.coalesce(F.col(text), F.lit("")))))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, w, float(g), v.tolist()) for i, (w, g, v) in enumerate(zip(self.words, self.weights, self.vectors))]
        spark.createDataFrame(rows, "at int, word string, weight double, vector array<double>").write.mode("overwrite").parquet(f"{path}/words")
        about = [(self.values.tolist(), int(self.vectors.shape[1]))]
        spark.createDataFrame(about, "singular array<double>, dimensions int").write.mode("overwrite").parquet(f"{path}/values")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DenseEncoder:
        rows = spark.read.parquet(f"{path}/words").orderBy("at").collect()
        about = spark.read.parquet(f"{path}/values").first()
        vectors = np.array([r.vector for r in rows]).reshape(len(rows), about.dimensions)
        return cls(tuple(r.word for r in rows), np.array([r.weight for r in rows]), vectors, np.array(about.singular))


def _word_counts(texts: pa.Array, place: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, times) of the known words in lists of words, by row and word."""
    ids = pc.index_in(texts.flatten(), value_set=place).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(texts.offsets.to_numpy()))[ids >= 0]
    found, times = np.unique(row * max(1, len(place)) + ids[ids >= 0], return_counts=True)
    return *np.divmod(found, max(1, len(place))), times


def _encoded(texts: pa.Array, place: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """The texts' vectors. ``BLOCK_ROWS`` texts meet their own words in one dense product: memory does not grow with a batch's words."""
    out = np.zeros((len(texts), vectors.shape[1]))
    for first in range(0, len(texts) if len(vectors) else 0, BLOCK_ROWS):
        part = texts.slice(first, BLOCK_ROWS)
        row, ids, times = _word_counts(part, place)
        used, local = np.unique(ids, return_inverse=True)
        x = np.zeros((len(part), len(used)))
        # word counts are damped: the tenth mention says less than the first
        x[row, local] = 1.0 + np.log(times)
        out[first:first + len(part)] = x @ vectors[used]
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    out /= np.where(norms == 0, 1.0, norms)
    return out


def _counted(staged: DataFrame, vocabulary: tuple[str, ...]) -> DataFrame:
    """Per document the numbers of its known words and how often each stands there."""
    sent = staged.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.array(sent.value, pa.string())
        for batch in batches:
            column = batch.column("words")
            rows, words, times = _word_counts(column, place)
            borders = pa.array(np.searchsorted(rows, np.arange(len(column) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(borders, pa.array(words.astype(np.int32))),
                 pa.ListArray.from_arrays(borders, pa.array(times.astype(np.int32)))], ["words", "times"])

    return staged.mapInArrow(count, "words array<int>, times array<int>")


def _multiplied(rows: DataFrame, weights: np.ndarray, block: np.ndarray) -> np.ndarray:
    """X'(X B) for the weighted matrix X of documents and words: one pass.

    A task returns one matrix as large as B, whatever its documents; these are added in ``FOLDED`` groups and then together.
    """
    sent = rows.sparkSession.sparkContext.broadcast(block)
    schema = "fold int, part binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = sent.value
        total, fold, rows_read = np.zeros(b.shape), 0, 0
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                words, times = part.column("words"), part.column("times")
                ids = words.flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), np.diff(words.offsets.to_numpy()))
                if not len(ids):
                    continue
                value = (1.0 + np.log(times.flatten().to_numpy())) * weights[ids]
                value /= np.sqrt(np.bincount(row, value * value, minlength=part.num_rows))[row]
                # X B, then X' of that, on the slice's own words only: two small dense products
                used, local = np.unique(ids, return_inverse=True)
                x = np.zeros((part.num_rows, len(used)))
                x[row, local] = value
                total[used] += x.T @ (x @ b[used])
                fold += int(ids.sum())
                rows_read += part.num_rows
        if rows_read:
            yield pa.RecordBatch.from_pydict({"fold": pa.array([fold % FOLDED], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch.column("part"):
                own = np.frombuffer(part.as_py()).reshape(block.shape)
                total = own.copy() if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict({"fold": pa.array([0], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(partial, schema).repartition(FOLDED, "fold").mapInArrow(add, schema)
    total = np.zeros(block.shape)
    for r in parts.toLocalIterator():                       # FOLDED matrices as large as the block at most, one after the other
        total += np.frombuffer(r.part).reshape(block.shape)
    return total
