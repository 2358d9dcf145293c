"""Text embedding, the vector index and exact nearest-neighbour search."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from attriflux.functions.arrays import from_matrix, to_matrix
from attriflux.operators.documents import create_documents
from attriflux.session import fresh_path

DIMENSIONS = 384      # fixed value: length of a text embedding
QUERY_BLOCK = 512     # query vectors that are compared together
DOC_BLOCK = 2048      # document vectors that are compared together
DISTANCE_DIGITS = 9   # distances equal to this many digits are ties, settled by id

# Questions of the retrieval check.
QUESTIONS = [
    "Which campaigns have the worst ROAS?",
    "Show me anomalies in social campaigns",
    "Which campaign spent the most money?",
]


def question_frame(spark: SparkSession, questions: list[str] = QUESTIONS) -> DataFrame:
    rows = pd.DataFrame(enumerate(questions), columns=["query_id", "question"]).astype({"query_id": "int32"})
    return spark.createDataFrame(rows)


def term_slots(text: Column) -> Column:
    """Each word's slot in the vector: the first 32 bits of its MD5 modulo the length."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    return F.transform(
        words, lambda t: (F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % DIMENSIONS).cast("int"))


@dataclass(frozen=True)
class TextEncoder:
    """Hashed words, weighted by how rare their slot is, scaled to unit length."""

    weights: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, text: str = "text") -> TextEncoder:
        return cls.fit_slots(df.select(term_slots(F.col(text)).alias("slots")))

    @classmethod
    def fit_slots(cls, df: DataFrame) -> TextEncoder:
        """Count the documents per slot. Slot -1 stands for every document; at most 385 counts come back."""
        slots = F.array_append(F.array_distinct("slots"), F.lit(-1))
        rows = df.select(F.explode(slots).alias("slot")).groupBy("slot").count().collect()
        counts = {r["slot"]: r["count"] for r in rows}
        total = counts.pop(-1, 0)
        return cls(tuple(float(np.log((total + 1.0) / (counts.get(i, 0) + 1.0))) for i in range(DIMENSIONS)))

    def embed(self, df: DataFrame, text: str = "text", out: str = "vec") -> DataFrame:
        return self.embed_slots(df.withColumn("slots", term_slots(F.col(text))), out).drop("slots")

    def embed_slots(self, df: DataFrame, out: str = "vec") -> DataFrame:
        """Slots are computed in the JVM; only they, not the texts, go through Arrow."""
        weights = np.array(self.weights)

        @F.arrow_udf("array<double>")
        def encode(slots: pa.Array) -> pa.Array:
            sizes = np.diff(slots.offsets.to_numpy())
            flat = slots.flatten().to_numpy(zero_copy_only=False)
            cell = np.repeat(np.arange(len(slots)), sizes) * DIMENSIONS + flat
            tf = np.bincount(cell.astype("int64"), minlength=len(slots) * DIMENSIONS)
            vectors = tf.reshape(len(slots), DIMENSIONS) * weights
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            return from_matrix(vectors / np.where(norms == 0, 1.0, norms))

        return df.withColumn(out, encode(F.coalesce("slots", F.array().cast("array<int>"))))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(list(self.weights),)], "weights array<double>").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextEncoder:
        return cls(tuple(spark.read.parquet(path).first()["weights"]))


def embed_documents(documents: DataFrame, encoder: TextEncoder | None = None) -> DataFrame:
    """The documents are made once, with their slots, for the weights and for the vectors."""
    spark = documents.sparkSession
    staged = fresh_path(spark, "slots")
    documents.withColumn("slots", term_slots(F.col("text"))).write.parquet(staged)
    documents = spark.read.parquet(staged)
    return (encoder or TextEncoder.fit_slots(documents)).embed_slots(documents).drop("slots")


def create_index(features: DataFrame, path: str | None = None, buckets: int = 64) -> str:
    """Rebuild the index of a feature table: documents with vectors in buckets of near ones, and the encoder beside them.

    Files are sorted by category and date, so that conditions on the metadata skip parts of them.
    """
    from attriflux.operators import vector_index     # it builds on the search of this module

    spark = features.sparkSession
    path = path or fresh_path(spark, "index")
    # the slots are kept while the index is built: they are needed for the weights and for the vectors
    staged = fresh_path(spark, "slots")
    create_documents(features).withColumn("slots", term_slots(F.col("text"))).write.parquet(staged)
    documents = spark.read.parquet(staged)
    encoder = TextEncoder.fit_slots(documents)
    encoder.save(spark, f"{path}/encoder")
    vectors = fresh_path(spark, "vectors")
    encoder.embed_slots(documents).drop("slots").write.parquet(vectors)
    return vector_index.write_index(spark.read.parquet(vectors), path, buckets=buckets,
                                    order_by=["metadata.category", "metadata.c_date"])


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, TextEncoder]:
    from attriflux.operators import vector_index

    return vector_index.read_index(spark, path), TextEncoder.load(spark, f"{path}/encoder")


def _nearest(ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    distance = np.round(((vectors - query) ** 2).sum(axis=1), DISTANCE_DIGITS)
    best = np.lexsort((ids, distance))[:k]
    return ids[best], distance[best]


def vector_blocks(rows: DataFrame, key: str, size: int, more: str | None = None) -> DataFrame:
    """Rows (key, vec) packed: ``ids``, ``vecs`` (one vector after the other), of ``size`` rows at most.

    ``more`` names an int column whose value all rows of a block share, or an
    array<int> column that is packed like the vectors, with ``more_ends``.
    """
    kept = rows.select(F.col(key).alias("key"), "vec", *([more] if more else []))
    listed = more is not None and isinstance(kept.schema[more].dataType, T.ArrayType)
    own = f"ids array<{kept.schema['key'].dataType.simpleString()}>, vecs array<double>"
    own += f", {more} array<int>, more_ends array<int>" if listed else f", {more} int" if more else ""

    def cut(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        edges = set(range(0, batch.num_rows, size)) | {batch.num_rows}
        if more and not listed:
            values = batch.column(more).to_numpy(zero_copy_only=False)
            edges |= set((np.flatnonzero(values[1:] != values[:-1]) + 1).tolist())
        ordered = sorted(edges)
        return zip(ordered, ordered[1:])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        for batch in batches:
            for first, end in cut(batch):
                part = batch.slice(first, end - first)
                vectors = part.column("vec")
                columns = {"ids": one(part.column("key")), "vecs": one(pa.array(to_matrix(vectors).reshape(-1)))}
                if listed:
                    lists = part.column(more)
                    ends = (lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]).astype(np.int32)
                    columns |= {more: one(lists.flatten()), "more_ends": one(pa.array(ends))}
                elif more:
                    columns[more] = part.column(more).slice(0, 1)
                yield pa.RecordBatch.from_pydict(columns)

    return kept.mapInArrow(pack, own)


class _Best:
    """The best k documents of every query of a block so far."""

    def __init__(self, ids: pa.Array, vectors: np.ndarray, k: int, lists: tuple[np.ndarray, np.ndarray] | None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.squares = (vectors ** 2).sum(axis=1)
        self.limit = np.full(len(vectors), np.inf)          # distance of the k-th best
        self.found: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(vectors)
        self.askers: dict[int, np.ndarray] | None = None
        if lists is not None:
            values, ends = lists
            owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])[:len(values)])
            self.askers = dict(zip(values[starts].tolist(), np.split(owner, starts[1:])))

    def add(self, ids: np.ndarray, vectors: np.ndarray, bucket: int | None) -> None:
        if vectors.shape[1] != self.vectors.shape[1]:
            raise ValueError(f"vectors of {vectors.shape[1]} entries, queries of {self.vectors.shape[1]}")
        asking = np.arange(len(self.vectors)) if self.askers is None else self.askers.get(bucket)
        if asking is None:
            return
        # the product is fast but noisy in its last digits: it picks candidates, exact distances rank them
        rough = (vectors ** 2).sum(axis=1)[:, None] + self.squares[asking] - 2.0 * (vectors @ self.vectors[asking].T)
        limit = self.limit[asking]
        for at in np.flatnonzero(rough.min(axis=0) <= limit + 1e-6 * (1.0 + np.where(np.isinf(limit), 0, limit))):
            near, j = rough[:, at], asking[at]
            most = min(np.partition(near, self.k - 1)[self.k - 1] if len(near) > self.k else np.inf, self.limit[j])
            pick = np.flatnonzero(near <= most + 1e-6 * (1.0 + abs(most))) if np.isfinite(most) else np.arange(len(near))
            new_ids, distance = _nearest(ids[pick], vectors[pick], self.vectors[j], self.k)
            if self.found[j] is not None:
                new_ids, distance = np.concatenate([self.found[j][0], new_ids]), np.concatenate([self.found[j][1], distance])
                best = np.lexsort((new_ids, distance))[:self.k]
                new_ids, distance = new_ids[best], distance[best]
            self.found[j] = (new_ids, distance)
            if len(distance) == self.k:
                self.limit[j] = distance[-1]

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        some = [j for j, f in enumerate(self.found) if f is not None]
        if some:
            each = np.repeat(some, [len(self.found[j][0]) for j in some])
            ids = np.concatenate([self.found[j][0] for j in some])
            yield pa.RecordBatch.from_arrays(
                [self.ids.take(pa.array(each)), pa.array(ids.tolist(), schema.field("doc_id").type),
                 pa.array(np.concatenate([self.found[j][1] for j in some]))], schema=schema)


def nearest_of_blocks(doc_blocks: DataFrame, query_blocks: DataFrame, k: int, bucket: str | None = None) -> DataFrame:
    """(query_id, doc_id, distance, rank) from packed documents and queries; a query's ``bucket`` list limits where it looks.

    Every block of documents meets every block of queries. Catalyst sends the
    queries to the documents if they are small, else it pairs partitions; no
    documents are shuffled. A task keeps k rows per query.
    """
    out = T.StructType([
        T.StructField("query_id", query_blocks.schema["ids"].dataType.elementType),
        T.StructField("doc_id", doc_blocks.schema["ids"].dataType.elementType), T.StructField("distance", T.DoubleType())])
    schema = to_arrow_schema(out)
    renamed = [F.col(c).alias(f"of_{c}") for c in query_blocks.columns]
    asked = query_blocks.select(*renamed, F.monotonically_increasing_id().alias("of_block"))
    pairs = doc_blocks.crossJoin(asked)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                at = lambda name: batch.column(name).slice(i, 1).flatten()
                block = batch.column("of_block")[i].as_py()
                if block not in held:
                    ids = at("of_ids")
                    lists = (at(f"of_{bucket}").to_numpy(), at("of_more_ends").to_numpy()) if bucket else None
                    held[block] = _Best(ids, at("of_vecs").to_numpy().reshape(len(ids), -1), k, lists)
                ids = at("ids")
                held[block].add(ids.to_numpy(zero_copy_only=False), at("vecs").to_numpy().reshape(len(ids), -1),
                                batch.column(bucket)[i].as_py() if bucket else None)
        for best in held.values():
            yield from best.rows(schema)

    hits = pairs.mapInArrow(search, out)
    w = Window.partitionBy("query_id").orderBy("distance", "doc_id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def query_rows(queries: DataFrame, vec: str = "vec") -> DataFrame:
    """The queries with a vector, dealt so that AQE makes few partitions of few queries."""
    rows = queries.select("query_id", F.col(vec).alias("vec")).filter(F.col("vec").isNotNull())
    return rows.repartition("query_id")


def query_topk(docs: DataFrame, queries: DataFrame, top_k: int = 5, doc_id: str = "id", vec: str = "vec",
               block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, doc_id, distance, rank): the exact top k by squared Euclidean distance.

    Documents and queries without a vector take no part; vectors of another
    length are an error; an empty side gives no rows. There is one plan for any number of queries: both sides
    are packed into blocks in Spark, and nothing passes through the driver.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(vec).alias("vec")).filter(F.col("vec").isNotNull())
    return nearest_of_blocks(vector_blocks(rows, "id", DOC_BLOCK), vector_blocks(query_rows(queries, vec), "query_id", block), top_k)


def query_topk_filtered(docs: DataFrame, queries: DataFrame, condition: Column, top_k: int = 5,
                        doc_id: str = "id", vec: str = "vec") -> DataFrame:
    """Top k among the documents whose metadata meets the condition, tested before any distance."""
    return query_topk(docs.filter(condition), queries, top_k, doc_id, vec)


def with_documents(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """Add text and metadata to the hits."""
    return docs.select(F.col("id").alias("doc_id"), "text", "metadata").join(hits, "doc_id")


def batch_questions(docs: DataFrame, encoder: TextEncoder, questions: DataFrame, top_k: int = 3) -> DataFrame:
    """Several questions at once: rank, distance and first line of each hit."""
    hits = query_topk(docs, encoder.embed(questions, "question"), top_k)
    return with_documents(hits, docs).select(
        "query_id", "rank", "doc_id", "distance", F.substring_index("text", "\n", 1).alias("first_line"))
