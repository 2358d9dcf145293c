"""A vector index in buckets: nearest buckets are read first, and what cannot hold a better hit is not read.

A bounded sample gives a few orthogonal directions and a tree of cuts along
them; every row is put in the bucket of its leaf. A bucket knows the range of its rows
along each direction and the range of what the directions leave over. From
these follows how near to a query any of its rows can be, so the search is exact.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from attriflux.functions.arrays import from_matrix, to_matrix
from attriflux.operators.retrieval import DOC_BLOCK, QUERY_BLOCK, nearest_of_blocks, query_rows, vector_blocks
from attriflux.session import fresh_path

BUCKETS = 64            # partitions of an index; what is known of them is held by the driver, so at most MOST_BUCKETS
MOST_BUCKETS = 4096
DIRECTIONS = 8
ROW_GROUP = 4096        # rows of a Parquet row group: what a condition skips at once
SAMPLE_ROWS = 4096      # rows that directions and cuts are fitted to, drawn by a hash of the id; all rows are indexed


@dataclass(frozen=True)
class Layout:
    """Directions (columns of unit length) and a tree of cuts: node i has children 2i+1 and 2i+2; a leaf has axis -1."""

    directions: np.ndarray
    centre: np.ndarray
    axis: np.ndarray
    cut: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, buckets: int = BUCKETS, directions: int = DIRECTIONS) -> Layout:
        """Directions in which the sample varies most, and cuts at medians along the widest of them."""
        width = sample.shape[1]
        centre = sample.mean(axis=0) if len(sample) else np.zeros(width)
        _, _, right = np.linalg.svd(sample - centre, full_matrices=False) if len(sample) else (0, 0, np.zeros((0, width)))
        chosen = right[:directions].T
        levels = int(np.ceil(np.log2(max(1, min(buckets, MOST_BUCKETS)))))
        axis, cut = np.full((2 << levels) - 1, -1), np.zeros((2 << levels) - 1)
        of = {0: (sample - centre) @ chosen}
        for node in range((1 << levels) - 1):
            rows = of.pop(node, None)
            if rows is None or len(rows) < 2 or not chosen.shape[1]:
                continue
            widest = int(np.argmax(rows.std(axis=0)))
            middle = float(np.median(rows[:, widest]))
            low = rows[:, widest] < middle
            if not low.any():
                continue                                    # half of the rows are equal here
            axis[node], cut[node] = widest, middle
            of[2 * node + 1], of[2 * node + 2] = rows[low], rows[~low]
        return cls(chosen, centre, axis, cut)

    def placed(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Along the directions, length of what they leave over, bucket."""
        moved = vectors - self.centre
        along = moved @ self.directions
        over = np.sqrt(np.maximum(0.0, (moved ** 2).sum(axis=1) - (along ** 2).sum(axis=1)))
        node = np.zeros(len(vectors), np.int64)
        while True:
            axis = self.axis[node]
            inner = axis >= 0
            if not inner.any():
                return along, over, node
            right = along[np.arange(len(node)), axis] >= self.cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)

    def save(self, spark: SparkSession, path: str) -> None:
        row = (self.directions.reshape(-1).tolist(), self.centre.tolist(), self.axis.tolist(), self.cut.tolist())
        schema = "directions array<double>, centre array<double>, axis array<int>, cut array<double>"
        spark.createDataFrame([row], schema).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Layout:
        r = spark.read.parquet(path).first()
        centre = np.array(r.centre)
        return cls(np.array(r.directions).reshape(len(centre), -1), centre, np.array(r.axis), np.array(r.cut))


def write_index(rows: DataFrame, path: str, key: str = "id", vec: str = "vec", buckets: int = BUCKETS,
                directions: int = DIRECTIONS, order_by: list[str] | None = None) -> str:
    """All rows with all their columns below ``path/documents``, one folder per bucket; layout and bucket ranges beside them.

    Files are sorted by the ``order_by`` columns (also fields of structs), whose least and most values Parquet keeps per
    row group and page: a condition on them is pushed to the scan, which skips what cannot meet it.

    Rows without a vector are kept in a bucket of their own, -1. Vectors must
    have one length. ``rows`` is read several times and should be a written table.
    AQE splits large buckets into several files and joins small ones in one task.
    """
    spark = rows.sparkSession
    usable = rows.filter(F.col(vec).isNotNull())
    draw = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 20))
    n = usable.count()
    share = (1 << 20) if n <= SAMPLE_ROWS else max(1, (SAMPLE_ROWS << 20) // n)
    sample = usable.filter(draw < share).select(F.col(vec).cast("array<double>").alias("vec")).limit(2 * SAMPLE_ROWS).toArrow()
    vectors = to_matrix(sample["vec"].combine_chunks()) if sample.num_rows else np.zeros((0, 1))
    layout = Layout.fit(vectors, buckets, directions)
    m = layout.directions.shape[1]

    @F.arrow_udf("struct<bucket:int,along:array<double>,over:double>")
    def place(column: pa.Array) -> pa.Array:
        there = column.is_valid().to_numpy(zero_copy_only=False)
        along, over, bucket = np.zeros((len(column), m)), np.zeros(len(column)), np.full(len(column), -1, np.int32)
        if there.any():
            along[there], over[there], bucket[there] = layout.placed(to_matrix(column.drop_null().cast(pa.list_(pa.float64()))))
        return pa.StructArray.from_arrays([pa.array(bucket), from_matrix(along), pa.array(over)], ["bucket", "along", "over"])

    placed = rows.withColumn("_place", place(F.col(vec))).withColumn("bucket", F.col("_place.bucket"))
    placed = placed.withColumns({"_along": F.col("_place.along"), "_over": F.col("_place.over")}).drop("_place")
    dealt = placed.hint("rebalance", "bucket")
    dealt = dealt.sortWithinPartitions("bucket", *order_by) if order_by else dealt
    dealt.write.mode("overwrite").option("parquet.block.row.count.limit", ROW_GROUP).partitionBy("bucket").parquet(f"{path}/documents")
    spark.createDataFrame([(placed.schema.json(),)], "schema string").write.mode("overwrite").parquet(f"{path}/schema")
    written = _documents(spark, path).filter("bucket >= 0")
    spans = [f(F.col("_along")[i]) for i in range(m) for f in (F.min, F.max)]
    ranges = written.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.array(*spans, F.min("_over"), F.max("_over")).alias("ranges"))
    ranges.coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")         # at most MOST_BUCKETS rows
    layout.save(spark, f"{path}/layout")
    return path


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """With the schema as it was written, so that an index without rows has one."""
    schema = StructType.fromJson(json.loads(spark.read.parquet(f"{path}/schema").first()["schema"]))
    return spark.read.schema(schema).parquet(f"{path}/documents")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The indexed rows; filters on ``bucket`` prune folders."""
    return _documents(spark, path).drop("_along", "_over")


@dataclass(frozen=True)
class Ranges:
    """What is known of all buckets: names, numbers of rows, least and most along the directions and over."""

    bucket: np.ndarray
    n: np.ndarray
    least: np.ndarray
    most: np.ndarray

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ranges:
        rows = sorted(spark.read.parquet(f"{path}/ranges").collect())            # at most MOST_BUCKETS
        spans = np.array([r.ranges for r in rows]).reshape(len(rows), -1, 2) if rows else np.zeros((0, 1, 2))
        return cls(np.array([r.bucket for r in rows], np.int32), np.array([r.n for r in rows]), spans[:, :, 0], spans[:, :, 1])

    def bounds(self, layout: Layout, queries: np.ndarray) -> np.ndarray:
        """(queries, buckets): no row of the bucket has a smaller squared distance."""
        if not len(self.bucket):
            return np.zeros((len(queries), 0))
        along, over, _ = layout.placed(queries)
        point = np.column_stack([along, over])[:, None, :]
        gap = np.maximum(0.0, np.maximum(self.least[None] - point, point - self.most[None]))
        return (gap ** 2).sum(axis=2)


def _choose(asked: DataFrame, layout: Layout, ranges: Ranges, top_k: int, again: bool) -> DataFrame:
    """query_id, vec and the ``buckets`` to read: the nearest that hold k rows, or later all others that may hold a better one."""
    kind = asked.schema["query_id"].dataType.simpleString()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bound = ranges.bounds(layout, to_matrix(batch.column("vec")))
            order = np.argsort(bound, axis=1, kind="stable")
            before = np.cumsum(ranges.n[order], axis=1) - ranges.n[order]
            first = np.zeros(bound.shape, bool)
            np.put_along_axis(first, order, before < top_k, axis=1)
            wanted = first
            if again:
                limit = batch.column("limit").to_numpy(zero_copy_only=False)
                limit = np.where(np.isnan(limit), np.inf, limit)[:, None]
                wanted = ~first & (bound <= limit + 1e-7 * (1.0 + np.where(np.isinf(limit), 0, limit)))
            sizes = wanted.sum(axis=1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ranges.bucket[np.nonzero(wanted)[1]]))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vec"), lists], ["query_id", "vec", "buckets"])

    return asked.mapInArrow(choose, f"query_id {kind}, vec array<double>, buckets array<int>")


def _read(docs: DataFrame, chosen: DataFrame, top_k: int, key: str, vec: str) -> DataFrame:
    """The best hits in the chosen buckets. Only their folders are read."""
    wanted = [r[0] for r in chosen.select(F.explode("buckets").alias("b")).distinct().collect()]     # at most MOST_BUCKETS
    rows = docs.filter(F.col("bucket").isin(sorted(wanted))).select(
        F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("vec"), F.col("bucket").alias("buckets"))
    blocks = vector_blocks(rows, "id", DOC_BLOCK, "buckets")
    return nearest_of_blocks(blocks, vector_blocks(chosen.filter(F.size("buckets") > 0).repartition("query_id"), "query_id", QUERY_BLOCK, "buckets"), top_k, "buckets")


def search_index(spark: SparkSession, path: str, queries: DataFrame, top_k: int = 5, condition: Column | None = None,
                 key: str = "id", vec: str = "vec") -> tuple[DataFrame, DataFrame]:
    """(query_id, doc_id, distance, rank): the exact top k, as ``query_topk`` gives them, and (query_id, buckets): what was read.

    First each query reads the buckets nearest to it that hold k rows, which
    bounds the distance of its k-th hit; then the buckets that may hold a nearer one.
    A ``condition`` is tested on the rows of the buckets; a query that finds
    fewer than k rows reads on everywhere. Queries stay distributed; their hits are written between the rounds.
    """
    layout, ranges = Layout.load(spark, f"{path}/layout"), Ranges.load(spark, path)
    docs = read_index(spark, path)
    docs = docs.filter(condition) if condition is not None else docs
    kept = lambda df, name: _written(df, fresh_path(spark, name))
    asked = query_rows(queries).select("query_id", F.col("vec").cast("array<double>").alias("vec"))
    first = kept(_choose(asked, layout, ranges, top_k, False), "first-buckets")
    near = kept(_read(docs, first, top_k, key, vec), "first-hits")
    limits = near.filter(F.col("rank") == top_k).select("query_id", F.col("distance").alias("limit"))
    rest = kept(_choose(first.select("query_id", "vec").join(limits, "query_id", "left"), layout, ranges, top_k, True), "more-buckets")
    more = _read(docs, rest, top_k, key, vec)
    hits = near.drop("rank").unionByName(more.drop("rank"))
    w = Window.partitionBy("query_id").orderBy("distance", "doc_id")
    hits = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k)
    both = first.select("query_id", "buckets").unionByName(rest.select("query_id", "buckets"))
    return hits, both.groupBy("query_id").agg(F.sort_array(F.flatten(F.collect_list("buckets"))).alias("buckets"))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def share_read(spark: SparkSession, path: str, reads: DataFrame) -> DataFrame:
    """query_id, and the share of indexed rows in the buckets it read."""
    ranges = spark.read.parquet(f"{path}/ranges").select("bucket", "n")
    total = ranges.agg(F.sum("n").alias("total"))
    per = reads.select("query_id", F.explode("buckets").alias("bucket")).join(ranges, "bucket").groupBy("query_id").agg(F.sum("n").alias("n"))
    return per.join(F.broadcast(total)).select("query_id", (F.col("n") / F.col("total")).alias("share"))
