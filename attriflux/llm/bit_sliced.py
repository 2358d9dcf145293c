"""Exact top-k search by inner product over a bit-sliced index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attriflux.llm.shared import stored

TOP = 5
EVERY = 50                  # rows whose id is divisible by it are the queries
SCALE = 256
BLOCK_ROWS = 8192           # rows of an index block: one bitmap has a bit for each
BLOCK_QUERIES = 64

_INDEX = pa.schema([("ib", pa.int64()), ("ids", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())),
                    ("bits", pa.list_(pa.int32())), ("slices", pa.binary())])


def quantised(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id and floor(256 x) of every component, without rows whose vector or id cannot take part."""
    rows = embeddings.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(finite)
    return rows.select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(SCALE))).cast("long")).alias("v"))


def _matrix(vectors: pa.ChunkedArray, least: int = 0) -> np.ndarray:
    """The vectors as rows; shorter ones are filled up with zeros, which add nothing to a product."""
    lists = vectors.to_pylist()
    out = np.zeros((len(lists), max([least, *map(len, lists)])), np.int64)
    for row, values in zip(out, lists):
        row[:len(values)] = values
    return out


def _distinct(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors in order of id, equal rows once."""
    ids, vectors = table["id"].to_numpy(), _matrix(table["v"])
    both = np.unique(np.concatenate([ids[:, None], vectors], axis=1), axis=0)
    return both[:, 0], both[:, 1:]


def build_slices(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least value and number of bits of every attribute, and a bitmap over the rows for each of these bits."""
    low = vectors.min(axis=0)
    raised = vectors - low
    bits = np.array([int(m).bit_length() for m in raised.max(axis=0)], np.int32)
    words = -(-len(vectors) // 64)
    slices = np.zeros((int(bits.sum()), words * 8), np.uint8)
    at = 0
    for d, count in enumerate(bits):
        for b in range(count):
            packed = np.packbits((raised[:, d] >> b & 1).astype(bool), bitorder="little")
            slices[at, :len(packed)] = packed
            at += 1
    return low, bits, slices.view(np.uint64)


def add_up(slices: np.ndarray, bits: np.ndarray, low: np.ndarray, queries: np.ndarray) -> tuple[list, np.ndarray]:
    """Bitmaps (queries x words) of the bits of all inner products, lowest first, and what to add per query.

    A product with a negative factor is that of its size and the complement of
    the attribute's slices, less a constant; so only additions of bitmaps are
    left. They go through full adders, three bitmaps of a weight at a time.
    """
    weights: list[list[np.ndarray]] = []

    def add(weight: int, bitmap: np.ndarray) -> None:
        while len(weights) <= weight:
            weights.append([])
        column = weights[weight]
        column.append(bitmap)
        if len(column) == 3:
            a, b, c = column
            half = a ^ b
            weights[weight] = [half ^ c]
            add(weight + 1, (a & b) | (half & c))

    full = ~np.uint64(0)
    size, negative = np.abs(queries), queries < 0
    shift = queries @ low[:queries.shape[1]] - (np.where(negative, size, 0) @ ((1 << bits[:queries.shape[1]].astype(np.int64)) - 1))
    at = 0
    for d, count in enumerate(bits):
        if d < queries.shape[1]:
            flip = np.where(negative[:, d], full, np.uint64(0))[:, None]
            masks = [(k, np.where(size[:, d] >> k & 1, full, np.uint64(0))[:, None])
                     for k in range(int(size[:, d].max()).bit_length())]
            for b in range(count):
                bitmap = slices[at + b][None, :] ^ flip
                for k, mask in masks:
                    add(k + b, bitmap & mask)
        at += count
    total, carry, weight = [], None, 0
    while weight < len(weights) or carry is not None:
        column = list(weights[weight]) if weight < len(weights) else []
        if carry is not None:
            column.append(carry)
        carry = None
        if len(column) == 3:
            half = column[0] ^ column[1]
            total.append(half ^ column[2])
            carry = (column[0] & column[1]) | (half & column[2])
        elif len(column) == 2:
            total.append(column[0] ^ column[1])
            carry = column[0] & column[1]
        else:
            total.append(column[0] if column else np.zeros((len(queries), slices.shape[1]), np.uint64))
        weight += 1
    return total, shift


def select_top(total: list[np.ndarray], query: int, allowed: np.ndarray, top: int) -> np.ndarray:
    """Rows with the highest sums, from the most significant slice downward; of equal ones at the border the first."""
    sure, border = np.zeros_like(allowed), allowed
    for bitmap in reversed(total):
        high = border & bitmap[query]
        count = int(np.bitwise_count(sure | high).sum())
        if count > top:
            border = high
            continue
        sure |= high
        if count == top:
            border = np.zeros_like(border)
            break
        border = border & ~bitmap[query]
    rows = lambda bitmap: np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
    chosen = rows(sure)
    return np.concatenate([chosen, rows(border)[:top - len(chosen)]])


def top_products(embeddings: DataFrame, top: int = TOP, every: int = EVERY, id_column: str = "vec_id",
                 vector: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score: each query's rows of the highest integer inner products.

    Rows are dealt by hash into index blocks; a block keeps a bitmap per bit of
    every attribute. Queries go in blocks against all index blocks: bitmap
    arithmetic adds up the products of all rows at once, the top rows are
    selected slice by slice, and ties at the border go to the smaller id. Each
    pair of blocks gives ``top`` rows per query, and the best of them remain.

    Null vectors, vectors with null or non-finite components and null ids take
    no part. Rows that repeat count once; a query's own rows are those with its
    id. Of different vectors with a query's id the smallest asks. Shorter
    vectors are filled up with zeros. Products have to fit 64 bits. An empty
    table, or one without queries, gives no rows.
    """
    rows = stored(quantised(embeddings, id_column, vector), "vectors")
    queries = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    rows_count, query_count = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("id") % every == 0, 1))).first()
    index_blocks, query_blocks = max(1, -(-rows_count // block_rows)), max(1, -(-query_count // BLOCK_QUERIES))

    def index(table: pa.Table) -> pa.Table:
        ids, vectors = _distinct(table)
        low, bits, slices = build_slices(vectors)
        return pa.Table.from_pydict({
            "ib": [table["ib"][0].as_py()], "ids": [ids.tolist()], "low": [low.tolist()], "bits": [bits.tolist()],
            "slices": [slices.tobytes()]}, schema=_INDEX)

    dealt = rows.withColumn("ib", F.pmod(F.xxhash64("id"), F.lit(index_blocks)))
    built = stored(dealt.groupBy("ib").applyInArrow(
        index, "ib long, ids array<long>, low array<long>, bits array<int>, slices binary"), "bit-slices")
    asked = queries.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(query_blocks)))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = built.withColumn("qb", each(query_blocks))
    right = asked.withColumn("ib", each(index_blocks))

    def search(block: pa.Table, asking: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if block.num_rows and asking.num_rows:
            ids, low, bits = (np.array(block[n][0].as_py(), np.int64) for n in ("ids", "low", "bits"))
            slices = np.frombuffer(block["slices"][0].as_py(), np.uint64)
            slices = slices.reshape(int(bits.sum()), -1) if len(slices) else np.zeros((0, -(-len(ids) // 64)), np.uint64)
            names, vectors = asking["id"].to_numpy(), _matrix(asking["v"])[:, :len(bits)]
            for first in range(0, len(names), BLOCK_QUERIES):
                some = slice(first, first + BLOCK_QUERIES)
                total, shift = add_up(slices, bits, low, vectors[some])
                for q, name in enumerate(names[some].tolist()):
                    allowed = np.zeros(slices.shape[1] * 64, bool)
                    allowed[:len(ids)] = ids != name
                    chosen = select_top(total, q, np.packbits(allowed, bitorder="little").view(np.uint64), top)
                    for row in chosen.tolist():
                        bit = lambda bitmap: int(bitmap[q, row >> 6]) >> (row & 63) & 1
                        out["query_id"].append(name)
                        out["vec_id"].append(int(ids[row]))
                        out["score"].append(sum(bit(b) << s for s, b in enumerate(total)) + int(shift[q]))
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))

    found = left.groupBy("ib", "qb").cogroup(right.groupBy("ib", "qb")).applyInArrow(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score")


def search_sql(table: str = "embeddings") -> str:
    return f"""
WITH v AS (SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM {table}
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= {TOP}"""
