"""What the operators share: tables in the shared folder, words of Arrow text columns, hashes of byte ranges."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.session import fresh_path

SPACES = np.zeros(256, bool)
SPACES[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
COPIES_RUN = 1 << 16     # copies of a row that are listed together
CHUNK_BYTES = 2 << 20    # texts are handled together up to this size, to keep the arrays over their bytes small


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: later plans start there, also if an executor is lost."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_column(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_keys(id_column: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """Two hashes that name a row by its id and its text, never null. Only rows equal in both share them."""
    value = text_column(text)
    return {"k1": F.xxhash64(F.col(id_column), value), "k2": F.xxhash64(F.crc32(value.cast("binary")), F.length(value))}


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column without nulls, and the borders of its rows in them."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, borders, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(borders, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of up to ``limit`` bytes (or one longer row): first row, end row, bytes, borders."""
    data, borders = text_buffer(column)
    first, rows = 0, len(borders) - 1
    while first < rows:
        end = int(np.searchsorted(borders, borders[first] + limit, "right")) - 1
        end = min(rows, max(first + 1, end))
        yield first, end, data[borders[first]:borders[end]], borders[first:end + 1] - borders[first]
        first = end


def sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring borders."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[borders[1:]] - total[borders[:-1]]


def word_bounds(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that are no white space; a border of rows ends a word."""
    solid = ~SPACES[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = borders[(borders > 0) & (borders < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def row_of(positions: np.ndarray, borders: np.ndarray) -> np.ndarray:
    return np.searchsorted(borders, positions, "right") - 1


def word_counts(column: pa.Array) -> np.ndarray:
    """Number of words of every text."""
    counts = np.zeros(len(column), np.int64)
    for first, end, data, borders in text_chunks(column):
        starts, _ = word_bounds(data, borders)
        counts[first:end] = np.bincount(row_of(starts, borders), minlength=end - first)
    return counts


def numbered_copies(rows: DataFrame) -> DataFrame:
    """The rows with ``copy``: 0, 1, 2, ... among rows that are equal in all columns.

    Equal rows are counted, which reduces them before they are moved, and
    listed again in runs of ``COPIES_RUN``, so that no task lists all copies of a row. Which of equal rows has which number does not matter.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    runs = counted.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES_RUN).cast("long"))))
    runs = runs.withColumn("_run", F.floor(F.col("_from") / COPIES_RUN))
    many = runs.filter("_n > 1").repartition(F.xxhash64(*rows.columns, "_run"))
    last = F.least(F.col("_n"), F.col("_from") + COPIES_RUN) - 1
    listed = many.withColumn("copy", F.explode(F.sequence(F.col("_from"), last)))
    once = runs.filter("_n = 1").withColumn("copy", F.lit(0).cast("long"))
    return once.unionByName(listed).select(*rows.columns, "copy")


def totals(rows: DataFrame, size: int, of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sums over all rows of the ``size`` numbers that ``of`` makes of a batch. A task gives ``size`` numbers, however many rows it has."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["at", "total"])

    found = rows.mapInArrow(partial, "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    out = np.zeros(size)
    for r in found.collect():                               # ``size`` rows
        out[r["at"]] = r["total"]
    return out


class RangeHashes:
    """64-bit hashes of byte ranges from one running sum.

    Ranges of equal bytes have equal hashes. Unequal ranges nearly always
    differ, but whoever needs certainty compares the bytes as well.
    """

    _base = np.uint64(0x9E3779B97F4A7C15)
    _inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray, seed: int = 1):
        cls = RangeHashes
        if len(cls._powers) <= len(data):
            size = max(CHUNK_BYTES, len(data)) + 1
            cls._powers = np.concatenate([np.ones(1, np.uint64), np.full(size, cls._base)]).cumprod(dtype=np.uint64)
            cls._inverses = np.concatenate([np.ones(1, np.uint64), np.full(size, cls._inverse)]).cumprod(dtype=np.uint64)
        values = np.random.Generator(np.random.PCG64(seed)).integers(1 << 63, dtype=np.uint64, size=256)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * cls._powers[:len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = (self.sums[ends] - self.sums[starts]) * RangeHashes._inverses[starts]
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))


def sized(docs: DataFrame, columns: dict[str, Column], text: str = "text") -> DataFrame:
    """The columns, and the number of words of the text as ``size``. A null text has none."""
    kept = docs.select(*[c.alias(n) for n, c in columns.items()], text_column(text).alias("_text"))
    schema = kept.drop("_text").withColumn("size", F.lit(0).cast("long")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            rest = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(word_counts(batch.column(at)))], [*names, "size"])

    return kept.mapInArrow(count, schema)
