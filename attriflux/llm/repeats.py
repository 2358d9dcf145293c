"""Removal of long byte strings that occur twice, by prefix-free parsing.

Triggers of a rolling hash cut texts into phrases. A string of ``LENGTH`` bytes
is then known by a suffix of the phrase that ends at a trigger (the dictionary's
part) and by what follows the trigger (the parse's part). Places are ordered
together by names of equal content, not by sorted arrays: only equality matters
for removal, names can be given by one shuffle each, and no key needs all its
places in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attriflux.llm.shared import RangeHashes, row_keys, row_of, stored, text_buffer, text_chunks, text_column

LENGTH = 400                # bytes of a string that is removed if it starts at two places
GRAM = 16                   # bytes of the rolling hash
REACH = 128                 # a trigger's hash is least in a run of so many neighbouring hashes
CORE = 256                  # bytes around a trigger that all strings of the trigger share
PART = 16                   # neighbouring starts that are named together in the second round
_FIRST = REACH - 1          # least distance of a string's start before its trigger


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """32-bit hash of the ``GRAM`` bytes from every position."""
    values = np.random.Generator(np.random.PCG64(11)).integers(1 << 63, dtype=np.uint64, size=256)
    h = values[data]
    step = 1
    while step < GRAM:
        h = h[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * step) + h[step:]
        h ^= h >> np.uint64(31)
        step *= 2
    return (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """The best of every ``width`` (a power of two) neighbours."""
    step = 1
    while step < width:
        values = best(values[:-step], values[step:])
        step *= 2
    return values


def triggers(data: np.ndarray) -> np.ndarray:
    """Positions whose hash is the least of some ``REACH`` neighbours; all of equals. Never more than REACH apart."""
    h = rolling_hashes(data)
    if len(h) < 2 * REACH - 1:
        return np.zeros(0, np.int64)
    highest = _sliding(_sliding(h, REACH, np.minimum), REACH, np.maximum)       # of the runs that hold a position
    return np.flatnonzero(highest == h[REACH - 1:REACH - 1 + len(highest)]) + REACH - 1


def string_starts(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigger, first start, last start and row of all triggers to which strings belong.

    A string belongs to its first trigger at least ``REACH - 1`` bytes after its
    start. Whether that is a trigger depends on bytes of the string only, so
    equal strings have it at the same distance.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none
    at = triggers(data)
    row = row_of(at, borders)
    begin, end = borders[row], borders[row + 1]
    inside = (at - _FIRST >= begin) & (at + REACH - 1 + GRAM <= end)
    at, row, begin, end = at[inside], row[inside], begin[inside], end[inside]
    before = np.full(len(at), -1)
    if len(at):
        before[1:] = np.where(row[1:] == row[:-1], at[:-1], -1)
    first = np.maximum(np.maximum(begin, at - 2 * _FIRST), np.where(before < 0, 0, before - _FIRST + 1))
    last = np.minimum(at - _FIRST, end - LENGTH)
    real = first <= last
    return at[real], first[real], last[real], row[real]


def _bounded(names: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Names that also tell between which distances the starts lie."""
    return (names ^ (near * 1009 + far).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def parse(docs: DataFrame, text: str, keys: dict[str, Column]) -> DataFrame:
    """A row per trigger: names of its core and of all that its strings cover, the row's key, and the starts."""
    kept = docs.select(keys["k1"].alias("k1"), text_column(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("k1").to_numpy()
            for begin, end, data, borders in text_chunks(batch.column("text")):
                at, first, last, row = string_starts(data, borders)
                if not len(at):
                    continue
                core = RangeHashes(data, 1)(at - _FIRST, at - _FIRST + CORE).view(np.int64)
                whole = _bounded(RangeHashes(data, 2)(first, last + LENGTH), at - last, at - first)
                base = borders[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core), pa.array(whole), pa.array(keys[begin:end][row]),
                     pa.array((borders[row + 1] - base).astype(np.int32)), pa.array((at - base).astype(np.int32)),
                     pa.array((at - first).astype(np.int16)), pa.array((at - last).astype(np.int16))],
                    ["core", "whole", "k1", "n", "at", "far", "near"])

    return kept.mapInArrow(cut, "core long, whole long, k1 long, n int, at int, far short, near short")


def _name_parts(data: np.ndarray, at: np.ndarray, far: np.ndarray, near: np.ndarray) -> pa.RecordBatch | None:
    """For each part of a trigger's starts: names of what its strings share, of what they cover, and of each string."""
    names = [RangeHashes(data, seed) for seed in (3, 4, 5)]
    rows = []
    for part in range(REACH // PART):
        low, high = _FIRST + part * PART, _FIRST + part * PART + PART - 1
        own = np.flatnonzero((far >= low) & (near <= high))
        if not len(own):
            continue
        a, f, e = at[own], np.minimum(far[own], high).astype(np.int64), np.maximum(near[own], low).astype(np.int64)
        core = names[0](a - low, a - high + LENGTH).view(np.int64) ^ part
        whole = _bounded(names[1](a - f, a - e + LENGTH), e, f)
        count = f - e + 1
        start = np.repeat(a - f, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        rows.append((core, whole, a - f, a - e, names[2](start, start + LENGTH).view(np.int64), count))
    if not rows:
        return None
    core, whole, first, last, each, count = (np.concatenate(c) for c in zip(*rows))
    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(core), pa.array(whole), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(each))], ["core", "whole", "first", "last", "names"])


def parts(docs: DataFrame, text: str, keys: dict[str, Column], places: DataFrame) -> DataFrame:
    """Names of the parts of the places (k1, n, at, far, near), from the texts they lie in."""
    wanted = places.groupBy("k1", "n").agg(*[F.collect_list(c).alias(c) for c in ("at", "far", "near")])
    texts = docs.select(keys["k1"].alias("k1"), text_column(text).alias("text"))
    # rows that are equal in id and text share their key: one of them is enough, the others are counted already
    rows = texts.withColumn("n", F.octet_length("text")).join(wanted.hint("shuffle_hash"), ["k1", "n"])
    rows = rows.select("k1", "n", "text", F.arrays_zip("at", "far", "near").alias("places")).select(
        "k1", "n", "text", F.col("places.at").alias("at"), F.col("places.far").alias("far"), F.col("places.near").alias("near"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = text_buffer(batch.column("text"))
            k1, n = batch.column("k1").to_pylist(), batch.column("n").to_pylist()
            for i in range(batch.num_rows):
                columns = [np.array(batch.column(c)[i].as_py(), np.int64) for c in ("at", "far", "near")]
                found = _name_parts(data[borders[i]:borders[i + 1]], *columns)
                if found is not None:
                    rows = found.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k1[i]] * rows, pa.int64()), pa.array([n[i]] * rows, pa.int32()), *found.columns],
                        ["k1", "n", *found.schema.names])

    return rows.mapInArrow(name, "k1 long, n int, core long, whole long, first int, last int, names array<long>")


def _sort_out(rows: DataFrame) -> DataFrame:
    """Rows whose core occurs twice, and whether what they cover differs between them (``mixed``)."""
    twice = rows.groupBy("core").agg(F.count(F.lit(1)).alias("_n"), F.min("whole").alias("_a"), F.max("whole").alias("_b"))
    twice = twice.filter("_n >= 2").select("core", (F.col("_a") != F.col("_b")).alias("mixed"))
    # written, so that the join reads two exchanges and Spark can split a core that repeats very often
    return rows.join(stored(twice, "repeated-cores"), "core")


def repeated_starts(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """k1, n, first, last: starts of strings that also start elsewhere, by row key.

    Three rounds, each on what the round before left open. A trigger whose core
    is unique has no repeated string. If all that covers its strings is the same
    at two places, all of them are repeated. Else the starts are taken in parts
    of ``PART``, and last one by one. What occurs more than once is carried on
    by one representative.
    """
    keys = row_keys(id_column, text)
    parsed = stored(parse(docs, text, keys), "phrases")
    open_rows = stored(_sort_out(parsed), "phrases-twice")
    starts = lambda rows: rows.select("k1", "n", (F.col("at") - F.col("far")).cast("int").alias("first"),
                                      (F.col("at") - F.col("near")).cast("int").alias("last"))
    same = open_rows.filter("NOT mixed")
    mixed = open_rows.filter("mixed")
    one = F.min(F.struct("k1", "n", "at", "far", "near"))
    kinds = stored(mixed.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("m"), one.alias("one")), "phrase-kinds")
    copied = mixed.join(kinds.filter("m >= 2").select("core", "whole"), ["core", "whole"])

    named = stored(parts(docs, text, keys, kinds.select("one.*").distinct()).distinct(), "phrase-parts")
    second = stored(_sort_out(named), "phrase-parts-twice")
    single = second.filter("mixed").select("k1", "n", "core", "first", F.posexplode("names").alias("i", "name"))
    twice = single.groupBy("core", "name").agg(F.count(F.lit(1)).alias("c")).filter("c >= 2").select("core", "name")
    single = single.join(stored(twice, "repeated-strings"), ["core", "name"]).select(
        "k1", "n", (F.col("first") + F.col("i")).alias("first"), (F.col("first") + F.col("i")).alias("last"))
    return starts(same).unionByName(starts(copied)).unionByName(
        second.filter("NOT mixed").select("k1", "n", "first", "last")).unionByName(single)


def covered(starts: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the strings from these starts cover."""
    out: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in starts or ()):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + LENGTH)
        else:
            out.append([first, last + LENGTH])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans of every row.

    Every byte that lies in a string of ``LENGTH`` bytes which also starts
    elsewhere, in the same text or another, is removed; texts are judged as
    they came. Null texts count as empty. Repeated rows count as texts of their
    own, so they remove each other. Null ids keep their row; further columns are
    not read. An empty table gives no rows.
    """
    keys = row_keys(id_column, text)
    spans = repeated_starts(docs, id_column, text).groupBy("k1", "n").agg(
        F.collect_set(F.struct("first", "last")).alias("starts"))      # at most the starts of one text
    rows = docs.select(F.col(id_column).alias("doc_id"), keys["k1"].alias("k1"), text_column(text).alias("text"))
    rows = rows.withColumn("n", F.octet_length("text")).join(spans.hint("shuffle_hash"), ["k1", "n"], "left")
    rows = rows.select("doc_id", "text", "starts")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = text_buffer(batch.column("text"))
            raw = data.tobytes()
            sizes, removed, counts, hashes, runs = [], [], [], [], []
            for i, starts in enumerate(batch.column("starts").to_pylist()):
                own, at, digest = raw[borders[i]:borders[i + 1]], 0, hashlib.sha256()
                gone = covered(starts)
                for a, b in gone:
                    digest.update(own[at:a])
                    at = b
                digest.update(own[at:])
                sizes.append(len(own))
                removed.append(sum(b - a for a, b in gone))
                counts.append(len(gone))
                hashes.append(digest.hexdigest())
                runs.append([{"start": a, "end": b} for a, b in gone])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (sizes, removed, counts)),
                 pa.array(hashes, pa.string()), pa.array(runs, span)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return rows.mapInArrow(remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                   "spans array<struct<start:long,end:long>>")
