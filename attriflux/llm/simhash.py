"""SimHash near-duplicates by signatures with one wildcard bit."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attriflux.llm.components import components
from attriflux.llm.shared import row_keys, stored, text_column

SHINGLE = 3                 # words of a shingle of the contract's fingerprints
SEED = 42
MOST_BITS = 3               # fingerprints with at most so many differing bits are linked
RUN = 256                   # members of a signature that are compared with each other; larger ones are refined



def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Majority bits of the hashes of all shingles, as a signed 64-bit number. No words: 0."""
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = np.frombuffer(b"".join(hashes[at:at + 8192]), np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text: str = "text",
                 more: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, ``more`` columns, fp (signed) and n_words of every text, A-Z lower-cased. Null texts have no words."""
    kept = docs.select(F.col(id_column).alias("doc_id"), *[c.alias(n) for n, c in (more or {}).items()],
                       text_column(text).alias("text"))
    names = kept.columns[:-1]
    schema = kept.drop("text").withColumns({"fp": F.lit(0).cast("long"), "n_words": F.lit(0).cast("long")}).schema

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = [], []
            for value in batch.column("text").cast(pa.large_binary()):
                words = value.as_py().lower().split()       # bytes: A-Z and ASCII white space only
                found.append(fingerprint(words, shingle))
                counts.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(found, pa.int64()), pa.array(counts, pa.int64())],
                [*names, "fp", "n_words"])

    return kept.mapInArrow(hashed, schema)


def signatures(fps: DataFrame) -> DataFrame:
    """64 signatures per fingerprint: each half with one of its 32 bits blanked.

    Of two halves one differs by at most one bit if all differ by at most
    three, so linked fingerprints share a signature. A signature's number
    holds the half, the wildcard's place and the 31 other bits.
    """
    each = F.expr(
        "transform(sequence(0, 63), i -> (cast(i as bigint) << 32) | "
        "(((CASE WHEN i < 32 THEN shiftrightunsigned(fp, 32) ELSE fp END) & 4294967295L) & ~(1L << (i % 32))))")
    return fps.select("fp", F.explode(each).alias("key"))


def refined(rows: DataFrame) -> DataFrame:
    """Signatures of the other half's halves, below a signature: 32 each, by the same argument."""
    other = "(CASE WHEN (key >> 37) = 0 THEN fp ELSE shiftrightunsigned(fp, 32) END)"
    each = F.expr(
        f"transform(sequence(0, 31), j -> (key << 21) | (cast(j as bigint) << 16) | "
        f"((CASE WHEN j < 16 THEN {other} >> 16 ELSE {other} END) & 65535L & ~(1L << (j % 16))))")
    return rows.select("fp", F.explode(each).alias("key"))


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the same components, one per node: to the component's smallest node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[one], label[two])
        new = label.copy()
        np.minimum.at(new, one, low)
        np.minimum.at(new, two, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _close_pairs(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of equal keys (sorted) that differ by at most ``MOST_BITS`` bits, compared at every distance."""
    left, right, at = [], [], np.arange(len(key))
    for step in range(1, len(key)):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        close = at[np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= MOST_BITS]
        left.append(fp[close])
        right.append(fp[close + step])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _masked_links(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one large run: members that are equal after blanking three of the bits in which the run varies."""
    base = fp[0]
    varying = int(np.bitwise_or.reduce((fp ^ base).view(np.uint64)))
    places = [1 << i for i in range(64) if varying >> i & 1]
    left, right = [], []
    for blank in combinations(places, min(MOST_BITS, len(places))):
        masked = fp.view(np.uint64) & np.uint64(~sum(blank) & (1 << 64) - 1)
        order = np.argsort(masked, kind="stable")
        same = np.flatnonzero(masked[order][1:] == masked[order][:-1])
        left.append(fp[order[same]])
        right.append(fp[order[same + 1]])
        if len(left) >= 64:
            a, b = _stars(np.concatenate(left), np.concatenate(right))
            left, right = [a], [b]
    return np.concatenate(left), np.concatenate(right)


def _linker(last: bool):
    """Turns sorted (key, fp) rows into links; runs above ``RUN`` are passed on, or masked if this is the last pass."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)

        def rows(a, b, large):
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(np.full(len(a), large))], ["a", "b", "large"])

        def complete(key, fp):
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else none
            size = np.diff(np.append(start, len(key)))
            member = np.repeat(size, size)
            some = (member > 1) & (member <= RUN)
            a, b = _close_pairs(key[some], fp[some])
            for at, n in zip(start[size > RUN], size[size > RUN]):
                if last:
                    x, y = _masked_links(fp[at:at + n])
                    a, b = np.concatenate([a, x]), np.concatenate([b, y])
                else:
                    yield rows(fp[at:at + n], key[at:at + n], True)
            if len(a):
                yield rows(*_stars(a, b), False)

        held_key, held_fp, passed = none, none, None
        for batch in batches:
            key = np.concatenate([held_key, batch.column("key").to_numpy()])
            fp = np.concatenate([held_fp, batch.column("fp").to_numpy()])
            if passed is not None:                      # the rest of a run that is already known to be large
                end = int(np.searchsorted(key, passed, "right"))
                if end:
                    yield rows(fp[:end], key[:end], True)
                    key, fp = key[end:], fp[end:]
                if len(key):
                    passed = None
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            yield from complete(key[:cut], fp[:cut])
            held_key, held_fp = key[cut:], fp[cut:]
            if not last and len(held_key) > RUN:
                passed = held_key[0]
                yield rows(held_fp, held_key, True)
                held_key, held_fp = none, none
        yield from complete(held_key, held_fp)

    return links


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(a, b): links of the same components as all pairs of distinct fingerprints within ``MOST_BITS`` bits.

    Fingerprints meet on signatures (an equality join of the index with
    itself, done by dealing and sorting), and every candidate pair is verified. A task compares the members of a
    signature while it streams through them and gives out at most one link per
    member. A signature with more than ``RUN`` members is dealt again by the
    refined signatures below it, which leave at most 18 bits to differ; runs
    that are still larger are linked by blanking each three of these bits. So
    no member is left out and no run is compared all against all beyond ``RUN``.
    """
    schema = "a long, b long, large boolean"
    dealt = signatures(fps.select("fp").distinct()).repartition("key").sortWithinPartitions("key", "fp")
    first = stored(dealt.select("key", "fp").mapInArrow(_linker(False), schema), "signature-links")
    large = refined(first.filter("large").select(F.col("a").alias("fp"), F.col("b").alias("key")))
    large = large.repartition("key").sortWithinPartitions("key", "fp").select("key", "fp")
    return first.filter("NOT large").select("a", "b").unionByName(
        large.mapInArrow(_linker(True), schema).select("a", "b"))


def _with_components(hashed: DataFrame) -> DataFrame:
    groups = hashed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(groups))
    rooted = groups.join(roots, F.col("fp") == F.col("node"), "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(named, "root").select("fp", "root", "component_id")
    return hashed.join(labels, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text: str = "text",
                    more: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, ``more`` columns, fp, n_words, root (a fingerprint that names the component) and component_id of every row.

    component_id is the smallest doc_id reachable over links.

    Texts of equal fingerprints meet first, so a group of copies counts once
    however large it is. Null texts have fingerprint 0 like texts without
    words. Null ids keep their row; they never name a component that has
    another id. Further columns of the table are not read. An empty table
    gives no rows.
    """
    hashed = stored(fingerprints(docs, shingle, id_column, text, more), "fingerprints")
    return _with_components(hashed).select("doc_id", *(more or {}), "fp", "n_words", "root", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``near_duplicates``, all columns unchanged: the smallest doc_id, then hashes of the row.

    Rows without id stay only if their whole component has none. Null texts and
    texts without words are one component. Rows equal in id and text count as
    copies, of which one stays. An empty table stays empty.

    Rows are found again by two hashes of id and text. Rows whose hashes no other row has
    go through one exchange; the few that repeat are taken apart from the start, and equal
    rows are reduced before they are moved.
    """
    keys = row_keys(id_column, text)
    found = stored(near_duplicates(docs, shingle, id_column, text, keys), "components")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    by_text = found.groupBy("root", "fp").agg(F.min(order).alias("first"))
    first = by_text.groupBy("root").agg(F.min("first").alias("first")).select("first.k1", "first.k2")
    repeated = found.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k1", "k2", F.lit(True).alias("repeats"))
    first = stored(first.join(repeated, ["k1", "k2"], "left").fillna(False, ["repeats"]), "first-of-group")
    rows = docs.select(F.struct(*docs.columns).alias("row"), *[c.alias(n) for n, c in keys.items()])
    once = rows.join(first.filter("NOT repeats").select("k1", "k2"), ["k1", "k2"], "left_semi")
    again = rows.join(first.filter("repeats").select("k1", "k2"), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return once.select("row.*").unionByName(again.select("row.*"))
