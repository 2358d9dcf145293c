"""Mixing sources to target weights by balanced sampling (cube method)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attriflux.llm.shared import numbered_copies, row_keys, sized, stored

WEIGHTS = (1, 2, 3)         # of the sources in order of their name, repeating
MOST_TIMES = 3.0            # a source's target, and a document's share in the mix, in times of its size
BLOCK_DOCS = 2048           # documents that take part in one walk
LANDING = 12                # documents that are decided together at the end of a source
GIANT = 0.002               # share of its source's target from which a document is settled before all others
NEAR = 1e-9                 # a probability so close to 0 or 1 has arrived


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: float = MOST_TIMES) -> DataFrame:
    """source, source_size, target of every source: all sizes shared by weight, at most ``most_times`` its size.

    What a source cannot take is shared again by weight among the others. The
    rounds need only sums over the sources, so their number may grow.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ordered = stored(totals.orderBy(F.col("source").asc_nulls_last()), "sources")
    ranked = ordered.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda r: (*r[0], r[1]))
    schema = T.StructType([*ordered.schema.fields, T.StructField("rank", T.LongType())])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stored(spark.createDataFrame(ranked, schema).withColumn("weight", weight), "source-ranks")
    most = F.col("source_size") * F.lit(most_times)
    whole = table.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > most
        count, taken, open_weight = table.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        if count == capped or not open_weight:
            break
        capped, level = count, (whole - (taken or 0.0)) / open_weight
    target = F.when(F.col("source_size") > 0, F.least(most, F.col("weight") * F.lit(level))).otherwise(F.lit(0.0))
    return table.withColumn("target", target)


def flight(sizes: np.ndarray, chances: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Walk chances to 0 or 1 while their sum and the sum of chance times size stay as they are.

    Three documents that are still open move along the null space of the two
    constraints until one of them arrives. Which way is a draw in proportion,
    so that every chance keeps its expectation. At most two stay open (or as
    many as have equal sizes can cancel out in pairs: one).
    """
    at = chances.tolist()
    size = [float(s) for s in sizes]
    draw = iter(draws.tolist() * 2)
    open_docs: list[int] = []
    for new in range(len(at)):
        if not NEAR < at[new] < 1 - NEAR:
            at[new] = float(round(at[new]))
            continue
        open_docs.append(new)
        while len(open_docs) >= 2:
            if len(open_docs) == 2:
                i, j = open_docs
                if size[i] != size[j]:
                    break
                moves = ((i, 1.0), (j, -1.0))
            else:
                i, j, k = open_docs
                a, b, c = size[j] - size[k], size[k] - size[i], size[i] - size[j]
                scale = max(abs(a), abs(b), abs(c))
                moves = ((i, a / scale), (j, b / scale), (k, c / scale)) if scale else ((i, 1.0), (j, -1.0))
            ahead = min((1 - at[d]) / m if m > 0 else at[d] / -m for d, m in moves if m)
            behind = min(at[d] / m if m > 0 else (1 - at[d]) / -m for d, m in moves if m)
            step = ahead if next(draw) * (ahead + behind) < behind else -behind
            for d, m in moves:
                at[d] += step * m
                if at[d] <= NEAR:
                    at[d] = 0.0
                elif at[d] >= 1 - NEAR:
                    at[d] = 1.0
            open_docs = [d for d in open_docs if 0.0 < at[d] < 1.0]
    return np.asarray(at)


def land(sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Settle the few that are open.

    They are decided again together with some that have arrived, spread over
    the sizes (``LANDING`` in all): the choice whose words come nearest to what
    is expected, and among near ones whose number of documents does.
    """
    open_docs = np.flatnonzero((chances > 0) & (chances < 1))
    if not len(open_docs):
        return chances
    closed = np.flatnonzero((chances == 0) | (chances == 1))
    closed = closed[np.argsort(sizes[closed], kind="stable")]
    room = min(len(closed), max(0, LANDING - len(open_docs)))
    some = np.concatenate([open_docs, closed[np.linspace(0, len(closed) - 1, room).astype(int)]]).astype(int)
    choices = (np.arange(1 << len(some))[:, None] >> np.arange(len(some)) & 1).astype(float)
    words = np.abs(choices @ sizes[some] - chances[some] @ sizes[some])
    docs = np.abs(choices.sum(1) - chances[some].sum())
    changed = np.abs(choices - chances[some]).sum(1)
    out = chances.copy()
    out[some] = choices[np.lexsort((changed, words + docs * sizes[some].mean() / 50))[0]]
    return out


def _walk(table: pa.Table) -> pa.Table:
    """One block, large documents first: flight, and the landing if the block holds all that is left of its source."""
    order = pc.sort_indices(table, sort_keys=[("size", "descending"), ("mixed", "ascending")])
    table = table.take(order)
    sizes = table["size"].to_numpy().astype(float)
    mixed = table["mixed"].to_numpy().view(np.uint64)
    draws = ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(float) / (1 << 53)
    at = flight(sizes, table["chance"].to_numpy(), draws)
    if table["blocks"][0].as_py() == 1:
        at = land(sizes, at)
    return table.set_column(table.schema.get_field_index("chance"), "chance", pa.array(at))


def _giants_first(rows: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """Settled documents above ``GIANT`` of their source's target, and the others with what that changes.

    No few small documents can make up for a large one at the end. So large
    ones are drawn among themselves, and the chances of all others of the
    source rise or fall by what the draw missed its words by. The draw misses
    by nothing on average, so chances stay what they are over all draws.
    There are at most 500 giants for each time that a source's target holds its size.
    """
    big = (F.col("size") > F.lit(GIANT) * F.col("target")) & (F.col("chance") > 0)
    giants = rows.filter(big).withColumns({"blocks": F.lit(1).cast("long"), "block": F.lit(0).cast("long")})
    if giants.isEmpty():
        return None, rows
    settled = stored(giants.groupBy("rank").applyInArrow(_walk, giants.schema), "mixing-giants").drop("blocks", "block")
    expected = giants.groupBy("rank").agg(F.sum(F.col("size") * F.col("chance")).alias("_expected"))
    drawn = settled.groupBy("rank").agg(F.sum(F.col("size") * F.col("chance")).alias("_drawn"))
    others = rows.filter(~big)
    words = others.groupBy("rank").agg(F.sum("size").alias("_words"))
    shift = expected.join(drawn, "rank").join(words, "rank").filter("_words > 0").select(
        F.col("rank").alias("_rank"), ((F.col("_expected") - F.col("_drawn")) / F.col("_words")).alias("_shift"))
    shift = stored(shift, "mixing-shift")                   # a row per source: written, so that its size is known to the join
    moved = others.join(shift, F.col("rank") == F.col("_rank"), "left")
    most = F.lit(MOST_TIMES)
    times = F.least(most, F.greatest(F.lit(0.0), F.col("whole") + F.col("chance") + F.coalesce("_shift", F.lit(0.0))))
    whole = F.floor(times + NEAR)
    moved = moved.withColumn("_times", times).withColumns({"whole": whole, "chance": F.greatest(F.lit(0.0), F.col("_times") - whole)})
    return settled, moved.select(rows.columns)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: float = MOST_TIMES, id_column: str = "doc_id",
        source_column: str = "source", text: str = "text", more: dict[str, Column] | None = None,
        block_docs: int = BLOCK_DOCS) -> DataFrame:
    """doc_id, ``more`` columns, source, size, source_size, target, times and taken of every row.

    A document's size is its number of words. A source's target divided by its
    size is how often each of its documents is expected: the whole part is
    taken as it is, the fraction is the chance of one more, drawn by the cube
    method with the source's words and documents as constraints. Documents of
    more than ``GIANT`` of the target are drawn first, and the others make up for what their draw misses. Blocks of
    about ``block_docs`` documents of a source (by hash) are walked first;
    what stays open, two of a block at most, is dealt and walked again, until
    one block of a source is left, which also lands. So a hot source takes more
    blocks, not larger ones. Order and draws come from hashes of the row, so
    reruns agree.

    Null sources are one source, sorted last. Null texts and texts without
    words have size 0 and take nothing. Null ids and repeated rows are drawn
    row by row; equal rows are numbered, so they spread over blocks like others. An empty table gives no rows.
    """
    spark = docs.sparkSession
    columns = {"doc_id": F.col(id_column), "source": F.col(source_column), **(more or {}),
               "mixed": F.xxhash64(F.col(id_column), F.col(text), F.col(source_column))}
    sizes = numbered_copies(stored(sized(docs, columns, text), "mixing-sizes"))
    drawn = F.when(F.col("copy") > 0, F.xxhash64("mixed", "copy")).otherwise(F.col("mixed"))
    sizes = stored(sizes.withColumn("mixed", drawn).drop("copy"), "mixing-copies")
    targets = source_targets(sizes, weights, most_times).select(
        F.col("source").alias("_source"), "source_size", "docs", "rank", "target")
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = sizes.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    whole = F.floor(factor + NEAR)
    rows = rows.withColumns({"whole": whole, "chance": F.greatest(F.lit(0.0), factor - whole), "left": F.col("docs"),
                             "round": F.lit(0)}).drop("docs")
    rows = stored(rows, "mixing-chances")
    settled, rows = _giants_first(rows)
    done: list[DataFrame] = [settled] if settled is not None else []
    while True:
        blocks = F.ceil(F.col("left") / block_docs)
        block = F.pmod(F.xxhash64("mixed", "size", "round"), F.col("blocks"))
        dealt = rows.withColumn("blocks", blocks).withColumn("block", block)
        walked = stored(dealt.groupBy("rank", "block").applyInArrow(_walk, dealt.schema), "mixing-walk")
        done.append(walked.filter((F.col("chance") == 0) | (F.col("chance") == 1)).select(rows.columns))
        still = walked.filter((F.col("chance") > 0) & (F.col("chance") < 1))
        left = still.groupBy("rank").agg(F.count(F.lit(1)).alias("left"))
        if still.isEmpty():
            break
        rows = still.drop("left", "blocks", "block").join(left, "rank").withColumn("round", F.col("round") + 1)
        rows = rows.select(*[c for c in dealt.columns if c not in ("blocks", "block")])
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    times = F.col("whole") + F.col("chance").cast("long")
    out = out.withColumn("times", times).withColumn("taken", F.col("size") * F.col("times"))
    return out.select("doc_id", *(more or {}), "source", "size", "source_size", "target", "times", "taken")


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: float = MOST_TIMES,
               id_column: str = "doc_id", source_column: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: every row as often as the mix takes it, all columns unchanged.

    Rows without words are taken no time, so null and empty texts go; equal rows
    share their draws; an empty table stays empty.
    """
    keys = row_keys(id_column, text)
    keys["k3"] = F.xxhash64(F.lit(0), F.col(source_column))
    drawn = mix(docs, weights, most_times, id_column, source_column, text, keys)
    drawn = drawn.groupBy(*keys).agg(F.sum("times").alias("times")).filter("times > 0")    # equal rows draw together
    rows = docs.select(F.struct(*docs.columns).alias("row"), *[c.alias(n) for n, c in keys.items()])
    rows = rows.join(drawn, list(keys))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("k1"))
    count = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    share = F.floor(F.col("times") / F.col("count")) + (F.col("nth") <= F.col("times") % F.col("count")).cast("long")
    rows = rows.withColumns({"nth": nth, "count": count}).withColumn("share", share).filter("share > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("share")))).select("row.*")
