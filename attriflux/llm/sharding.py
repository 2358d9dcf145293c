"""Sharding by vector bin packing: bytes, tokens and rows are balanced together."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attriflux.llm.shared import sized, stored, text_column

SHARDS = 40
ROW_BYTES = 16              # of every row besides its text
CELLS = 256                 # parts that a group of copies can be cut into
EQUAL_ROWS = 4096           # rows equal in id and text that are dealt together
WHOLE_SHARE = 0.5           # a group stays whole up to this share of a shard, in bytes, tokens and rows
LARGE_SHARE = 1 / 64        # units above this share of a shard are placed first, together
BLOCK_UNITS = 2048          # smaller units that are placed together
EMPHASIS = np.array([4.0, 1.0, 1.0])     # of bytes, tokens and rows in the dot product


def place(units: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shard of every unit, and what is left of the capacity (shards x bytes, tokens, rows).

    Units come in falling order. Each goes where the dot product of its
    sizes with what is left is highest, sizes being measured in the mean
    capacity of a shard; ties go to the lower shard.
    """
    left, scale = capacity.astype(float), np.maximum(capacity.mean(axis=0), 1e-9)
    weight = EMPHASIS / scale ** 2
    out = np.empty(len(units), np.int64)
    for i, unit in enumerate(units.astype(float)):
        shard = int(np.argmax(left @ (unit * weight)))
        out[i] = shard
        left[shard] -= unit
    return out, left


def _falling(units: np.ndarray, total: np.ndarray, names: list) -> list[int]:
    size = (units / np.maximum(total, 1e-9)).max(axis=1)
    return sorted(range(len(units)), key=lambda i: (-size[i], names[i]))


def _with_cells(rows: DataFrame) -> DataFrame:
    """The rows with a cell each: the first of equal rows by a hash of its id, the others in the cells that follow.

    Equal rows are the same in all that is returned, so they are counted and dealt out
    again from their count, many of them in ranges, so that no task has them all.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    few = counted.filter(F.col("n") <= EQUAL_ROWS).withColumn("from", F.lit(0).cast("long"))
    many = counted.filter(F.col("n") > EQUAL_ROWS).withColumn(
        "from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(EQUAL_ROWS).cast("long"))))
    each = few.unionByName(many.repartition("digest", "doc_id", "from"))
    last = F.least(F.col("n"), F.col("from") + EQUAL_ROWS) - 1
    each = each.withColumn("nth", F.explode(F.sequence("from", last)))
    first = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(CELLS))
    return each.select(*rows.columns, F.pmod(first + F.col("nth"), F.lit(CELLS)).cast("int").alias("cell"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text: str = "text",
                    block_units: int = BLOCK_UNITS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; the shards' bytes are near equal, tokens and rows near.

    Copies of a text form a group, which stays together unless it takes more
    than half a shard; then it is cut into cells by a hash of the id, and rows
    equal in id and text, which are counted first, take one cell after the other. Units
    (groups or cells) above 1/64 of a shard are fewer than 3 x 64 x shards, so
    they are placed in one go, largest first. All others are dealt by hash into
    blocks, each with its share of what the large ones leave of every shard.
    Slots count up inside a unit, units follow each other inside a block and
    blocks inside a shard; only sums of blocks are added up for that.

    Size is the text's bytes plus 16. Null texts have none and are copies of
    empty ones. Null ids and repeated rows are rows like others. An empty table
    gives no rows; further columns are not read.
    """
    value = text_column(text)
    found = sized(docs, {
        "doc_id": F.col(id_column), "bytes": F.octet_length(value) + F.lit(ROW_BYTES).cast("long"),
        "text_crc32": F.crc32(value.cast("binary")), "digest": F.unhex(F.md5(value.cast("binary"))),
    }, text).withColumnRenamed("size", "tokens")
    rows = stored(_with_cells(found), "shard-rows")
    totals = rows.agg(F.sum("bytes"), F.sum("tokens"), F.count(F.lit(1))).first()
    total = np.array([float(t or 0) for t in totals])
    share = total / shards

    cells = rows.groupBy("digest", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.first("bytes").alias("bytes"), F.first("tokens").alias("tokens"))
    groups = cells.groupBy("digest").agg(
        F.sum("n").alias("n"), F.first("bytes").alias("bytes"), F.first("tokens").alias("tokens"),
        F.array_sort(F.collect_list(F.struct("cell", "n"))).alias("cells"))         # at most CELLS of them
    rows_of = lambda n: F.array(F.col("bytes") * n, F.col("tokens") * n, n)
    above = lambda n, part: F.greatest(*[(F.col("bytes") * n > float(share[0] * part)), (F.col("tokens") * n > float(share[1] * part)),
                                         (n > float(share[2] * part))])
    whole = F.array(F.struct(F.col("n").alias("n"), F.col("cells").alias("cells")))
    apart = F.transform("cells", lambda c: F.struct(c["n"].alias("n"), F.array(c).alias("cells")))
    cut = above(F.col("n"), WHOLE_SHARE) & (F.col("n") > 1)
    units = groups.select("digest", "bytes", "tokens", F.explode(F.when(cut, apart).otherwise(whole)).alias("u"))
    units = units.select("digest", F.col("u.cells").alias("cells"), F.col("u.n").alias("n"), "bytes", "tokens")
    units = stored(units.withColumn("large", above(F.col("n"), LARGE_SHARE)).withColumn("sizes", rows_of(F.col("n"))), "shard-units")

    capacity = np.tile(share, (shards, 1))
    large = units.filter("large").select("digest", F.col("cells")[0]["cell"].alias("cell"), "sizes").collect()
    names = [(bytes(r.digest), r.cell) for r in large]
    sizes = np.array([r.sizes for r in large], float).reshape(-1, 3)
    order = _falling(sizes, total, names)
    chosen, left = place(sizes[order], capacity)
    small = units.filter("NOT large")
    counted = small.agg(F.count(F.lit(1)), *[F.sum(F.col("sizes")[i]) for i in range(3)]).first()
    blocks = max(1, -(-counted[0] // block_units))
    rest = np.maximum(left, 0.0)
    rest = rest / np.maximum(rest.sum(axis=0), 1e-9)         # share of every shard in the small units

    of_large = {(*names[i], 0): int(s) for i, s in zip(order, chosen)}
    name = lambda: F.pmod(F.xxhash64("digest", F.col("cells")[0]["cell"]), F.lit(blocks))
    dealt = units.withColumn("block", F.when(F.col("large"), F.lit(-1).cast("long") - F.pmod(F.xxhash64("digest"), F.lit(blocks)))
                             .otherwise(name()))
    schema = "digest binary, cell int, n long, block long, shard int, start long"

    def assign(table: pa.Table) -> pa.Table:
        digests, parts = table["digest"].to_pylist(), table["cells"].to_pylist()
        names = [(d, p[0]["cell"]) for d, p in zip(digests, parts)]
        units = np.array(table["sizes"].to_pylist(), float).reshape(-1, 3)
        own = units.sum(axis=0)
        order = _falling(units, own, names)
        if table["large"][0].as_py():
            shard_of = [of_large[(*names[i], 0)] for i in order]
        else:
            shard_of, _ = place(units[order], rest * own)
        filled = [0] * shards
        out = {"digest": [], "cell": [], "n": [], "block": [], "shard": [], "start": []}
        block = table["block"][0].as_py()
        for i, shard in zip(order, shard_of):
            for part in parts[i]:
                for key, item in (("digest", digests[i]), ("cell", part["cell"]), ("n", part["n"]), ("block", block),
                                  ("shard", int(shard)), ("start", filled[shard])):
                    out[key].append(item)
                filled[shard] += part["n"]
        return pa.table(out, schema=pa.schema([
            ("digest", pa.binary()), ("cell", pa.int32()), ("n", pa.int64()), ("block", pa.int64()),
            ("shard", pa.int32()), ("start", pa.int64())]))

    placed = stored(dealt.groupBy("block").applyInArrow(assign, schema), "shard-places")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks_of = placed.groupBy("shard", "block").agg(F.sum("n").alias("rows"))
    blocks_of = blocks_of.select("shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    placed = placed.join(blocks_of, ["shard", "block"])
    inside = F.row_number().over(Window.partitionBy("digest", "cell").orderBy("doc_id"))
    joined = rows.join(placed.select("digest", "cell", "shard", (F.col("offset") + F.col("start")).alias("first")), ["digest", "cell"])
    return joined.select("doc_id", F.col("bytes").alias("size"), "tokens", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         (F.col("first") + inside - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
