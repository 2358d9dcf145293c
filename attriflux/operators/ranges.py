"""Windows over keys of any size: rows are cut into ranges by (key, order), and what a range needs of the ones before is carried.

Ranges have about equal numbers of rows, whatever the keys, so a key that holds half
of all rows spreads over half of the ranges. Only keys at a range's borders
have rows in other ranges: at most two a range, so the tables of carried
states have a few rows per range and can be sent to all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attriflux.session import fresh_path

PART = "_part"


def cut_in_ranges(df: DataFrame, key: str, order: list[str], ranges: int | None = None) -> DataFrame:
    """The rows with the number of their range, ``_part``. Ranges follow each other in (key, order); equal rows share one.

    They are written, so that all later passes see the same borders; the
    borders come from a sample that Spark draws. Rows without a key are left out.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.filter(F.col(key).isNotNull()).repartitionByRange(ranges, key, *order).withColumn(PART, F.spark_partition_id())
    path = fresh_path(spark, "ranges")
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def border_rows(rows: DataFrame, key: str) -> DataFrame:
    """The rows of keys at the borders of their range: others are whole inside it."""
    ends = rows.groupBy(PART).agg(F.min(key).alias("_least"), F.max(key).alias("_most"))        # a row per range
    both = ends.select(F.col(PART).alias("_of"), F.explode(F.array_distinct(F.array("_least", "_most"))).alias("_border"))
    return rows.join(F.broadcast(both), (F.col(PART) == F.col("_of")) & (F.col(key) == F.col("_border")), "left_semi")


def with_last_rows(rows: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The rows, and for each range and border key the last ``n`` rows before it, as rows of the range with ``_carried`` true."""
    columns = [c for c in rows.columns if c != PART]
    border = border_rows(rows, key)
    backwards = Window.partitionBy(PART, key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    last = border.withColumn("_nth", F.row_number().over(backwards)).filter(F.col("_nth") <= n)
    ends = last.groupBy(PART, key).agg(F.array_sort(F.collect_list(F.struct((-F.col("_nth")).alias("_at"), F.struct(*columns).alias("row")))).alias("_ends"))
    # a part has one row of the key at least, so n parts back suffice
    before = Window.partitionBy(key).orderBy(PART)
    earlier = F.concat(*[F.coalesce(F.lag("_ends", i).over(before), F.slice("_ends", 1, 0)) for i in range(n, 0, -1)])
    carried = ends.withColumn("_before", earlier).filter(F.size("_before") > 0)
    carried = carried.withColumn("_before", F.slice("_before", F.greatest(F.lit(1), F.size("_before") - (n - 1)), n))
    carried = carried.select(PART, F.explode("_before.row").alias("row")).select(PART, "row.*", F.lit(True).alias("_carried"))
    return rows.withColumn("_carried", F.lit(False)).unionByName(carried)


def carried_paths(rows: DataFrame, key: str, order: list[str], ends: Column) -> DataFrame:
    """(range, key, _path0, _pieces): for border keys, the number of path ends before the range, and of paths that reach
    over a border (by number) how many rows lie in earlier ranges, how many there are in all, and whether the path ends anywhere.

    A path is a run of a key's rows up to one for which ``ends`` is true.
    """
    in_order = Window.partitionBy(PART, key).orderBy(*order)
    upto = in_order.rowsBetween(Window.unboundedPreceding, -1)
    local = border_rows(rows, key).withColumns({"_ends": F.coalesce(ends, F.lit(False)), "_before": F.count(F.when(ends, 1)).over(upto)})
    state = local.groupBy(PART, key).agg(
        F.count(F.when(F.col("_ends"), 1)).alias("_count"),
        F.count(F.when(F.col("_before") == 0, 1)).alias("_head"))
    # rows after the last end: those that have seen all ends
    tails = local.join(F.broadcast(state.select(F.col(PART).alias("_p"), F.col(key).alias("_k"), "_count")),
                       (F.col(PART) == F.col("_p")) & (F.col(key) == F.col("_k"))).filter(F.col("_before") == F.col("_count"))
    tails = tails.groupBy(PART, key).agg(F.count(F.lit(1)).alias("_tail"))
    state = state.join(tails, [PART, key], "left").fillna(0, ["_tail"])
    before = Window.partitionBy(key).orderBy(PART)
    state = state.withColumn("_path0", F.coalesce(F.sum("_count").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    piece = lambda path, n, done: F.struct(path.alias("path"), n.alias("n"), done.alias("done"))
    head = piece(F.col("_path0"), F.col("_head"), F.col("_count") > 0)
    tail = piece(F.col("_path0") + F.col("_count"), F.col("_tail"), F.lit(False))
    pieces = state.select(PART, key, "_path0", F.explode(F.when(F.col("_count") > 0, F.array(head, tail)).otherwise(F.array(head))).alias("p"))
    pieces = pieces.select(PART, key, "_path0", "p.*").filter("n > 0")
    path = Window.partitionBy(key, "path")
    pieces = pieces.withColumns({
        "earlier": F.coalesce(F.sum("n").over(path.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "all": F.sum("n").over(path), "finished": F.max("done").over(path)})
    found = pieces.groupBy(PART, key).agg(F.map_from_entries(F.collect_list(F.struct(
        "path", F.struct("earlier", "all", "finished")))).alias("_pieces"))
    return state.select(PART, key, "_path0").join(found, [PART, key], "left")
