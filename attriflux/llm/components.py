"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attriflux.llm.shared import stored


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("a") != F.col("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node passes its smallest neighbour (or itself) to its larger neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
    larger = both.filter(F.col("b") > F.col("a"))
    return _distinct(larger.join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node passes its smallest neighbour to its smaller neighbours and keeps it itself."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
    moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _distinct(moved.unionByName(least.select("a", F.col("least").alias("b"))))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of links (a, b): the root is the smallest node that is reachable.

    Alternates large stars and small stars until nothing changes. Each round is
    written to the shared folder, so plans stay short and lost executors cost
    one round. Sums of hashes of the edges tell whether a round changed them.
    """
    now, before = stored(_distinct(links.select("a", "b")), "links"), None
    while True:
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        now = stored(_small_star(_large_star(now)), "links")
