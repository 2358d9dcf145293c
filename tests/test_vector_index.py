import numpy as np
import pytest
from pyspark.sql import functions as F

from attriflux.operators import retrieval as re_
from attriflux.operators import vector_index as vi
from attriflux.sources.derived import table


def brute_force(docs, queries, k):
    ids, matrix = np.array([d for d, _ in docs]), np.array([v for _, v in docs])
    out = {}
    for q, vector in queries:
        distance = np.round(((matrix - np.array(vector)) ** 2).sum(axis=1), 9)
        out[q] = [(int(ids[i]), distance[i]) for i in np.lexsort((ids, distance))[:k]]
    return out


def found(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.doc_id, r.distance))
    return out


@pytest.fixture(scope="module")
def clustered():
    """Forty clusters, and one vector that a third of all rows share."""
    draws = np.random.default_rng(7)
    centres = draws.normal(size=(40, 24)) * 6
    rows = [(i, (centres[i % 40] + draws.normal(size=24)).tolist()) for i in range(4000)]
    rows += [(10000 + i, rows[5][1]) for i in range(2000)]
    queries = [(i, (centres[i % 40] + draws.normal(size=24)).tolist()) for i in range(60)] + [(900, [100.0] * 24), (901, rows[5][1])]
    return rows, queries


@pytest.fixture(scope="module")
def index(spark, clustered, tmp_path_factory):
    rows, _ = clustered
    docs = spark.createDataFrame([*rows, (99999, None)], "id long, vec array<double>").withColumn("kind", F.col("id") % 3)
    path = str(tmp_path_factory.mktemp("index"))
    docs.repartition(6).write.parquet(f"{path}/rows")
    return vi.write_index(spark.read.parquet(f"{path}/rows"), f"{path}/index", buckets=64)


def asked(spark, queries):
    return spark.createDataFrame(queries, "query_id long, vec array<double>").repartition(5)


def test_search_equals_brute_force_and_reads_little(spark, clustered, index):
    rows, queries = clustered
    hits, reads = vi.search_index(spark, index, asked(spark, queries), 4)
    assert found(hits) == brute_force(rows, queries, 4)
    shares = {r.query_id: r.share for r in vi.share_read(spark, index, reads).collect()}
    usual = [shares[q] for q, _ in queries if q < 100 and q % 40 != 5]
    assert len(shares) == len(queries) and np.mean(usual) < 0.1


def test_folders_are_pruned(spark, index):
    plan = vi.read_index(spark, index).filter(F.col("bucket").isin(3, 70))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]


def test_condition_and_fewer_rows_than_asked_for(spark, clustered, index):
    rows, queries = clustered
    some = [(i, v) for i, v in rows if i % 3 == 1]
    hits, _ = vi.search_index(spark, index, asked(spark, queries), 3, F.col("kind") == 1)
    assert found(hits) == brute_force(some, queries, 3)
    two = [(i, v) for i, v in rows if i in (17, 400)]
    hits, _ = vi.search_index(spark, index, asked(spark, queries[:4]), 5, F.col("id").isin(17, 400))
    assert found(hits) == brute_force(two, queries[:4], 5)


def test_every_row_is_indexed(spark, clustered, index):
    rows, _ = clustered
    docs = vi.read_index(spark, index)
    assert docs.count() == len(rows) + 1 and docs.filter("bucket = -1").count() == 1
    assert sum(r.n for r in spark.read.parquet(f"{index}/ranges").collect()) == len(rows)


def test_bounds_are_never_above_a_distance(clustered):
    rows, queries = clustered
    vectors = np.array([v for _, v in rows])
    layout = vi.Layout.fit(vectors[:500], 32, 5)
    along, over, bucket = layout.placed(vectors)
    names = np.unique(bucket)
    pick = lambda f: np.array([[f(np.column_stack([along, over])[bucket == b][:, i]) for i in range(6)] for b in names])
    ranges = vi.Ranges(names, np.bincount(bucket)[names], pick(np.min), pick(np.max))
    bounds = ranges.bounds(layout, np.array([q for _, q in queries]))
    for i, (_, q) in enumerate(queries):
        distance = ((vectors - np.array(q)) ** 2).sum(axis=1)
        for j, b in enumerate(names):
            assert bounds[i, j] <= distance[bucket == b].min() + 1e-7


def test_small_and_empty_indexes(spark, tmp_path):
    docs = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "id long, vec array<double>")
    queries = [(0, [0.0, 0.0])]
    path = vi.write_index(docs, str(tmp_path / "two"))
    assert found(vi.search_index(spark, path, asked(spark, queries), 5)[0]) == {0: [(1, 5.0), (2, 5.0)]}
    assert vi.search_index(spark, path, asked(spark, queries).limit(0), 5)[0].count() == 0
    path = vi.write_index(docs.limit(0), str(tmp_path / "none"))
    assert vi.search_index(spark, path, asked(spark, queries), 5)[0].count() == 0


def test_many_queries_are_one_plan(spark, folder):
    """Thousands of queries against all rows, without anything passing through the driver."""
    items = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    queries = items.crossJoin(spark.range(13).withColumnRenamed("id", "copy")).select(
        (F.col("id") * 13 + F.col("copy")).alias("query_id"), F.transform("vec", lambda c: c + F.col("copy") * 0.01).alias("vec"))
    assert queries.count() > 5000
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    hits = re_.query_topk(items.repartition(4), queries, 3, block=700)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    rows = [(r.id, list(r.vec)) for r in items.collect()]
    some = [(r.query_id, list(r.vec)) for r in queries.filter("query_id % 97 = 0").collect()]
    mine = found(hits)
    assert len(mine) == queries.count() and {q: mine[q] for q, _ in some} == brute_force(rows, some, 3)


def test_vectors_of_other_lengths_are_an_error(spark):
    docs = spark.createDataFrame([(1, [1.0, 2.0])], "id long, vec array<double>")
    with pytest.raises(Exception, match="entries"):
        re_.query_topk(docs, spark.createDataFrame([(1, [1.0])], "query_id long, vec array<double>"), 1).collect()


def test_conditions_skip_parts_of_files(spark, tmp_path):
    """One bucket of 60,000 rows in one file, sorted by kind: a condition on kind reads a part of it."""
    rows = spark.range(0, 60000, 1, 4).select(
        "id", F.array(F.lit(1.0), F.lit(2.0)).alias("vec"), F.struct((F.col("id") % 30).alias("kind"), F.lit("x").alias("name")).alias("metadata"))
    rows.write.parquet(f"{tmp_path}/rows")
    path = vi.write_index(spark.read.parquet(f"{tmp_path}/rows"), f"{tmp_path}/index", buckets=1, order_by=["metadata.kind"])
    docs = vi.read_index(spark, path).filter(F.col("metadata.kind") == 7)
    out = docs.select("id")
    assert out.count() == 2000
    plan = out._jdf.queryExecution().executedPlan()
    assert "EqualTo(metadata.kind,7)" in plan.toString()
    rows_read = spark.read.parquet(f"{path}/documents").filter(F.col("metadata.kind") == 7).select("id")._jdf.queryExecution()
    rows_read.toRdd().count()
    scans = rows_read.executedPlan().collectLeaves()
    read = scans.apply(0).metrics().apply("numOutputRows").value()
    assert 2000 <= read < 15000
