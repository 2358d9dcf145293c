"""Plain inputs that once gave wrong results."""

import pytest
from pyspark.sql import functions as F

from attriflux.operators import documents as do
from attriflux.operators import reports as rep
from attriflux.operators import retrieval as re_
from attriflux.ml.models import (
    predict_anomaly, predict_roas, prepare_anomaly, prepare_forecast, train_linear, train_logistic)
from attriflux.sources.facts import load_campaigns, unread_values


def test_whole_numbers_written_as_floats(spark, tmp_path):
    path = tmp_path / "facts.csv"
    path.write_text("c_date,campaign_name,impressions,clicks,leads,orders,mark_spent,revenue\n"
                    "2024-01-01,a,1000.0,10,,1,5.5,7\n2024-01-02,a,nan,x,3.0,1e2,oops,1\nnever,b,9007199254740993,1,1,1,1,1\n")
    rows = load_campaigns(spark, str(path)).collect()
    assert [(r.impressions, r.clicks, r.leads, r.orders, r.mark_spent) for r in rows] == [
        (1000, 10, None, 1, 5.5), (None, None, 3, 100, None), (9007199254740993, 1, 1, 1, 1.0)]
    assert rows[2].c_date is None
    unread = {r["column"]: r.unread for r in unread_values(spark.read.option("header", True).csv(str(path))).collect()}
    assert {k: v for k, v in unread.items() if v} == {"clicks": 1, "mark_spent": 1, "c_date": 1}


def test_requests_come_back_as_they_were(spark, folder):
    from attriflux.catalog.inputs import sales_features
    features = sales_features(spark, folder).limit(200)
    requests = features.limit(3).withColumn("roas", F.lit(None).cast("double")).withColumn("cpl", F.lit(None).cast("double"))
    labelled = predict_anomaly(train_logistic(prepare_anomaly(features)), requests).collect()
    assert all(r.roas is None and r.cpl is None and r.label == "skipped" and r.is_flagged is None for r in labelled)
    valued = predict_roas(train_linear(prepare_forecast(features)), requests).collect()
    assert all(r.roas is None and r.cpl is None and r.predicted_roas is not None for r in valued)


def test_missing_and_uneven_vectors(spark):
    docs = spark.createDataFrame([("a", [0.0, 1.0]), ("b", None), ("c", [1.0, 1.0])], "id string, vec array<double>")
    asked = spark.createDataFrame([(1, [0.0, 0.9]), (2, None)], "query_id int, vec array<double>")
    assert [(r.query_id, r.doc_id) for r in re_.query_topk(docs, asked, 2).orderBy("rank").collect()] == [(1, "a"), (1, "c")]
    uneven = spark.createDataFrame([("a", [0.0]), ("b", [1.0, 1.0, 1.0]), ("c", [1.0, 2.0])], "id string, vec array<double>")
    with pytest.raises(Exception, match="vectors of"):
        re_.query_topk(uneven, asked, 2).collect()


def test_ids_are_unique(spark):
    facts = spark.createDataFrame([("s", "c3", "2024-01-02", 1), ("s", "c3", "2024-01-02", 2), ("s", "c4", "2024-01-02", 3)],
                                  "source string, campaign_name string, c_date string, clicks int")
    rows = {r.id: r.text for r in do.create_documents(facts).collect()}
    assert sorted(rows) == ["row|s|c3|2024-01-02", "row|s|c3|2024-01-02|2", "row|s|c4|2024-01-02"]


def test_a_question_without_hits_has_a_row(spark):
    hits = spark.createDataFrame([(1, 1, ("c",))], "query_id int, rank int, metadata struct<campaign_name:string>")
    asked = spark.createDataFrame([(1,), (2,)], "query_id int")
    rows = {r.query_id: (r.sources_count, r.source_campaigns) for r in do.answer_sources(hits, asked).collect()}
    assert rows == {1: (1, ["c"]), 2: (0, [])}


def test_category_of_the_first_day_is_settled(spark):
    from attriflux.sources.facts import standardise_columns
    from tests.conftest import RAW_COLUMNS
    rows = [("2024-01-01", "x", c, 1, 10, 1.0, 2, 1, 1, 3.0, s) for s, c in (("b", "late"), ("a", "first"))]
    from attriflux.operators.features import engineer_features
    facts = standardise_columns(spark.createDataFrame(rows, [*RAW_COLUMNS, "source"]))
    assert rep.campaign_summary(engineer_features(facts, keep_incomplete=True), "x").first().category == "first"


def test_stratified_cut_is_exact(spark):
    from attriflux.ml.prepare import split_stratified
    rows = spark.range(400_000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("y"))
    rows = rows.unionByName(spark.range(400_000, 400_007).select("id", F.lit(None).cast("int").alias("y")))
    got = {(r.y, r.split): r["count"] for r in split_stratified(rows, "y").groupBy("y", "split").count().collect()}
    assert got == {(0, "test"): 53_334, (0, "train"): 213_332, (1, "test"): 26_667, (1, "train"): 106_667,
                   (None, "test"): 2, (None, "train"): 5}
