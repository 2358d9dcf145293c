import numpy as np
import pytest
from pyspark.sql import functions as F

from attriflux.operators import documents as do
from attriflux.operators import retrieval as re_
from attriflux.sources.derived import table


@pytest.fixture(scope="module")
def docs(features):
    return do.create_documents(features).persist()


def test_document_text(docs):
    text = {r.id: r.text for r in docs.collect()}["row|csv_import|facebook_tier1|2024-01-08"]
    assert text.split("\n") == [
        "Campaign facebook_tier1 (social) on 2024-01-08:",
        "Impressions: 2000, Clicks: 80, Leads: 15, Orders: 8.",
        "Spent: $200.00, Revenue: $300.00.",
        "CTR: 4.00%, CPC: $2.50, ROAS: 1.50, CPL: $13.33.",
        "Conversion rate: 10.00%.",
        "ROAS change week-over-week: -70.0%.",
        "CTR change week-over-week: -20.0%.",
        "Spend change week-over-week: +100.0%.",
        "This campaign is flagged as an ANOMALY."]


def test_missing_changes_and_columns_are_left_out(spark):
    df = spark.createDataFrame([("c", "s", None, 0.5)], "campaign_name string, category string, roas_wow double, ctr_wow double")
    text = df.select(do.row_to_document(df.columns).alias("t")).first().t
    assert text == "Campaign c (s) on unknown:\nCTR change week-over-week: +50.0%."


def test_documents_have_unique_ids_and_metadata(docs):
    assert docs.count() == docs.select("id").distinct().count() == 4
    assert set(docs.schema["metadata"].dataType.names) == {"campaign_name", "category", "is_anomaly", "c_date"}


def test_index_and_search(spark, features, tmp_path):
    path = re_.create_index(features, str(tmp_path / "index"))
    docs, encoder = re_.load_index(spark, path)
    assert docs.count() == 4 and all(len(r.vec) == 384 for r in docs.collect())
    hits = re_.batch_questions(docs, encoder, re_.question_frame(spark, ["google_hot", "an ANOMALY"]), 3).collect()
    for q in (0, 1):
        mine = sorted((r for r in hits if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3]
        assert [r.distance for r in mine] == sorted(r.distance for r in mine)
    assert min((r for r in hits if r.query_id == 0), key=lambda r: r["rank"]).first_line.startswith("Campaign google_hot")


@pytest.mark.parametrize("block", [512, 7])
def test_topk_equals_brute_force(spark, folder, block):
    items = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")
    queries = items.filter("label < 2").select(F.col("id").alias("query_id"), "vec").limit(20)
    found = {}
    for r in re_.query_topk(items.repartition(5), queries, 6, block=block).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.doc_id, r.distance))
    rows = items.collect()
    ids, matrix = np.array([r.id for r in rows]), np.array([r.vec for r in rows])
    asked = queries.collect()
    assert len(found) == len(asked)
    for q in asked:
        distance = np.round(((matrix - np.array(q.vec)) ** 2).sum(axis=1), 9)
        order = np.lexsort((ids, distance))[:6]
        assert found[q.query_id] == [(ids[i], distance[i]) for i in order]


def test_ties_are_settled_by_id(spark):
    docs = spark.createDataFrame([(f"d{i}", [1.0, 0.0]) for i in range(30)], "id string, vec array<double>").repartition(4)
    queries = spark.createDataFrame([(0, [0.0, 1.0])], "query_id int, vec array<double>")
    out = re_.query_topk(docs, queries, 3).orderBy("rank").collect()
    assert [r.doc_id for r in out] == ["d0", "d1", "d10"]


def test_fewer_documents_than_asked_for(spark):
    docs = spark.createDataFrame([(1, [1.0]), (2, [3.0])], "id int, vec array<double>")
    queries = spark.createDataFrame([(0, [0.0])], "query_id int, vec array<double>")
    assert re_.query_topk(docs, queries, 5).count() == 2


def test_prompt_and_sources(spark, docs, features):
    encoder = re_.TextEncoder.fit(docs)
    questions = re_.question_frame(spark, ["Which campaign has the worst ROAS?"])
    hits = re_.with_documents(re_.query_topk(encoder.embed(docs), encoder.embed(questions, "question"), 3), docs)
    messages = do.build_prompt(hits, questions).first().messages
    assert [m.role for m in messages] == ["system", "user"]
    assert "Which campaign has the worst ROAS?" in messages[1].content and messages[1].content.count("\n\n---\n\n") == 2
    sources = do.answer_sources(hits).first()
    assert sources.sources_count == 3 and len(sources.source_campaigns) == 3
    assert sources.distinct_campaigns == sorted(set(sources.source_campaigns))


def test_question_without_hits_still_gets_a_prompt(spark, docs):
    questions = re_.question_frame(spark, ["anything"])
    none = docs.limit(0).select(F.lit(0).alias("query_id"), F.lit(1).alias("rank"), "text")
    assert len(do.build_prompt(none, questions).first().messages) == 2


def test_embed_documents_makes_the_documents_once(spark):
    """the documents are computed once for both the weights and the vectors, not once for each."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(t):
        seen.add(1)
        return t

    docs = spark.createDataFrame([(i, f"word{i % 7} other{i % 3}") for i in range(50)], "id int, text string")
    out = re_.embed_documents(docs.withColumn("text", text("text"))).collect()
    assert len(out) == 50 and all(len(r.vec) == re_.DIMENSIONS for r in out)
    assert seen.value == 50
