import pytest
from pyspark.sql import functions as F

from attriflux.operators import features as fe
from attriflux.operators import reports as rep
from attriflux.schemas import DERIVED_COLUMNS
from attriflux.sources.derived import facts_from_sales, table
from attriflux.sources.facts import load_features, save_table


def test_first_row_of_each_campaign_drops(features):
    assert features.count() == 4
    assert set(DERIVED_COLUMNS) <= set(features.columns)
    assert features.filter("roas_wow IS NULL OR ctr_wow IS NULL").count() == 0
    assert {r.is_anomaly for r in features.collect()} <= {0, 1}


def test_values(features):
    row = features.filter("campaign_name = 'facebook_tier1' AND c_date = '2024-01-08'").first()
    assert row.ctr == pytest.approx(80 / 2000) and row.roas == pytest.approx(1.5)
    assert row.roas_wow == pytest.approx((1.5 - 5) / 5) and row.roas_rolling3 == pytest.approx(3.25)
    assert row.is_anomaly == 1


def test_zero_impressions_give_missing_values(raw_facts):
    zero = raw_facts.withColumn("impressions", F.when(F.col("c_date") == "2024-01-01", 0).otherwise(F.col("impressions")))
    rows = fe.engineer_features(zero, keep_incomplete=True).orderBy("campaign_name", "c_date").collect()
    assert rows[0].ctr is None and rows[0].is_anomaly == 0
    assert fe.engineer_features(zero).count() == 2   # no change against a missing value


def test_row_after_zero_roas_drops(raw_facts):
    zero = raw_facts.withColumn("revenue", F.when(F.col("c_date") == "2024-01-08", 0.0).otherwise(F.col("revenue")))
    assert {str(r.c_date) for r in fe.engineer_features(zero).collect()} == {"2024-01-08"}


def test_sources_without_spend_lose_all_rows(raw_facts):
    assert fe.engineer_features(raw_facts.withColumn("mark_spent", F.lit(0.0))).count() == 0


def test_heavy_campaign_against_pandas(spark):
    """Two thirds of all rows are one campaign's, many of them of one day."""
    rows = spark.range(600).select(
        "id", F.lit("s").alias("source"), F.when(F.col("id") % 3 < 2, "heavy").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("campaign_name"),
        F.lit("x").alias("category"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 11).cast("int")).alias("c_date"),
        (F.col("id") % 97 + 5).alias("impressions"), (F.col("id") % 13 + 1).alias("clicks"), (F.col("id") % 5).alias("leads"),
        (F.col("id") % 3).alias("orders"), (F.col("id") % 19 + 1.5).alias("mark_spent"), (F.col("id") * 7 % 101 + 0.5).alias("revenue"))
    got = fe.engineer_features(rows, keep_incomplete=True).toPandas().sort_values("id").set_index("id")
    want = rows.toPandas().sort_values(["campaign_name", "c_date", "source", "id"])
    want["roas"] = want.revenue / want.mark_spent
    by = want.groupby("campaign_name").roas
    want["prev"], want["mean"] = by.shift(1), by.transform(lambda x: x.rolling(3, min_periods=1).mean())
    want = want.sort_values("id").set_index("id")
    assert got.roas_prev.fillna(-1).tolist() == pytest.approx(want.prev.fillna(-1).tolist())
    assert got.roas_rolling3.tolist() == pytest.approx(want["mean"].tolist())


def test_independent_of_partitions(spark, folder):
    facts = facts_from_sales(*[table(spark, folder, n) for n in ("lineitem", "supplier", "nation", "region")])
    a = fe.engineer_features(facts.repartition(1))
    b = fe.engineer_features(facts.repartition(7, "c_date"))
    assert a.exceptAll(b).count() == 0


def test_save_and_load(spark, tmp_path, features):
    path = str(tmp_path / "f")
    save_table(features, path)
    assert load_features(spark, path).count() == 4


def test_filters(features):
    assert rep.filter_campaigns(features, campaign="google_hot").count() == 2
    assert rep.filter_campaigns(features, category="social").count() == 2
    only = rep.filter_campaigns(features, anomalies_only=True)
    assert {r.is_anomaly for r in only.collect()} == {1}
    assert only.count() == rep.anomaly_totals(features).first().n_anomalies


def test_totals_of_an_empty_table(features):
    row = rep.anomaly_totals(features.limit(0)).first()
    assert (row.n_anomalies, row.total_rows, row.anomaly_rate) == (0, 0, 0.0)


def test_anomalies_are_sorted_by_date(features):
    dates = [r.c_date for r in rep.list_anomalies_projected(features).collect()]
    assert dates == sorted(dates, reverse=True)


def test_summary(features):
    row = rep.summary(features).first()
    assert row.total_rows == 4 and row.unique_campaigns == 2
    assert row.best_avg_roas >= row.worst_avg_roas and 0 <= row.anomaly_rate <= 100
    pair = {r.kind: r.campaign_name for r in rep.best_worst_campaign(features).collect()}
    assert pair == {"best": row.best_campaign, "worst": row.worst_campaign}


def test_campaign_detail(features):
    totals, rows, available = rep.campaign_detail(features, "google_hot")
    assert totals.first().total_entries == rows.count() == 2 and available.count() == 0
    totals, rows, available = rep.campaign_detail(features, "nothing")
    assert totals.count() == rows.count() == 0
    assert [r[0] for r in available.collect()] == ["facebook_tier1", "google_hot"]


def test_leaderboard_first_declared_wins_ties(spark):
    metrics = spark.createDataFrame([("a", "f1", 0.5), ("b", "f1", 0.9), ("c", "f1", 0.9)], "model string, metric string, value double")
    best = rep.model_leaderboard(metrics, "f1", True, ["a", "c", "b"]).filter("is_best").collect()
    assert [r.model for r in best] == ["c"]
