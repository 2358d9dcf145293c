import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from attriflux.plans.runs import run_collection, run_features
from attriflux.schemas import UNIFIED_COLUMNS
from attriflux.sources import facts as fs
from attriflux.sources import platforms as pf


def payloads(spark, *items):
    return spark.createDataFrame([(json.dumps(i),) for i in items], "payload string")


def test_load_cleans_headers_and_types(spark, tmp_path, raw_facts):
    path = str(tmp_path / "raw")
    df = raw_facts.drop("source")
    df.toDF(*[f" {c.upper()} " for c in df.columns]).write.option("header", True).csv(path)
    out = fs.load_campaigns(spark, path)
    assert dict(out.dtypes)["c_date"] == "date" and dict(out.dtypes)["clicks"] == "bigint"
    assert out.select("source").distinct().collect() == [("csv_import",)]
    assert out.count() == 6


def test_load_prefers_combined_when_there(spark, tmp_path, raw_facts):
    original, combined = str(tmp_path / "a"), str(tmp_path / "b")
    raw_facts.write.option("header", True).csv(original)
    assert fs.load_campaigns(spark, original, combined).count() == 6
    raw_facts.limit(2).write.option("header", True).csv(combined)
    assert fs.load_campaigns(spark, original, combined).count() == 2
    assert fs.load_campaigns(spark, original, combined, source="original").count() == 6
    with pytest.raises(ValueError):
        fs.load_campaigns(spark, original, combined, source="other")


def test_category_falls_back_to_source(spark):
    df = fs.standardise_columns(spark.createDataFrame([("x", "2024-01-01")], "source string, c_date string"))
    assert df.first()["category"] == "x"


def test_validate_names_missing_columns(spark):
    with pytest.raises(ValueError, match="'shop' is missing columns.*revenue"):
        fs.validate_unified(spark.createDataFrame([("c", "2024-01-01")], "campaign_name string, c_date string"), "shop")


def test_validate_fills_and_orders(spark):
    df = spark.createDataFrame(
        [(None, float("nan"), 3, 1, None, 2.5, "2024-01-02", "c", "old")],
        "revenue double, mark_spent double, clicks int, leads int, orders int, impressions double, c_date string, "
        "campaign_name string, source string")
    out = fs.validate_unified(df, "shop")
    row = out.first()
    assert out.columns == UNIFIED_COLUMNS
    assert (row.source, row.revenue, row.mark_spent, row.orders, row.impressions) == ("shop", 0.0, 0.0, 0, 2)
    assert row.c_date == dt.date(2024, 1, 2)


def test_combine_skips_and_reports_failures(spark, raw_facts):
    def broken():
        raise RuntimeError("no access")
    out, errors = fs.combine_sources({"b": raw_facts, "x": broken, "a": raw_facts, "y": raw_facts.drop("clicks")})
    assert [e["connector"] for e in errors] == ["x", "y"] and errors[0]["error"] == "no access"
    assert [r.source for r in out.collect()] == ["a"] * 6 + ["b"] * 6
    assert fs.combine_sources({"x": broken})[0] is None


def test_date_range_is_inclusive(raw_facts):
    assert fs.fetch_date_range(raw_facts, "2024-01-08", "2024-01-15").count() == 4
    assert fs.fetch_date_range(raw_facts).count() == 0   # the last 30 days


def test_summary_gives_no_roas_without_spend(spark, raw_facts):
    free = raw_facts.withColumns({"mark_spent": F.lit(0.0), "source": F.lit("ga4")})
    rows = {r.source: r for r in fs.source_summary(raw_facts.unionByName(free)).collect()}
    assert rows["ga4"].overall_roas is None and rows["ga4"].n_campaigns == 2
    assert rows["csv_import"].overall_roas == pytest.approx(3850 / 1200)


def test_google_splits_conversions_and_scales_cost(spark):
    raw = payloads(spark, {"campaign": {"name": "g"}, "segments": {"date": "2024-01-03"}, "metrics": {
        "impressions": 10, "clicks": 5, "cost_micros": 2500000, "conversions": 9.9, "conversions_value": 12.5}})
    row = pf.normalise_google_ads(raw).first()
    assert (row.mark_spent, row.leads, row.orders, row.revenue, row.source) == (2.5, 5, 3, 12.5, "google_ads")


def test_meta_takes_last_entry_and_defaults_to_zero(spark):
    raw = payloads(
        spark,
        {"campaign_name": "m", "date_start": "2024-01-03", "impressions": "10", "spend": "1.5",
         "actions": [{"action_type": "lead", "value": "3"}, {"action_type": "lead", "value": "4"}]},
        {"campaign_name": "n", "date_start": "2024-01-04", "impressions": "10", "clicks": "2", "spend": "1",
         "actions": [{"action_type": "purchase", "value": "2"}],
         "action_values": [{"action_type": "purchase", "value": "9.5"}]})
    a, b = pf.normalise_meta_ads(raw).orderBy("campaign_name").collect()
    assert (a.clicks, a.leads, a.orders, a.revenue) == (0, 4, 0, 0.0)
    assert (b.clicks, b.leads, b.orders, b.revenue) == (2, 0, 2, 9.5)


def test_tiktok_revenue_from_roas(spark):
    raw = payloads(spark, {"metrics": {"campaign_name": "t", "impressions": "7", "clicks": "3", "spend": "10.0",
                                       "conversion": "9", "complete_payment_roas": "2.5"},
                           "dimensions": {"stat_time_day": "2024-01-05"}},
                   {"metrics": {"campaign_name": "u", "impressions": "7", "clicks": "3", "spend": "10.0",
                                "conversion": "1"}, "dimensions": {"stat_time_day": "2024-01-05 00:00:00"}})
    a, b = pf.normalise_tiktok_ads(raw).orderBy("campaign_name").collect()
    assert (a.leads, a.orders, a.revenue, a.c_date) == (3, 5, 25.0, dt.date(2024, 1, 5))
    assert (b.leads, b.orders, b.revenue, b.c_date) == (0, 0, 0.0, dt.date(2024, 1, 5))


def test_ga4_reads_positions(spark):
    raw = payloads(spark, {"dimension_values": ["20240106", "google / cpc", "Spring Sale"],
                           "metric_values": ["40", "30", "5", "99.5", "2"]})
    row = pf.normalise_ga4(raw).first()
    assert row.campaign_name == "ga4_spring_sale_google_/_cpc" and row.c_date == dt.date(2024, 1, 6)
    assert (row.impressions, row.clicks, row.leads, row.orders, row.mark_spent, row.revenue) == (400, 40, 3, 2, 0.0, 99.5)


def test_collection_takes_the_last_30_days_by_default(spark, tmp_path, raw_facts):
    recent = raw_facts.withColumn("c_date", F.date_sub(F.current_date(), F.dayofmonth("c_date") * 4))
    summary, errors = run_collection({"a": recent, "x": raw_facts.drop("leads")}, str(tmp_path / "c"))
    assert [r.n_rows for r in summary.collect()] == [2] and [e["connector"] for e in errors] == ["x"]
    assert run_collection({"x": raw_facts.drop("leads")}, str(tmp_path / "d"))[0] is None


def test_feature_run(spark, tmp_path, raw_facts):
    raw_facts.write.option("header", True).csv(str(tmp_path / "raw"))
    assert run_features(spark, str(tmp_path / "raw"), str(tmp_path / "features")).count() == 4


def test_collection_counts_unread_dates(spark, raw_facts, tmp_path):
    recent = raw_facts.withColumns({"c_date": F.current_date().cast("string")})
    broken = recent.withColumn("c_date", F.when(F.col("campaign_id") == 101, "soon").otherwise(F.col("c_date")))
    nothing = recent.withColumn("c_date", F.lit("2024-13-45"))
    summary, errors = run_collection({"a": recent, "b": broken, "c": nothing}, str(tmp_path / "c"))
    rows = {r.source: r for r in summary.collect()}
    assert errors == [] and {k: (r.n_rows, r.unread_dates) for k, r in rows.items()} == {"a": (6, 0), "b": (3, 3), "c": (None, 6)}


def test_a_bad_number_costs_one_row_only(spark, raw_facts, tmp_path):
    texts = raw_facts.withColumns({c: F.col(c).cast("string") for c in ("mark_spent", "clicks", "c_date", "revenue")})
    row = F.col("campaign_name") == "google_hot"
    bad = texts.withColumn("mark_spent", F.when(row & (F.col("c_date") == "2024-01-01"), "n/a").otherwise(F.col("mark_spent"))) \
        .withColumn("clicks", F.when(row & (F.col("c_date") < "2024-01-09"), "many").otherwise(F.col("clicks"))) \
        .withColumn("revenue", F.when(F.col("campaign_name") == "facebook_tier1", " NaN ").otherwise(F.col("revenue"))) \
        .withColumn("orders", F.when(row & (F.col("c_date") == "2024-01-15"), F.lit(None)).otherwise(F.col("orders")))
    accepted, rejected, errors = fs.combine_checked(spark, {"a": bad, "b": raw_facts, "c": raw_facts.drop("clicks")})
    assert [e["connector"] for e in errors] == ["c"] and accepted.columns == UNIFIED_COLUMNS
    assert {r.source: r["count"] for r in accepted.groupBy("source").count().collect()} == {"a": 4, "b": 6}
    assert {r.revenue for r in accepted.filter("source = 'a' AND campaign_name = 'facebook_tier1'").collect()} == {0.0}
    assert {r.orders for r in accepted.filter("source = 'a' AND campaign_name = 'google_hot'").collect()} == {0}
    assert sorted((r.source, str(r.c_date), r.column, r.raw) for r in rejected.collect()) == [
        ("a", "2024-01-01", "clicks", "many"), ("a", "2024-01-01", "mark_spent", "n/a"), ("a", "2024-01-08", "clicks", "many")]
    assert {(r.column, r.n_rejected) for r in fs.rejected_counts(rejected).collect()} == {("clicks", 2), ("mark_spent", 1)}
    assert fs.validate_unified(bad, "a").count() == 4 and fs.combine_sources({"a": bad, "b": raw_facts})[0].count() == 10
    assert fs.combine_checked(spark, {"c": raw_facts.drop("clicks")})[0] is None


def test_infinite_and_oversized_numbers_are_rejected(spark, raw_facts):
    huge = raw_facts.withColumn("clicks", F.lit("1e30")).withColumn("impressions", F.lit("5.0"))
    accepted, rejected, _ = fs.combine_checked(spark, {"a": huge})
    assert accepted.count() == 0 and {(r.column, r.raw) for r in rejected.collect()} == {("clicks", "1e30")}


def test_normalisers_tell_what_they_cannot_read(spark):
    good = '{"campaign_name":"c","date_start":"2024-01-01","impressions":"10","clicks":"1","spend":"2.5","actions":[],"action_values":[]}'
    rows = [good, good.replace('"2.5"', '"unknown"'), good.replace('"10"', '"ten"').replace("2024-01-01", "someday")]
    raw = spark.createDataFrame([(r,) for r in rows], "payload string")
    assert pf.normalise_meta_ads(raw).count() == 1
    accepted, rejected, errors = fs.combine_checked(spark, {"meta_ads": pf.normalise_meta_ads(raw, keep_rejects=True)})
    assert accepted.count() == 1 and not errors
    assert sorted((r.column, r.raw) for r in rejected.collect()) == [("c_date", "someday"), ("impressions", "ten"), ("mark_spent", "unknown")]


def test_collection_saves_what_it_rejects(spark, raw_facts, tmp_path):
    bad = raw_facts.withColumn("leads", F.when(F.col("campaign_name") == "google_hot", "?").otherwise(F.col("leads").cast("string")))
    summary, _ = run_collection({"a": bad, "b": raw_facts}, f"{tmp_path}/out", "2024-01-01", "2024-12-31", spark)
    assert {r.source: (r.n_rows, r.rejected_values) for r in summary.collect()} == {"a": (3, 3), "b": (6, 0)}
    assert spark.read.parquet(f"{tmp_path}/out-rejected").count() == 3


def test_a_range_is_replaced_and_others_stay(spark, raw_facts, tmp_path):
    path = str(tmp_path / "facts")
    facts = raw_facts.select(UNIFIED_COLUMNS)
    fs.save_range(facts, path, "2024-01-01", "2024-01-31")
    before = sorted(fs.load_range(spark, path, facts.schema, "2024-01-01", "2024-01-31").collect())
    assert before == sorted(facts.collect())
    newer = facts.filter("campaign_name = 'google_hot'").withColumn("clicks", F.lit(7).cast("bigint"))
    for _ in range(2):                                      # the 15th has rows no more after the filter below
        fs.save_range(newer.filter("c_date < DATE '2024-01-15'"), path, "2024-01-08", "2024-01-20")
        now = sorted(fs.load_range(spark, path, facts.schema, "2024-01-01", "2024-01-31").collect())
        assert [(str(r.c_date), r.campaign_name, r.clicks) for r in sorted(now, key=lambda r: (r.c_date, r.campaign_name))] == [
            ("2024-01-01", "facebook_tier1", 50), ("2024-01-01", "google_hot", 120), ("2024-01-08", "google_hot", 7)]
    plan = fs.load_range(spark, path, facts.schema, "2024-01-08", "2024-01-09")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    whole = fs.load_range(spark, path, facts.schema, "2024-01-01", "2024-01-31")
    fs.save_range(whole.withColumn("clicks", F.col("clicks") * 2), path, "2024-01-01", "2024-01-31")     # from the table itself
    assert sorted(r.clicks for r in fs.load_range(spark, path, facts.schema, "2024-01-01", "2024-01-31").collect()) == [14, 100, 240]


def test_validated_payload_is_parsed_once(spark):
    """Dropping rejected rows must not copy the JSON parsing into one filter term per checked value."""
    raw = spark.createDataFrame([(json.dumps({"campaign": {"name": "c"}, "segments": {"date": "2024-01-01"},
                                               "metrics": {"impressions": 1, "clicks": 1, "cost_micros": 1, "conversions": 1.0,
                                                           "conversions_value": 1.0}}),)], ["payload"])
    out = fs.validate_unified(pf.normalise_google_ads(raw), "google_ads")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert out.count() == 1
