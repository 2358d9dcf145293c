import json
import time
from itertools import combinations
from math import factorial

import pytest
from pyspark.sql import functions as F

from attriflux.operators import attribution as at
from attriflux.operators import journeys as jo
from attriflux.operators import tracking as tr
from attriflux.plans.runs import attribution_report
from attriflux.schemas import ATTRIBUTION_MODELS
from attriflux.sources.derived import table, touch_events


@pytest.fixture(scope="module")
def touches(spark, folder):
    return touch_events(table(spark, folder, "events")).persist()


@pytest.fixture(scope="module")
def journeys(touches):
    return jo.touchpoints(touches).persist()


@pytest.fixture(scope="module")
def results(journeys):
    return at.attribution(journeys).persist()


def test_touch_index_starts_at_zero_and_has_no_gaps(journeys):
    paths = journeys.groupBy("user_id", "path_id").agg(
        F.min("touch_index").alias("low"), F.max("touch_index").alias("high"), F.count("*").alias("n"),
        F.first("n_touches").alias("told"))
    assert paths.filter("low <> 0 OR high <> n - 1 OR told <> n").count() == 0


def test_revenue_sits_on_the_last_touch(journeys):
    assert journeys.filter("is_converting_touch AND touch_index <> n_touches - 1").count() == 0
    assert journeys.filter("NOT is_converting_touch AND revenue > 0").count() == 0
    converting = journeys.filter("is_converting_touch").select("user_id", "path_id")
    others = journeys.filter("NOT is_converting_touch").join(converting, ["user_id", "path_id"], "left_semi")
    assert others.filter("revenue IS NOT NULL").count() == 0


def test_one_user_with_all_touches(touches):
    """One user holds everything, with several touches per hour."""
    one = touches.withColumns({"user_id": F.lit(1).cast("bigint"), "ts": F.date_trunc("hour", "ts")})
    rows = jo.build_journeys(one).orderBy("ts", "event_id").collect()
    path = index = 0
    for r in rows:
        assert (r.path_id, r.touch_index) == (path, index)
        path, index = (path + 1, 0) if r.is_converting_touch else (path, index + 1)


def test_time_is_linear_in_a_users_touches(spark):
    """A million touches of one user take no more than a few times as long as the same touches of many users."""
    def seconds(users):
        raw = spark.range(1_000_000).select(
            (F.col("id") % users).alias("user_id"), F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"),
            (F.col("id") % 1_000_003 == 7).alias("is_conversion"), F.lit(1.0).alias("value"))
        start = time.perf_counter()
        jo.build_journeys(raw).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start
    many = min(seconds(8000), seconds(8000))
    assert seconds(1) < 12 * many + 10


def test_enhanced_sees_at_least_as_much(journeys):
    row = tr.tracking_loss_total(journeys).first()
    assert row.ga4_visible <= row.enhanced_visible and row.ga4_loss_pct >= row.enhanced_loss_pct


def test_direct_and_rejected_cookies_are_not_seen(journeys):
    assert journeys.filter("channel = 'direct' AND (tracking_utm OR tracking_referrer)").count() == 0
    assert journeys.filter("NOT cookies_accepted AND tracking_cookie").count() == 0
    blind = journeys.filter("channel = 'google_display_retargeting' AND NOT cookies_accepted AND touch_index > 0")
    assert blind.filter("ga4_visible OR enhanced_visible").count() == 0


def test_every_model_conserves_revenue(journeys, results):
    total = journeys.agg(F.sum("revenue")).first()[0]
    sums = {r.model: r[1] for r in results.groupBy("model").agg(F.sum("attributed_revenue")).collect()}
    assert set(sums) == set(ATTRIBUTION_MODELS)
    for value in sums.values():
        assert value == pytest.approx(total, abs=0.1)
    assert results.filter("attributed_revenue < 0").count() == 0


def test_single_models_equal_the_combined_pass(journeys, results):
    for name, model in (("last_click", at.last_click), ("first_click", at.first_click), ("linear", at.linear),
                        ("time_decay", at.time_decay), ("shapley", at.shapley)):
        alone = {r.channel: (round(r.attributed_revenue, 6), r.conversions) for r in model(journeys).collect()}
        joint = {r.channel: (round(r.attributed_revenue, 6), r.conversions) for r in results.filter(F.col("model") == name).collect()}
        assert alone == joint


def test_shapley_equals_the_sum_over_all_subsets(journeys):
    rows = journeys.collect()
    sets, revenue = {}, {}
    for r in rows:
        key = (r.user_id, r.path_id)
        sets.setdefault(key, set()).add(r.channel)
        if r.is_converting_touch:
            revenue[key] = r.revenue
    users = [(sets[k], v) for k, v in revenue.items()]
    names = sorted({c for s, _ in users for c in s})
    n = len(names)
    value = lambda coalition: sum(v for s, v in users if s <= coalition)
    expected = {}
    for c in names:
        others = [x for x in names if x != c]
        expected[c] = sum(
            factorial(k) * factorial(n - k - 1) / factorial(n) * (value(set(sub) | {c}) - value(set(sub)))
            for k in range(n) for sub in combinations(others, k))
    found = {r.channel: r.attributed_revenue for r in at.shapley(journeys).collect()}
    assert found == pytest.approx(expected, abs=0.0051)


def test_time_decay_halves_per_day(spark):
    df = spark.createDataFrame(
        [("u", 0, "a", "2024-01-01", False, None), ("u", 1, "b", "2024-01-03", True, 50.0)],
        "user_id string, touch_index int, channel string, date string, is_converting_touch boolean, revenue double"
    ).withColumn("date", F.to_date("date"))
    shares = {r.channel: r.attributed_revenue for r in at.time_decay(df).collect()}
    assert shares == pytest.approx({"a": 10.0, "b": 40.0})


def test_first_click_skips_missing_channels(spark):
    df = spark.createDataFrame(
        [("u", 0, None, "2024-01-01", False, None), ("u", 1, "b", "2024-01-01", False, None), ("u", 2, "c", "2024-01-03", True, 50.0)],
        "user_id string, touch_index int, channel string, date string, is_converting_touch boolean, revenue double"
    ).withColumn("date", F.to_date("date"))
    assert [(r.channel, r.attributed_revenue) for r in at.first_click(df).collect()] == [("b", 50.0)]


# A published result of two models over eight channels.
PUBLISHED = {
    "last_click": [2166.15, 1740.84, 3709.38, 2683.19, 1979.89, 1680.07, 2012.07, 1956.97],
    "shapley": [2002.7, 1761.39, 2728.37, 2829.95, 2565.1, 1928.0, 1514.86, 2598.19],
}
CHANNELS = ["direct", "google_display_retargeting", "google_search_brand", "google_search_nonbrand",
            "meta_facebook_feed", "meta_instagram_stories", "organic_search", "tiktok_paid"]


def test_published_misattribution(spark):
    rows = [(c, v, 1, m) for m, values in PUBLISHED.items() for c, v in zip(CHANNELS, values)]
    df = spark.createDataFrame(rows, "channel string, attributed_revenue double, conversions int, model string")
    out = at.find_misattribution(df).collect()
    assert (out[0].channel, out[0].last_click_pct, out[0].shapley_pct, out[0].pct_difference) == ("tiktok_paid", 10.9, 14.5, 3.6)
    assert (out[-1].channel, out[-1].last_click_pct, out[-1].shapley_pct, out[-1].pct_difference) == (
        "google_search_brand", 20.7, 15.2, -5.5)
    assert out[0].verdict == "UNDERVALUED by last-click" and out[-1].verdict == "OVERVALUED by last-click"


def test_channel_known_to_one_model_only(spark):
    df = spark.createDataFrame(
        [("a", 10.0, 1, "last_click"), ("b", 10.0, 1, "shapley")],
        "channel string, attributed_revenue double, conversions int, model string")
    out = {r.channel: (r.last_click_pct, r.shapley_pct) for r in at.find_misattribution(df).collect()}
    assert out == {"a": (100.0, 0.0), "b": (0.0, 100.0)}


def test_compare_models_has_percentages(results):
    out = at.compare_models(results)
    assert set(out.columns) == {"channel", *ATTRIBUTION_MODELS, *[f"{m}_pct" for m in ATTRIBUTION_MODELS]}
    for m in ATTRIBUTION_MODELS:
        assert out.agg(F.sum(f"{m}_pct")).first()[0] == pytest.approx(100, abs=0.5)


def test_report_saves_insights(touches, tmp_path):
    out = attribution_report(touches, str(tmp_path))
    insights = json.loads(out["insights"].first().insights)
    assert set(insights) == {"headline", "tracking", "attribution", "summary"}
    assert insights["headline"].startswith("Last-click attribution misallocates revenue: ")
    assert insights["summary"]["converting_users"] <= insights["summary"]["total_users"]
