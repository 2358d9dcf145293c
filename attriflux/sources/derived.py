"""Campaign facts and touchpoints derived from sales and event tables.

Facts are grouped to their grain (source, campaign, date) with map-side
partial sums before anything else, so a campaign with most of the raw rows
leaves the shuffle as one row per date. Money is summed in whole cents
(or their hundredths): the result does not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bounds, in percent, of the channel shares 20/18/12/15/10/10/8/7.
CHANNEL_BOUNDS = [
    ("tiktok_paid", 20), ("meta_facebook_feed", 38), ("meta_instagram_stories", 50),
    ("google_search_nonbrand", 65), ("google_display_retargeting", 75),
    ("google_search_brand", 85), ("organic_search", 93), ("direct", 100),
]
# Multipliers that spread user traits and detection draws over 0..99.
TRAIT_FACTORS = {"cookies": 37, "adblocker": 53, "device": 71}
# How often each method detects a touch.
DETECTION_RATES = {"cookie": 0.95, "utm": 0.90, "fingerprint": 0.70, "referrer": 0.60, "server_side": 0.92}
DRAW_FACTORS = {"cookie": 17, "utm": 29, "fingerprint": 41, "referrer": 59, "server_side": 83}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _cents(value: Column) -> Column:
    return F.rint(value * 100).cast("bigint")


def facts_from_sales(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One fact per supplier and ship month: the supplier is the campaign, its region the source."""
    price = _cents(F.col("l_extendedprice"))
    discount = _cents(F.col("l_discount"))
    monthly = (
        lineitem
        .groupBy("l_suppkey", F.trunc("l_shipdate", "month").alias("c_date"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("impressions"),
            F.count(F.lit(1)).alias("clicks"),
            F.count(F.when(F.col("l_returnflag") != "R", 1)).alias("leads"),
            F.count(F.when(F.col("l_returnflag") == "N", 1)).alias("orders"),
            (F.sum(price * discount) / F.lit(10000.0)).alias("mark_spent"),
            (F.sum(price * (F.lit(100) - discount)) / F.lit(10000.0)).alias("revenue")))
    # nation and region have a fixed number of rows; supplier grows, so its join is left to the optimizer
    dims = (
        supplier
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("s_name").alias("campaign_name"),
                F.col("r_name").alias("source"), F.col("n_name").alias("category")))
    return monthly.join(dims, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "source", "campaign_name", "category", "c_date", "impressions", "clicks",
        "leads", "orders", "mark_spent", "revenue")


def facts_from_events(events: DataFrame) -> DataFrame:
    """One fact per user group (user_id mod 10) and day."""
    def count_of(kind):
        return F.count(F.when(F.col("event_type") == kind, 1))

    def money_of(kind):
        return F.coalesce(F.sum(F.when(F.col("event_type") == kind, _cents(F.col("value")))), F.lit(0)) / F.lit(100.0)

    campaign = F.concat(F.lit("campaign_"), (F.col("user_id") % 10).cast("string"))
    return (
        events
        .groupBy(campaign.alias("campaign_name"), F.to_date("ts").alias("c_date"))
        .agg(
            count_of("view").alias("impressions"), count_of("click").alias("clicks"),
            count_of("signup").alias("leads"), count_of("purchase").alias("orders"),
            money_of("click").alias("mark_spent"), money_of("purchase").alias("revenue"))
        .select(F.lit("web").alias("source"), "campaign_name", F.lit("web").alias("category"), "c_date",
                "impressions", "clicks", "leads", "orders", "mark_spent", "revenue"))


def channel_of(number: Column) -> Column:
    """Channel by where a number in 0..99 falls in the cumulative shares."""
    expr = None
    for name, bound in CHANNEL_BOUNDS:
        hit = number < bound
        expr = F.when(hit, name) if expr is None else expr.when(hit, name)
    return expr


def touch_events(events: DataFrame) -> DataFrame:
    """Raw touches of the event table: channel, day, conversion and value, user traits and what each method detected.

    The event table has no traits and no detections; both are made from its ids, as inputs of the operators.
    """
    number = F.get_json_object("props", "$.k").cast("int")
    user, event = F.col("user_id"), F.col("event_id")
    traits = {
        "cookies_accepted": user * TRAIT_FACTORS["cookies"] % 100 >= 35,
        "has_adblocker": user * TRAIT_FACTORS["adblocker"] % 100 < 25,
        "switches_device": user * TRAIT_FACTORS["device"] % 100 < 30,
    }
    detected = {f"detected_{m}": ((event * f + user) % 100) / F.lit(100.0) < F.lit(DETECTION_RATES[m])
                for m, f in DRAW_FACTORS.items()}
    return events.select(
        "user_id", "event_id", "ts", F.to_date("ts").alias("date"), channel_of(number).alias("channel"),
        (F.col("event_type") == "purchase").alias("is_conversion"), "value",
        *[c.alias(n) for n, c in traits.items()], *[c.alias(n) for n, c in detected.items()])
