"""Touchpoint journeys from raw touches: paths, channel traits and tracking visibility."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attriflux.operators import ranges
from attriflux.schemas import TRACKING_METHODS

# Channel, funnel position, average cost per click, seen without cookies.
CHANNEL_ROWS = [
    ("tiktok_paid", "top_funnel", 0.60, True),
    ("meta_facebook_feed", "top_funnel", 1.20, True),
    ("meta_instagram_stories", "top_funnel", 0.90, True),
    ("google_search_nonbrand", "mid_funnel", 3.50, True),
    ("google_display_retargeting", "mid_funnel", 0.80, False),
    ("google_search_brand", "bottom_funnel", 1.50, True),
    ("organic_search", "mid_funnel", 0.0, True),
    ("direct", "bottom_funnel", 0.0, False),
]


def channel_dimension(spark: SparkSession) -> DataFrame:
    columns = ["channel", "funnel_position", "avg_cpc", "trackable_without_cookies"]
    return spark.createDataFrame(pd.DataFrame(CHANNEL_ROWS, columns=columns))


def enrich_channel(df: DataFrame, channels: DataFrame | None = None) -> DataFrame:
    """Add funnel position, average click cost and trackability; unknown channels keep nulls."""
    if channels is None:
        channels = F.broadcast(channel_dimension(df.sparkSession))   # eight rows
    return df.join(channels, "channel", "left")


def build_journeys(touches: DataFrame) -> DataFrame:
    """Number each user's touches in (ts, event_id) order and split them after every conversion.

    Adds path_id and touch_index (both from 0), n_touches of the path,
    is_converting_touch (the last touch of a path that converts) and
    revenue: the value on the converting touch, missing on the other touches
    of a converting path, 0 on paths without conversion.

    One exchange by user serves all windows. They are running counts and sums
    over whole paths, so the time is linear in a user's touches, and sorts and
    buffers spill. Touches without a user belong to no journey.
    """
    touches = touches.filter(F.col("user_id").isNotNull())
    columns = [c for c in touches.columns if c not in ("is_conversion", "value")]
    in_order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    rows = touches.withColumn("path_id", F.count(F.when(F.col("is_conversion"), 1)).over(earlier))
    path = Window.partitionBy("user_id", "path_id")
    rows = rows.withColumns({
        "touch_index": (F.row_number().over(path.orderBy("ts", "event_id")) - 1).cast("bigint"),
        "n_touches": F.count(F.lit(1)).over(path),
        "_converts": F.coalesce(F.max("is_conversion").over(path), F.lit(False))})
    converts = F.col("is_conversion")
    return rows.select(
        *columns, "path_id", "touch_index", "n_touches", converts.alias("is_converting_touch"),
        F.when(converts, F.col("value")).when(~F.col("_converts"), F.lit(0.0)).alias("revenue"))


def build_journeys_in_ranges(touches: DataFrame) -> DataFrame:
    """``build_journeys`` for users of any size: touches are cut into even ranges by (user, time, id).

    A range numbers its own touches. What it needs of others is carried: the
    conversions before it, and for the paths that reach over its borders their
    touches in earlier ranges, in all, and whether they convert.
    """
    order = ["ts", "event_id"]
    columns = [c for c in touches.columns if c not in ("is_conversion", "value")]
    rows = ranges.cut_in_ranges(touches, "user_id", order)
    carried = ranges.carried_paths(rows, "user_id", order, F.col("is_conversion"))
    in_order = Window.partitionBy(ranges.PART, "user_id").orderBy(*order)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_path", F.count(F.when(F.col("is_conversion"), 1)).over(earlier))
    path = Window.partitionBy(ranges.PART, "user_id", "_path")
    rows = rows.withColumns({
        "_index": F.row_number().over(path.orderBy(*order)) - 1, "_n": F.count(F.lit(1)).over(path),
        "_converts": F.coalesce(F.max("is_conversion").over(path), F.lit(False))})
    rows = rows.join(F.broadcast(carried), [ranges.PART, "user_id"], "left")     # two rows a range
    rows = rows.withColumn("path_id", F.col("_path") + F.coalesce("_path0", F.lit(0)))
    piece = F.col("_pieces")[F.col("path_id")]
    converts = F.col("is_conversion")
    finished = F.coalesce(piece["finished"], F.col("_converts"))
    return rows.select(
        *columns, "path_id", (F.col("_index") + F.coalesce(piece["earlier"], F.lit(0))).cast("bigint").alias("touch_index"),
        F.coalesce(piece["all"], F.col("_n")).alias("n_touches"), converts.alias("is_converting_touch"),
        F.when(converts, F.col("value")).when(~finished, F.lit(0.0)).alias("revenue"))


def cross_device_flag() -> Column:
    """The user switches device and the touch lies in the second half of its path."""
    half = F.floor(F.col("n_touches") / 2)
    return F.col("switches_device") & (F.col("touch_index") >= half)


def suppress_detection(method: str, detected: Column) -> Column:
    """A method's detection with the cases in which it cannot see the touch set to false."""
    blocked = F.lit(False)
    if method == "cookie":
        blocked = blocked | ~F.col("cookies_accepted")
    if method == "referrer":
        blocked = blocked | F.col("has_adblocker")
    if method in ("utm", "referrer"):
        blocked = blocked | (F.col("channel") == "direct")
    retargeting = (F.col("channel") == "google_display_retargeting") & ~F.col("cookies_accepted")
    blocked = blocked | (retargeting & (F.col("touch_index") > 0))
    return F.coalesce(detected & ~blocked, F.lit(False))


def add_tracking(df: DataFrame) -> DataFrame:
    """tracking_* flags from what each method detected (detected_<method>), less what it cannot see."""
    return df.withColumns({
        f"tracking_{m}": suppress_detection(m, F.col(f"detected_{m}"))
        for m in TRACKING_METHODS})


def visibility_flags(df: DataFrame) -> DataFrame:
    """Seen by the analytics tool (cookie or referrer) and by enhanced tracking (all but referrer)."""
    seen = lambda *methods: F.greatest(*[F.col(f"tracking_{m}") for m in methods])
    return df.withColumns({
        "ga4_visible": seen("cookie", "referrer"),
        "enhanced_visible": seen("cookie", "utm", "fingerprint", "server_side")})


def touchpoints(touches: DataFrame) -> DataFrame:
    """The full touchpoint table of the raw touches."""
    df = add_tracking(enrich_channel(build_journeys(touches)))
    df = visibility_flags(df).withColumn("cross_device", cross_device_flag())
    return df.select(
        "user_id", "path_id", "touch_index", "n_touches", "channel", "funnel_position", "date",
        F.col("avg_cpc").alias("cost"), "cookies_accepted", "has_adblocker", "cross_device",
        "ga4_visible", "enhanced_visible", "is_converting_touch",
        *[f"tracking_{m}" for m in TRACKING_METHODS], "revenue")
