"""Tracking loss, journey statistics and attribution insights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attriflux.functions.columns import fixed, half_even, ratio
from attriflux.operators.attribution import find_misattribution as _misattribution_rows
from attriflux.schemas import TRACKING_METHODS


def _seen(flag: str) -> Column:
    return F.count(F.when(F.col(flag), 1))


def tracking_loss_total(df: DataFrame) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("total_touchpoints"),
        _seen("ga4_visible").alias("ga4_visible"),
        _seen("enhanced_visible").alias("enhanced_visible"))
    loss = lambda name: half_even((1 - ratio(F.col(name).cast("double"), "total_touchpoints")) * 100, 1)
    gained = (F.col("enhanced_visible") - F.col("ga4_visible")).cast("double")
    return counts.withColumns({
        "ga4_loss_pct": loss("ga4_visible"),
        "enhanced_loss_pct": loss("enhanced_visible"),
        "recovered_pct": half_even(ratio(gained, "total_touchpoints") * 100, 1)})


def tracking_loss_by_channel(df: DataFrame) -> DataFrame:
    """Rates per channel; loss and recovery follow from the rounded rates."""
    counts = df.filter(F.col("channel").isNotNull()).groupBy("channel").agg(
        F.count("ga4_visible").alias("total_touches"),
        _seen("ga4_visible").alias("ga4_visible"),
        _seen("enhanced_visible").alias("enhanced_visible"))
    rate = lambda name: half_even(ratio(F.col(name).cast("double"), "total_touches") * 100, 1)
    return counts.withColumns({
        "ga4_rate": rate("ga4_visible"), "enhanced_rate": rate("enhanced_visible")}).withColumns({
            "ga4_loss": half_even(F.lit(100.0) - F.col("ga4_rate"), 1),
            "recovered_by_enhanced": half_even(F.col("enhanced_rate") - F.col("ga4_rate"), 1)})


def tracking_method_effectiveness(df: DataFrame) -> DataFrame:
    """Detections per method: one pass of conditional counts, then one row per method."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[
        _seen(f"tracking_{m}").alias(m) for m in TRACKING_METHODS])
    rows = F.array(*[
        F.struct(F.lit(m).alias("method"), F.col(m).alias("detected"), F.col("total"),
                 half_even(ratio(F.col(m).cast("double"), "total") * 100, 1).alias("detected_pct"))
        for m in TRACKING_METHODS])
    return counts.select(F.inline(rows))


def _first_answer(df: DataFrame) -> Column:
    """A user's first known cookie answer, in touch order."""
    order = F.struct(*[c for c in ("path_id", "touch_index") if c in df.columns])
    return F.min_by("cookies_accepted", F.when(F.col("cookies_accepted").isNotNull(), order))


def cookie_rejection_rate(df: DataFrame) -> DataFrame:
    """Share of users whose first known answer is a rejection."""
    users = df.groupBy("user_id").agg(_first_answer(df).alias("accepted"))
    return users.agg(
        F.count(F.lit(1)).alias("users"),
        F.count(F.when(~F.col("accepted"), 1)).alias("rejected"),
    ).withColumn("rejection_pct", half_even(ratio(F.col("rejected").cast("double"), "users") * 100, 1))


def _per_user(df: DataFrame) -> DataFrame:
    return df.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("touches"), F.max("is_converting_touch").alias("converts"),
        F.sum("revenue").alias("revenue"), _seen("ga4_visible").alias("ga4"),
        _seen("enhanced_visible").alias("enhanced"))


def journey_stats(df: DataFrame) -> DataFrame:
    stats = _per_user(df).agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count(F.when(F.col("converts"), 1)).alias("converting_users"),
        F.sum("touches").alias("total_touchpoints"),
        F.sum("ga4").alias("ga4_visible"), F.sum("enhanced").alias("enhanced_visible"))
    pct = lambda name, of: half_even(ratio(F.col(name).cast("double"), of) * 100, 1)
    return stats.withColumns({
        "conversion_pct": pct("converting_users", "total_users"),
        "avg_touchpoints": half_even(ratio(F.col("total_touchpoints").cast("double"), "total_users"), 1),
        "ga4_pct": pct("ga4_visible", "total_touchpoints"),
        "enhanced_pct": pct("enhanced_visible", "total_touchpoints")})


def conversion_summary(df: DataFrame) -> DataFrame:
    totals = _per_user(df).agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count(F.when(F.col("converts"), 1)).alias("converting_users"),
        half_even(F.coalesce(F.sum("revenue"), F.lit(0.0)), 2).alias("total_revenue"))
    return totals.withColumn(
        "conversion_rate", half_even(ratio(F.col("converting_users").cast("double"), "total_users") * 100, 1))


def attribution_insights(df: DataFrame, results: DataFrame) -> DataFrame:
    """One nested row: headline, tracking, most under- and overvalued channel, totals.

    One pass per user gives every journey figure. The one-row frames are
    stacked and folded together. Equal differences are settled by name: the
    first is the most undervalued, the last the most overvalued.
    """
    users = df.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("touches"), F.max("is_converting_touch").alias("converts"),
        F.sum("revenue").alias("revenue"), _seen("ga4_visible").alias("ga4"),
        _seen("enhanced_visible").alias("enhanced"), _first_answer(df).alias("accepted"))
    number = lambda c: c.cast("double")
    touches, n_users = F.sum("touches"), F.count(F.lit(1))
    converting = F.count(F.when(F.col("converts"), 1))
    figures = users.agg(
        half_even((1 - ratio(number(F.sum("ga4")), touches)) * 100, 1).alias("loss"),
        half_even(ratio(number(F.sum("enhanced") - F.sum("ga4")), touches) * 100, 1).alias("recovered"),
        half_even(ratio(number(F.count(F.when(~F.col("accepted"), 1))), n_users) * 100, 1).alias("rejected"),
        n_users.alias("total_users"), converting.alias("converting_users"),
        half_even(ratio(number(converting), n_users) * 100, 1).alias("rate"),
        half_even(F.coalesce(F.sum("revenue"), F.lit(0.0)), 2).alias("total_revenue"))

    entry = F.struct(
        (-F.col("pct_difference")).alias("falling"), "channel", "last_click_pct", "shapley_pct",
        F.col("pct_difference").alias("difference"))
    extremes = _misattribution_rows(results).agg(F.min(entry).alias("under"), F.max(entry).alias("over"))
    one = figures.unionByName(extremes, allowMissingColumns=True)
    one = one.agg(*[F.max(c).alias(c) for c in one.columns])

    percent = lambda c: F.concat(fixed(F.col(c), 1), F.lit("%"))
    headline = F.concat(
        F.lit("Last-click attribution misallocates revenue: "), F.col("under.channel"),
        F.lit(" is undervalued by "), fixed(F.col("under.difference"), 1, signed=True),
        F.lit("pp, while "), F.col("over.channel"), F.lit(" is overvalued by "),
        fixed(F.abs("over.difference"), 1), F.lit("pp."))
    side = lambda s: F.struct(*[
        F.col(f"{s}.{c}").alias(c) for c in ("channel", "last_click_pct", "shapley_pct", "difference")])
    return one.select(
        headline.alias("headline"),
        F.struct(percent("loss").alias("ga4_data_loss"),
                 percent("recovered").alias("enhanced_recovery"),
                 percent("rejected").alias("cookie_rejection_rate")).alias("tracking"),
        F.struct(side("under").alias("most_undervalued"), side("over").alias("most_overvalued")).alias("attribution"),
        F.struct("total_users", "converting_users", percent("rate").alias("conversion_rate"),
                 "total_revenue").alias("summary"))


def insights_json(insights: DataFrame) -> DataFrame:
    return insights.select(F.to_json(F.struct("*")).alias("insights"))
