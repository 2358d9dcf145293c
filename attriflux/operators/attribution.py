"""Five multi-touch attribution models and their comparison.

All models start from one compact table: touches summed per (journey,
channel, date). Sums are partial on the map side, so a journey with any
number of touches leaves its task as (channels x dates) rows, and no list of
touches is ever built. All five models come out of one pass over that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attriflux.functions.columns import half_even, ratio
from attriflux.schemas import ATTRIBUTION_MODELS

VERDICT_POINTS = 3.0   # percentage points beyond which a channel counts as misvalued


def journey_keys(df: DataFrame) -> list[str]:
    """A journey is a user's path, or the user where the table has one path per user."""
    return ["user_id", "path_id"] if "path_id" in df.columns else ["user_id"]


def journey_channels(df: DataFrame, decay_rate: float = 0.5) -> DataFrame:
    """One row per converting journey and channel with everything the five models need."""
    keys = journey_keys(df)
    conv = F.col("is_converting_touch")
    first = F.min(F.when(F.col("channel").isNotNull(), F.col("touch_index")))
    daily = df.groupBy(*keys, "channel", "date").agg(
        F.count(F.lit(1)).alias("touches"),
        first.alias("first_index"),
        F.max(F.when(conv, F.col("date"))).alias("conv_date"),
        F.sum(F.when(conv, F.col("revenue"))).alias("conv_revenue"),
        F.count(F.when(conv, F.col("revenue"))).alias("conv_valued"),
        F.max(conv).alias("converts"))

    # per journey there are at most (channels x dates) rows from here on
    journey = Window.partitionBy(*keys)
    daily = daily.withColumns({
        "journey_converts": F.max("converts").over(journey),
        "journey_date": F.max("conv_date").over(journey),
        "journey_revenue": F.sum("conv_revenue").over(journey),
        "journey_valued": F.sum("conv_valued").over(journey),
        "journey_first": F.min("first_index").over(journey),
        "journey_touches": F.sum("touches").over(journey)}).filter("journey_converts")
    daily = daily.withColumn(
        "weight", F.col("touches") * F.pow(F.lit(float(decay_rate)), F.datediff("journey_date", "date")))

    per_channel = daily.groupBy(*keys, "channel").agg(
        F.sum("touches").alias("touches"),
        F.sum("weight").alias("weight"),
        F.min("first_index").alias("first_index"),
        F.sum("conv_revenue").alias("conv_revenue"),
        F.sum("conv_valued").alias("conv_valued"),
        F.max("converts").alias("converts"),
        *[F.max(c).alias(c) for c in
          ("journey_revenue", "journey_valued", "journey_first", "journey_touches")])
    return per_channel.withColumns({
        "journey_weight": F.sum("weight").over(journey),
        "journey_channels": F.count("channel").over(journey)})


def _shares(models: list[str]) -> Column:
    """Per model: the row's revenue and conversions, or null where the model gives the row nothing."""
    revenue, one = F.col("journey_revenue"), F.lit(1).cast("bigint")
    is_first = F.col("first_index") == F.col("journey_first")
    per_model = {
        "last_click": (F.col("conv_revenue"), F.col("conv_valued"), F.col("converts")),
        "first_click": (revenue, F.col("journey_valued"), is_first),
        "linear": (revenue * F.col("touches") / F.col("journey_touches"), one, F.lit(True)),
        "time_decay": (revenue * F.col("weight") / F.col("journey_weight"), one, F.lit(True)),
        "shapley": (revenue / F.col("journey_channels"), one, F.lit(True)),
    }
    structs = [
        F.when(applies, F.struct(
            F.lit(m).alias("model"), share.cast("double").alias("share"), count.alias("count")))
        for m, (share, count, applies) in ((m, per_model[m]) for m in models)]
    return F.array_compact(F.array(*structs))


def attribution(df: DataFrame, models: list[str] = ATTRIBUTION_MODELS, decay_rate: float = 0.5) -> DataFrame:
    """(model, channel, attributed_revenue, conversions) for the models asked for, in one pass.

    Shapley is exact. The value of a set of channels is the revenue of the
    journeys that stay inside it, which is a sum of unanimity games: each
    journey's revenue is shared equally by its distinct channels. This
    replaces the sum over all subsets, and any cap on the users in it.
    """
    frame = journey_channels(df, decay_rate).filter(F.col("channel").isNotNull())
    shares = frame.select("channel", F.inline(_shares(list(models))))
    out = shares.groupBy("model", "channel").agg(
        F.coalesce(F.sum("share"), F.lit(0.0)).alias("revenue"), F.sum("count").alias("conversions"))
    revenue = F.when(F.col("model") == "shapley", half_even("revenue", 2)).otherwise(F.col("revenue"))
    return out.select("channel", revenue.alias("attributed_revenue"), "conversions", "model")


def last_click(df: DataFrame) -> DataFrame:
    """All credit to the converting touch. Needs no journey: one aggregation over the touches."""
    return df.filter(F.col("is_converting_touch") & F.col("channel").isNotNull()).groupBy("channel").agg(
        F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("attributed_revenue"),
        F.count("revenue").alias("conversions")).withColumn("model", F.lit("last_click"))


def first_click(df: DataFrame) -> DataFrame:
    return attribution(df, ["first_click"])


def linear(df: DataFrame) -> DataFrame:
    return attribution(df, ["linear"])


def time_decay(df: DataFrame, decay_rate: float = 0.5) -> DataFrame:
    return attribution(df, ["time_decay"], decay_rate)


def shapley(df: DataFrame) -> DataFrame:
    return attribution(df, ["shapley"])


def compare_models(results: DataFrame) -> DataFrame:
    """Channel x model revenue and percentage columns (percentages from the rounded revenue).

    The windows below run over the channel dimension, a handful of rows.
    """
    pivot = results.groupBy("channel").pivot("model", ATTRIBUTION_MODELS).agg(F.sum("attributed_revenue"))
    pivot = pivot.select("channel", *[
        half_even(F.coalesce(F.col(m), F.lit(0.0)), 2).alias(m) for m in ATTRIBUTION_MODELS])
    everything = Window.partitionBy(F.lit(1))
    total = lambda m: F.sum(m).over(everything)
    return pivot.withColumns({
        f"{m}_pct": F.when(total(m) > 0, half_even(F.col(m) / F.nullif(total(m), F.lit(0.0)) * 100, 1))
        for m in ATTRIBUTION_MODELS})


def find_misattribution(results: DataFrame) -> DataFrame:
    """Last click against Shapley per channel: shares, difference and verdict, largest difference first."""
    def revenue_of(model):
        return F.coalesce(F.sum(F.when(F.col("model") == model, F.col("attributed_revenue"))), F.lit(0.0))

    # both sides in one aggregation: a channel known to one model only gets 0 from the other
    both = results.filter(F.col("model").isin("last_click", "shapley")).groupBy("channel").agg(
        revenue_of("last_click").alias("last_click_revenue"), revenue_of("shapley").alias("shapley_revenue"))
    everything = Window.partitionBy(F.lit(1))

    def share(name):
        total = F.sum(name).over(everything)
        return F.when(total > 0, half_even(F.col(name) / F.nullif(total, F.lit(0.0)) * 100, 1)).otherwise(0.0)

    both = both.withColumns({
        "last_click_pct": share("last_click_revenue"), "shapley_pct": share("shapley_revenue")})
    both = both.withColumn("pct_difference", half_even(F.col("shapley_pct") - F.col("last_click_pct"), 1))
    verdict = (
        F.when(F.col("pct_difference") > VERDICT_POINTS, "UNDERVALUED by last-click")
        .when(F.col("pct_difference") < -VERDICT_POINTS, "OVERVALUED by last-click")
        .otherwise("Fairly valued"))
    return both.withColumn("verdict", verdict).orderBy(F.desc("pct_difference"), "channel")
