"""Reporting queries over the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attriflux.functions.columns import half_even, ratio
from attriflux.operators.features import order_columns

# Columns shown for an anomaly.
ANOMALY_COLUMNS = [
    "c_date", "campaign_name", "category", "roas", "ctr", "cpc", "roas_wow", "ctr_wow", "spend_wow"]


def _is_anomaly() -> Column:
    return F.col("is_anomaly") == 1


def _anomaly_count() -> Column:
    return F.count(F.when(_is_anomaly(), 1))


def filter_campaigns(df: DataFrame, campaign: str | None = None, category: str | None = None,
                     anomalies_only: bool = False) -> DataFrame:
    if campaign:
        df = df.filter(F.col("campaign_name") == campaign)
    if category:
        df = df.filter(F.col("category") == category)
    return df.filter(_is_anomaly()) if anomalies_only else df


def list_anomalies(df: DataFrame) -> DataFrame:
    """All columns of the anomalous rows, latest first."""
    return df.filter(_is_anomaly()).orderBy(F.desc("c_date"), "campaign_name")


def anomaly_totals(df: DataFrame, campaign: str | None = None) -> DataFrame:
    """Listed anomalies, all rows and the rate in percent (0 for an empty table)."""
    listed = F.count(F.when(_is_anomaly() & (F.col("campaign_name") == campaign), 1)) if campaign else _anomaly_count()
    totals = df.agg(listed.alias("n_anomalies"), F.count(F.lit(1)).alias("total_rows"))
    rate = F.coalesce(ratio(F.col("n_anomalies").cast("double"), "total_rows"), F.lit(0.0)) * 100
    return totals.withColumn("anomaly_rate", half_even(rate, 1))


def list_anomalies_projected(df: DataFrame, campaign: str | None = None) -> DataFrame:
    shown = [c for c in ANOMALY_COLUMNS if c in df.columns]
    return list_anomalies(filter_campaigns(df, campaign)).select(shown)


def distinct_campaigns(df: DataFrame) -> DataFrame:
    return df.filter(F.col("campaign_name").isNotNull()).select("campaign_name").distinct().orderBy("campaign_name")


def _per_campaign(df: DataFrame) -> DataFrame:
    """Partial sums per campaign from which every overall figure can be put together."""
    sums = []
    for metric in ("roas", "ctr", "cpc", "conversion_rate"):
        sums += [F.sum(metric).alias(f"{metric}_sum"), F.count(metric).alias(f"{metric}_n")]
    return df.groupBy("campaign_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_anomaly").alias("anomalies"),
        F.min("c_date").alias("first_day"), F.max("c_date").alias("last_day"),
        F.avg("roas").alias("avg_roas"), *sums)


def summary(df: DataFrame) -> DataFrame:
    """One row: volume, date range, mean metrics, anomalies, best and worst campaign by mean ROAS.

    Facts are reduced per campaign once; the overall figures and the two
    extremes come from that, with no distinct count over the raw rows. The
    sorted names are ``distinct_campaigns``, a table rather than one cell,
    since their number has no limit.
    """
    def mean(metric):
        return half_even(ratio(F.sum(f"{metric}_sum"), F.sum(f"{metric}_n")), 4)

    named = F.col("campaign_name").isNotNull() & F.col("avg_roas").isNotNull()
    rank = F.when(named, F.struct("avg_roas", "campaign_name"))
    out = _per_campaign(df).agg(
        F.sum("n").alias("total_rows"),
        F.count("campaign_name").alias("unique_campaigns"),
        F.min("first_day").alias("start_date"),
        F.max("last_day").alias("end_date"),
        mean("roas").alias("avg_roas"), mean("ctr").alias("avg_ctr"), mean("cpc").alias("avg_cpc"),
        mean("conversion_rate").alias("avg_conversion_rate"),
        F.sum("anomalies").alias("anomaly_count"),
        half_even(ratio(F.sum("anomalies").cast("double"), F.sum("n")) * 100, 1).alias("anomaly_rate"),
        F.max(rank).alias("best"), F.min(rank).alias("worst"))
    return out.select(
        *[c for c in out.columns if c not in ("best", "worst")],
        F.col("best.campaign_name").alias("best_campaign"),
        half_even("best.avg_roas", 4).alias("best_avg_roas"),
        F.col("worst.campaign_name").alias("worst_campaign"),
        half_even("worst.avg_roas", 4).alias("worst_avg_roas"))


def best_worst_campaign(df: DataFrame) -> DataFrame:
    """The campaigns with the highest and the lowest mean ROAS; equal means are settled by name."""
    out = summary(df)
    pair = F.array(
        F.struct(F.lit("best").alias("kind"), F.col("best_campaign").alias("campaign_name"),
                 F.col("best_avg_roas").alias("avg_roas")),
        F.struct(F.lit("worst").alias("kind"), F.col("worst_campaign").alias("campaign_name"),
                 F.col("worst_avg_roas").alias("avg_roas")))
    return out.select(F.inline(pair))


def campaign_summary(df: DataFrame, campaign: str) -> DataFrame:
    """One row of totals for a campaign; no row if there is no such campaign."""
    first = F.min_by("category", F.struct(*order_columns(df)))
    return df.filter(F.col("campaign_name") == campaign).groupBy("campaign_name").agg(
        first.alias("category"), F.count(F.lit(1)).alias("total_entries"),
        F.min("c_date").alias("start_date"), F.max("c_date").alias("end_date"),
        half_even(F.avg("roas"), 4).alias("avg_roas"), half_even(F.avg("ctr"), 4).alias("avg_ctr"),
        half_even(F.avg("cpc"), 4).alias("avg_cpc"),
        half_even(F.sum("mark_spent"), 2).alias("total_spent"),
        half_even(F.sum("revenue"), 2).alias("total_revenue"),
        F.sum("is_anomaly").alias("anomalies"))


def campaign_detail(df: DataFrame, campaign: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals, the campaign's rows, names to offer when the campaign is not found)."""
    rows = df.filter(F.col("campaign_name") == campaign).orderBy("c_date")
    found = rows.select(F.lit(campaign).alias("wanted")).distinct()
    names = distinct_campaigns(df).withColumn("wanted", F.lit(campaign))
    available = names.join(F.broadcast(found), "wanted", "left_anti").select("campaign_name")
    return campaign_summary(df, campaign), rows, available


def roas_by_campaign(df: DataFrame) -> DataFrame:
    return df.filter(F.col("campaign_name").isNotNull()).groupBy("campaign_name").agg(
        F.avg("roas").alias("roas")).orderBy("roas", "campaign_name")


def anomalies_by_campaign(df: DataFrame) -> DataFrame:
    return df.filter(_is_anomaly() & F.col("campaign_name").isNotNull()).groupBy("campaign_name").agg(
        F.count(F.lit(1)).alias("anomalies")).orderBy("anomalies", "campaign_name")


def campaign_metrics_summary(df: DataFrame, campaign: str | None = None) -> DataFrame:
    return filter_campaigns(df, campaign).filter(F.col("campaign_name").isNotNull()).groupBy("campaign_name").agg(
        half_even(F.avg("roas"), 4).alias("avg_roas"),
        half_even(F.avg("ctr"), 4).alias("avg_ctr"),
        half_even(F.avg("cpc"), 4).alias("avg_cpc"),
        half_even(F.avg("conversion_rate"), 4).alias("avg_conv_rate"),
        half_even(F.sum("mark_spent"), 4).alias("total_spend"),
        half_even(F.sum("revenue"), 4).alias("total_revenue"),
        F.sum("is_anomaly").alias("anomalies")).orderBy("campaign_name")


def metric_timeseries(df: DataFrame, campaign: str | None = None) -> DataFrame:
    return filter_campaigns(df, campaign).select("c_date", "campaign_name", "roas", "ctr").orderBy(
        "campaign_name", "c_date")


def kpi_cards(df: DataFrame) -> DataFrame:
    per_campaign = _per_campaign(df)
    return per_campaign.agg(
        F.sum("n").alias("total_records"),
        F.count("campaign_name").alias("campaigns"),
        F.sum("anomalies").alias("anomalies"),
        half_even(ratio(F.sum("anomalies").cast("double"), F.sum("n")) * 100, 1).alias("anomaly_pct"),
        half_even(ratio(F.sum("roas_sum"), F.sum("roas_n")), 2).alias("avg_roas"))


def model_leaderboard(metrics: DataFrame, metric: str, highest: bool, order: list[str]) -> DataFrame:
    """Long metrics (model, metric, value), one row per model and metric, with the best model flagged.

    ``order`` is the order in which models were declared: the first one wins
    a tie. The window holds one row per model.
    """
    position = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    value = F.desc("value") if highest else F.asc("value")
    ranked = metrics.filter(F.col("metric") == metric).withColumn(
        "rank", F.row_number().over(Window.partitionBy("metric").orderBy(value, position)))
    best = ranked.select("model", (F.col("rank") == 1).alias("is_best"), F.col("rank").alias("model_rank"))
    return metrics.join(best, "model")
