"""Raw platform payloads (one JSON text per row) to unified facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attriflux.schemas import (
    GA4_PAYLOAD, GOOGLE_PAYLOAD, META_PAYLOAD, TIKTOK_PAYLOAD, UNIFIED_COLUMNS)
from attriflux.sources.facts import REJECTS, rejects, without_rejects

# How platform conversions are shared between leads and orders.
GOOGLE_LEAD_SHARE, GOOGLE_ORDER_SHARE = 0.6, 0.4
TIKTOK_LEAD_SHARE, TIKTOK_ORDER_SHARE = 0.4, 0.6
GA4_LEAD_SHARE = 0.6
GA4_IMPRESSIONS_PER_SESSION = 10


def _whole(value: Column) -> Column:
    return value.cast("double").try_cast("bigint")


def _last_value(entries: Column, action_type: str) -> Column:
    """The last value listed for an action type, since later entries replace earlier ones."""
    hits = F.filter(entries, lambda e: e["action_type"] == F.lit(action_type))
    return F.try_element_at(hits, F.lit(-1))["value"]


def _unified(df: DataFrame, source: str, texts: dict[str, tuple[Column, Column]], keep_rejects: bool, **columns: Column) -> DataFrame:
    """The unified columns. Rows with a text that is no number or date are left out, or kept with what they are in ``_rejects``."""
    columns["source"] = F.lit(source)
    out = df.select([columns[c].alias(c) for c in UNIFIED_COLUMNS] + [rejects(texts).alias(REJECTS)])
    return out if keep_rejects else without_rejects(out)


def normalise_google_ads(raw: DataFrame, payload: str = "payload", keep_rejects: bool = False) -> DataFrame:
    p = F.from_json(F.col(payload), GOOGLE_PAYLOAD)
    df = raw.select(p.alias("p"))
    conversions = F.col("p.metrics.conversions")
    day = F.col("p.segments.date").try_cast("date")
    return _unified(
        df, "google_ads", {"c_date": (F.col("p.segments.date"), day)}, keep_rejects,
        campaign_name=F.col("p.campaign.name"),
        c_date=day,
        impressions=F.col("p.metrics.impressions"),
        clicks=F.col("p.metrics.clicks"),
        mark_spent=F.col("p.metrics.cost_micros") / F.lit(1000000.0),
        leads=_whole(conversions * F.lit(GOOGLE_LEAD_SHARE)),
        orders=_whole(conversions * F.lit(GOOGLE_ORDER_SHARE)),
        revenue=F.col("p.metrics.conversions_value"))


def normalise_meta_ads(raw: DataFrame, payload: str = "payload", keep_rejects: bool = False) -> DataFrame:
    df = raw.select(F.from_json(F.col(payload), META_PAYLOAD).alias("p"))
    texts = {
        "impressions": (F.col("p.impressions"), "bigint"), "clicks": (F.col("p.clicks"), "bigint"), "mark_spent": (F.col("p.spend"), "double"),
        "leads": (_last_value(F.col("p.actions"), "lead"), "bigint"), "orders": (_last_value(F.col("p.actions"), "purchase"), "bigint"),
        "revenue": (_last_value(F.col("p.action_values"), "purchase"), "double"), "c_date": (F.col("p.date_start"), "date")}
    read = {c: t.try_cast(kind) for c, (t, kind) in texts.items()}
    zero = lambda c: F.coalesce(read[c], F.lit(0).cast(texts[c][1]))
    return _unified(
        df, "meta_ads", {c: (texts[c][0], read[c]) for c in texts}, keep_rejects,
        campaign_name=F.col("p.campaign_name"), c_date=read["c_date"], impressions=read["impressions"], clicks=zero("clicks"),
        mark_spent=read["mark_spent"], leads=zero("leads"), orders=zero("orders"), revenue=zero("revenue"))


def normalise_tiktok_ads(raw: DataFrame, payload: str = "payload", keep_rejects: bool = False) -> DataFrame:
    df = raw.select(F.from_json(F.col(payload), TIKTOK_PAYLOAD).alias("p"))
    texts = {
        "conversion": (F.col("p.metrics.conversion"), "double"), "spend": (F.col("p.metrics.spend"), "double"),
        "complete_payment_roas": (F.col("p.metrics.complete_payment_roas"), "double"),
        "impressions": (F.col("p.metrics.impressions"), "bigint"), "clicks": (F.col("p.metrics.clicks"), "bigint"),
        "c_date": (F.substring("p.dimensions.stat_time_day", 1, 10), "date")}
    read = {c: t.try_cast(kind) for c, (t, kind) in texts.items()}
    return _unified(
        df, "tiktok_ads", {c: (texts[c][0], read[c]) for c in texts}, keep_rejects,
        campaign_name=F.col("p.metrics.campaign_name"),
        c_date=read["c_date"], impressions=read["impressions"], clicks=read["clicks"], mark_spent=read["spend"],
        leads=_whole(read["conversion"] * F.lit(TIKTOK_LEAD_SHARE)),
        orders=_whole(read["conversion"] * F.lit(TIKTOK_ORDER_SHARE)),
        revenue=read["spend"] * F.coalesce(read["complete_payment_roas"], F.lit(0.0)))


def normalise_ga4(raw: DataFrame, payload: str = "payload", keep_rejects: bool = False) -> DataFrame:
    """Positional values: (date, source/medium, campaign) and (sessions, users, conversions, revenue, purchases)."""
    df = raw.select(F.from_json(F.col(payload), GA4_PAYLOAD).alias("p"))
    dim = lambda i: F.element_at("p.dimension_values", i)
    met = lambda i: F.element_at("p.metric_values", i)
    texts = {"sessions": (met(1), "bigint"), "conversions": (met(3), "double"), "revenue": (met(4), "double"), "orders": (met(5), "bigint")}
    read = {c: t.try_cast(kind) for c, (t, kind) in texts.items()}
    day = F.try_to_date(dim(1), "yyyyMMdd")
    checks = {c: (texts[c][0], read[c]) for c in texts} | {"c_date": (dim(1), day)}
    name = F.concat(F.lit("ga4_"), dim(3), F.lit("_"), dim(2))
    return _unified(
        df, "ga4", checks, keep_rejects,
        campaign_name=F.lower(F.replace(name, F.lit(" "), F.lit("_"))),
        c_date=day,
        impressions=read["sessions"] * F.lit(GA4_IMPRESSIONS_PER_SESSION),
        clicks=read["sessions"],
        leads=_whole(read["conversions"] * F.lit(GA4_LEAD_SHARE)),
        orders=read["orders"],
        mark_spent=F.lit(0.0),
        revenue=read["revenue"])


NORMALISERS = {
    "google_ads": normalise_google_ads,
    "meta_ads": normalise_meta_ads,
    "tiktok_ads": normalise_tiktok_ads,
    "ga4": normalise_ga4,
}
