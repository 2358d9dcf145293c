"""Registered queries on sources, features and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attriflux.catalog.inputs import (
    DOUBLE_COLUMNS, FACT_COLUMNS, FEATURE_COLUMNS, columns_sql, event_facts, once, r, sales_facts, sales_features, sql)
from attriflux.functions.columns import half_even, rounded
from attriflux.operators import features as fe
from attriflux.operators import reports as rep
from attriflux.schemas import UNIFIED_COLUMNS
from attriflux.session import fresh_path
from attriflux.sources import facts as fs
from attriflux.sources import platforms as pf

KEY = ["source", "campaign_name", "c_date"]
MONEY = ["mark_spent", "revenue"]
SOME_CAMPAIGN = "Supplier#000000003"
SOME_CATEGORY = "NATION_3"

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLE[name] = oracle
        return function
    return add


# ---- raw payloads made from the sales facts, one JSON text per fact ----

def google_raw(spark: SparkSession, folder: str) -> DataFrame:
    payload = F.to_json(F.struct(
        F.struct(F.col("campaign_name").alias("name")).alias("campaign"),
        F.struct(F.col("c_date").cast("string").alias("date")).alias("segments"),
        F.struct("impressions", "clicks",
                 F.round(F.col("mark_spent") * 1000000).cast("bigint").alias("cost_micros"),
                 (F.col("leads") * F.lit(1.1)).alias("conversions"),
                 F.col("revenue").alias("conversions_value")).alias("metrics")))
    return sales_facts(spark, folder).select(payload.alias("payload"))


def _entry(kind: str, value) -> F.Column:
    return F.struct(F.lit(kind).alias("action_type"), value.cast("string").alias("value"))


def meta_raw(spark: SparkSession, folder: str) -> DataFrame:
    """A lead entry appears twice: the later one counts. Facts without orders have no purchase entry."""
    actions = F.array(_entry("link_click", F.col("clicks")), _entry("lead", F.col("leads")),
                      _entry("lead", F.col("leads") + 1))
    ordered = F.col("orders") > 0
    payload = F.to_json(F.struct(
        "campaign_name", F.col("c_date").cast("string").alias("date_start"),
        F.col("impressions").cast("string").alias("impressions"), F.col("clicks").cast("string").alias("clicks"),
        F.col("mark_spent").cast("string").alias("spend"),
        F.when(ordered, F.array_append(actions, _entry("purchase", F.col("orders")))).otherwise(actions).alias("actions"),
        F.when(ordered, F.array(_entry("purchase", F.col("revenue")))).alias("action_values")))
    return sales_facts(spark, folder).select(payload.alias("payload"))


def tiktok_raw(spark: SparkSession, folder: str) -> DataFrame:
    text = lambda c: c.cast("string")
    payload = F.to_json(F.struct(
        F.struct("campaign_name", text(F.col("impressions")).alias("impressions"), text(F.col("clicks")).alias("clicks"),
                 text(F.col("mark_spent")).alias("spend"), text(F.col("leads") + F.col("orders")).alias("conversion"),
                 F.when(F.col("orders") > 0, text(F.col("leads") / F.lit(4.0))).alias("complete_payment_roas")).alias("metrics"),
        F.struct(F.concat(text(F.col("c_date")), F.lit(" 00:00:00")).alias("stat_time_day")).alias("dimensions")))
    return sales_facts(spark, folder).select(payload.alias("payload"))


def ga4_raw(spark: SparkSession, folder: str) -> DataFrame:
    text = lambda c: c.cast("string")
    payload = F.to_json(F.struct(
        F.array(F.date_format("c_date", "yyyyMMdd"), F.concat(F.col("source"), F.lit(" / cpc")),
                F.col("campaign_name")).alias("dimension_values"),
        F.array(text(F.col("clicks")), text(F.col("impressions")), text(F.col("leads") * F.lit(1.5)),
                text(F.col("revenue")), text(F.col("orders"))).alias("metric_values")))
    return sales_facts(spark, folder).select(payload.alias("payload"))


_normalised = {
    "google_ads": """SELECT 'google_ads' AS source, campaign_name, c_date, impressions, clicks,
  CAST(trunc(leads * 1.1::DOUBLE * 0.6::DOUBLE) AS BIGINT) AS leads, CAST(trunc(leads * 1.1::DOUBLE * 0.4::DOUBLE) AS BIGINT) AS orders,
  CAST(CAST(round(mark_spent * 1000000) AS BIGINT) AS DOUBLE) / 1000000 AS mark_spent, revenue FROM sales""",
    "meta_ads": """SELECT 'meta_ads' AS source, campaign_name, c_date, impressions, clicks, leads + 1 AS leads, orders,
  mark_spent, CASE WHEN orders > 0 THEN revenue ELSE 0 END AS revenue FROM sales""",
    "tiktok_ads": """SELECT 'tiktok_ads' AS source, campaign_name, c_date, impressions, clicks,
  CAST(trunc(CAST(leads + orders AS DOUBLE) * 0.4::DOUBLE) AS BIGINT) AS leads,
  CAST(trunc(CAST(leads + orders AS DOUBLE) * 0.6::DOUBLE) AS BIGINT) AS orders,
  mark_spent, CASE WHEN orders > 0 THEN mark_spent * (CAST(leads AS DOUBLE) / 4) ELSE 0 END AS revenue FROM sales""",
    "ga4": """SELECT 'ga4' AS source, lower(replace('ga4_' || campaign_name || '_' || source || ' / cpc', ' ', '_')) AS campaign_name,
  c_date, clicks * 10 AS impressions, clicks, CAST(trunc(CAST(leads AS DOUBLE) * 1.5::DOUBLE * 0.6::DOUBLE) AS BIGINT) AS leads,
  orders, 0::DOUBLE AS mark_spent, revenue FROM sales""",
}
PAYLOADS = {"google_ads": google_raw, "meta_ads": meta_raw, "tiktok_ads": tiktok_raw, "ga4": ga4_raw}


def landed(spark: SparkSession, folder: str, platform: str) -> DataFrame:
    """A platform's raw export as it lands: one JSON text per line, written once per session."""
    def land():
        path = fresh_path(spark, f"landed-{platform}")
        PAYLOADS[platform](spark, folder).write.text(path)
        return path
    return spark.read.text(once(spark, folder, f"landed-{platform}", land)).withColumnRenamed("value", "payload")


_unified_list = columns_sql(UNIFIED_COLUMNS, MONEY, 4)


def _register_normalisers() -> None:
    for platform in PAYLOADS:
        def run(spark, folder, platform=platform):
            return rounded(pf.NORMALISERS[platform](landed(spark, folder, platform)), 4)
        register(f"normalise_{platform}", sql(f"SELECT {_unified_list} FROM ({_normalised[platform]})", "sales"))(run)


_register_normalisers()


# ---- sources and sinks ----

@register("load_campaigns", sql(f"SELECT {columns_sql(FACT_COLUMNS, MONEY, 4)} FROM sales", "sales"))
def load_campaigns(spark, folder):
    """Facts saved as CSV with unclean headers, read back and normalised."""
    path = fresh_path(spark, "campaigns")
    df = sales_facts(spark, folder)
    fs.save_table(df.toDF(*[f" {c.upper()}" for c in df.columns]), path, "csv")
    return rounded(fs.load_campaigns(spark, path).select(FACT_COLUMNS), 4)


@register("save_features", sql(f"SELECT {columns_sql(FEATURE_COLUMNS, DOUBLE_COLUMNS)} FROM features", "features"))
def save_features(spark, folder):
    path = fresh_path(spark, "features")
    fs.save_table(sales_features(spark, folder), path, partition_by=["source"])
    return rounded(fs.load_features(spark, path).select(FEATURE_COLUMNS))


@register("load_features", sql(
    f"SELECT {columns_sql(KEY + ['roas', 'is_anomaly'], ['roas'])} FROM features WHERE is_anomaly = 1", "features"))
def load_features(spark, folder):
    """A feature table read back for the columns and rows that are asked for."""
    path = fresh_path(spark, "features")
    fs.save_table(sales_features(spark, folder), path)
    return rounded(fs.load_features(spark, path).filter("is_anomaly = 1").select(*KEY, "roas", "is_anomaly"))


@register("save_range", sql(f"""SELECT {columns_sql(FACT_COLUMNS, MONEY, 4)} FROM (
  SELECT * FROM sales WHERE c_date < DATE '1995-01-01' OR c_date > DATE '1995-06-30'
  UNION ALL SELECT * REPLACE (clicks + 1 AS clicks) FROM sales WHERE c_date BETWEEN DATE '1995-01-01' AND DATE '1995-06-30' AND leads % 2 = 0)
WHERE c_date BETWEEN DATE '1994-10-01' AND DATE '1995-09-30'""", "sales"))
def save_range(spark, folder):
    """A year saved by day, half of it replaced twice, and three quarters of the whole read back."""
    path, facts = fresh_path(spark, "by-day"), sales_facts(spark, folder)
    fs.save_range(facts, path, "1994-07-01", "1995-12-31")
    newer = facts.filter("leads % 2 = 0").withColumn("clicks", F.col("clicks") + 1)
    for _ in range(2):
        fs.save_range(newer, path, "1995-01-01", "1995-06-30")
    out = fs.load_range(spark, path, facts.schema, "1994-10-01", "1995-09-30")
    return rounded(out.select(FACT_COLUMNS), 4)


@register("fetch_date_range", sql(
    f"SELECT {columns_sql(FACT_COLUMNS, MONEY, 4)} FROM webfacts WHERE c_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'",
    "webfacts"))
def fetch_date_range(spark, folder):
    return rounded(fs.fetch_date_range(event_facts(spark, folder), "2024-01-08", "2024-01-21"), 4)


@register("validate_unified", sql(f"""SELECT {_unified_list} FROM (
  SELECT 'shop' AS source, campaign_name, c_date, impressions, clicks, leads, orders, mark_spent,
    CASE WHEN orders > 0 THEN revenue ELSE 0 END AS revenue FROM sales)""", "sales"))
def validate_unified(spark, folder):
    """Columns out of order, dates as text and missing revenue, brought under the contract."""
    df = sales_facts(spark, folder)
    untidy = df.select(
        F.when(F.col("orders") > 0, F.col("revenue")).alias("revenue"), F.col("c_date").cast("string").alias("c_date"),
        *[c for c in df.columns if c not in ("revenue", "c_date")])
    return rounded(fs.validate_unified(untidy, "shop"), 4)


def _combined(spark, folder):
    frames = {name: (lambda n=name: pf.NORMALISERS[n](landed(spark, folder, n))) for name in PAYLOADS}
    frames["web"] = lambda: event_facts(spark, folder)
    frames["incomplete"] = lambda: event_facts(spark, folder).drop("revenue")   # left out and reported
    combined, errors = fs.combine_sources(frames)
    assert [e["connector"] for e in errors] == ["incomplete"]
    return combined


_stack = " UNION ALL ".join(f"({q})" for q in _normalised.values()) + (
    f" UNION ALL (SELECT {', '.join(UNIFIED_COLUMNS)} FROM webfacts)")


@register("combine_sources", sql(f"SELECT {_unified_list} FROM ({_stack})", "sales", "webfacts"))
def combine_sources(spark, folder):
    return rounded(_combined(spark, folder), 4)


@register("save_combined", sql(f"SELECT {_unified_list} FROM ({_stack})", "sales", "webfacts"))
def save_combined(spark, folder):
    path = fresh_path(spark, "combined")
    fs.save_table(_combined(spark, folder), path)
    return rounded(spark.read.parquet(path), 4)


# Every so many orders one value of a source is spoilt; SQL finds the rows by the same rule.
SPOILT = {"mark_spent": ("n/a", 11), "clicks": ("12x", 13), "c_date": ("soon", 17), "revenue": ("1e999x", 19)}
_spoilt = lambda c: f"(leads * 7 + orders) % {SPOILT[c][1]} = 0"
_kept = " AND ".join(f"NOT {_spoilt(c)}" for c in SPOILT)


def spoilt_facts(spark: SparkSession, folder: str) -> DataFrame:
    df = sales_facts(spark, folder)
    return df.withColumns({c: F.when(F.expr(_spoilt(c)), F.lit(text)).otherwise(F.col(c).cast("string")) for c, (text, _) in SPOILT.items()})


@register("rejected_rows", sql(f"""SELECT 'shop' AS source, campaign_name, c AS "column", raw, count(*) AS n_rejected FROM (
  {' UNION ALL '.join(f"SELECT campaign_name, '{c}' AS c, '{text}' AS raw FROM sales WHERE {_spoilt(c)}" for c, (text, _) in SPOILT.items())})
GROUP BY ALL""", "sales"))
def rejected_rows(spark, folder):
    """What of a source cannot be read, by campaign and column; other sources do not suffer."""
    frames = {"shop": spoilt_facts(spark, folder), "web": event_facts(spark, folder)}
    _, rejected, errors = fs.combine_checked(spark, frames)
    assert not errors
    return rejected.groupBy("source", "campaign_name", "column", "raw").agg(F.count(F.lit(1)).alias("n_rejected"))


@register("combine_checked", sql(f"""SELECT {_unified_list} FROM (
  (SELECT 'shop' AS source, {', '.join(c for c in UNIFIED_COLUMNS if c != 'source')} FROM sales WHERE {_kept})
  UNION ALL (SELECT 'web' AS source, {', '.join(c for c in UNIFIED_COLUMNS if c != 'source')} FROM webfacts WHERE c_date >= DATE '2024-01-01'))
WHERE c_date >= DATE '1900-01-01'""", "sales", "webfacts"))
def combine_checked(spark, folder):
    """The rows that can be read of the same sources."""
    frames = {"shop": spoilt_facts(spark, folder), "web": event_facts(spark, folder).filter("c_date >= DATE '2024-01-01'")}
    return rounded(fs.combine_checked(spark, frames, start="1900-01-01", end="2999-12-31")[0], 4)


@register("source_summary", sql(f"""SELECT source, count(*) AS n_rows, count(DISTINCT campaign_name) AS n_campaigns,
  {r('sum(mark_spent)', 2)} AS total_spend, {r('sum(revenue)', 2)} AS total_revenue,
  min(c_date) AS start_date, max(c_date) AS end_date,
  {r('CASE WHEN sum(mark_spent) > 0 THEN sum(revenue) / sum(mark_spent) END')} AS overall_roas
FROM ({_stack}) GROUP BY source""", "sales", "webfacts"))
def source_summary(spark, folder):
    out = fs.source_summary(_combined(spark, folder))
    return out.withColumns({
        "total_spend": half_even("total_spend", 2), "total_revenue": half_even("total_revenue", 2),
        "overall_roas": half_even("overall_roas", 6)})


# ---- features ----

def _register_ratios() -> None:
    for name in ("ctr", "cpc", "roas", "cpl", "conversion_rate"):
        def run(spark, folder, name=name):
            return rounded(sales_facts(spark, folder).select(*KEY, getattr(fe, name)().alias(name)))
        register(name, sql(f"SELECT {columns_sql(KEY + [name], [name])} FROM allfeatures", "allfeatures"))(run)


_register_ratios()


@register("sort_by_campaign_date", sql(
    f"SELECT {columns_sql(FACT_COLUMNS, MONEY, 4)} FROM webfacts ORDER BY campaign_name, c_date", "webfacts"))
def sort_by_campaign_date(spark, folder):
    return rounded(fe.sort_by_campaign_date(event_facts(spark, folder)), 4)


def _feature_query(name: str, columns: list[str]) -> None:
    def run(spark, folder):
        return rounded(sales_features(spark, folder, keep_incomplete=True).select(*KEY, *columns))
    register(name, sql(
        f"SELECT {columns_sql(KEY + columns, [c for c in columns if c != 'is_anomaly'])} FROM allfeatures", "allfeatures"))(run)


_feature_query("prev_period", ["roas_prev", "ctr_prev", "spend_prev"])
_feature_query("wow_change", ["roas_wow", "ctr_wow", "spend_wow"])
_feature_query("rolling3", ["roas_rolling3", "ctr_rolling3"])
_feature_query("anomaly_rule", ["is_anomaly"])


@register("drop_incomplete", sql(f"SELECT {columns_sql(KEY + ['spend_wow'], ['spend_wow'])} FROM features", "features"))
def drop_incomplete(spark, folder):
    return rounded(fe.drop_incomplete(sales_features(spark, folder, keep_incomplete=True)).select(*KEY, "spend_wow"))


_features_sql = sql(f"SELECT {columns_sql(FEATURE_COLUMNS, DOUBLE_COLUMNS)} FROM features", "features")


@register("engineer_features", _features_sql)
def engineer_features(spark, folder):
    return rounded(sales_features(spark, folder))


@register("engineer_features_hot", _features_sql)
def engineer_features_hot(spark, folder):
    """The same facts cut into even ranges, with the last rows before a range carried into it."""
    return rounded(fe.engineer_features(sales_facts(spark, folder).repartition(40, "c_date"), in_ranges=True))


@register("feature_run_stats", sql("""SELECT (SELECT count(*) FROM allfeatures) AS input_rows, count(*) AS output_rows,
  CAST(sum(is_anomaly) AS BIGINT) AS anomalies FROM features""", "features"))
def feature_run_stats(spark, folder):
    return fe.feature_run_stats(sales_features(spark, folder, keep_incomplete=True))


# ---- reports ----

_rate = r("count(*) FILTER (WHERE is_anomaly = 1) * 100.0::DOUBLE / count(*)", 1)


@register("filter_campaigns", sql(
    f"SELECT {columns_sql(FEATURE_COLUMNS, DOUBLE_COLUMNS)} FROM features WHERE category = '{SOME_CATEGORY}' AND is_anomaly = 1",
    "features"))
def filter_campaigns(spark, folder):
    return rounded(rep.filter_campaigns(sales_features(spark, folder), category=SOME_CATEGORY, anomalies_only=True))


@register("list_anomalies", sql(
    f"SELECT {columns_sql(FEATURE_COLUMNS, DOUBLE_COLUMNS)} FROM features WHERE is_anomaly = 1 ORDER BY c_date DESC, campaign_name",
    "features"))
def list_anomalies(spark, folder):
    return rounded(rep.list_anomalies(sales_features(spark, folder)))


@register("anomaly_totals", sql(f"""SELECT count(*) FILTER (WHERE is_anomaly = 1) AS n_anomalies, count(*) AS total_rows,
  {r('coalesce(CAST(count(*) FILTER (WHERE is_anomaly = 1) AS DOUBLE) / count(*), 0) * 100', 1)} AS anomaly_rate
FROM features""", "features"))
def anomaly_totals(spark, folder):
    return rep.anomaly_totals(sales_features(spark, folder))


@register("list_anomalies_projected", sql(
    f"SELECT {columns_sql(rep.ANOMALY_COLUMNS, [c for c in rep.ANOMALY_COLUMNS if c in DOUBLE_COLUMNS])} FROM features "
    "WHERE is_anomaly = 1 ORDER BY c_date DESC, campaign_name", "features"))
def list_anomalies_projected(spark, folder):
    return rounded(rep.list_anomalies_projected(sales_features(spark, folder)))


_means = ", ".join(f"{r(f'avg({c})', 4)} AS {n}" for c, n in (
    ("roas", "avg_roas"), ("ctr", "avg_ctr"), ("cpc", "avg_cpc"), ("conversion_rate", "avg_conversion_rate")))


@register("summary", sql(f"""SELECT * FROM (SELECT count(*) AS total_rows, count(DISTINCT campaign_name) AS unique_campaigns,
  min(c_date) AS start_date, max(c_date) AS end_date, {_means},
  CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count, {r('CAST(sum(is_anomaly) AS DOUBLE) / count(*) * 100', 1)} AS anomaly_rate
FROM features),
(SELECT campaign_name AS best_campaign, {r('a', 4)} AS best_avg_roas FROM (
  SELECT campaign_name, avg(roas) AS a FROM features GROUP BY 1) ORDER BY a DESC, 1 DESC LIMIT 1),
(SELECT campaign_name AS worst_campaign, {r('a', 4)} AS worst_avg_roas FROM (
  SELECT campaign_name, avg(roas) AS a FROM features GROUP BY 1) ORDER BY a, 1 LIMIT 1)""", "features"))
def summary(spark, folder):
    return rep.summary(sales_features(spark, folder))


@register("best_worst_campaign", sql(f"""
SELECT * FROM (SELECT 'best' AS kind, campaign_name, {r('a', 4)} AS avg_roas FROM (
  SELECT campaign_name, avg(roas) AS a FROM features GROUP BY 1) ORDER BY a DESC, 2 DESC LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'worst' AS kind, campaign_name, {r('a', 4)} AS avg_roas FROM (
  SELECT campaign_name, avg(roas) AS a FROM features GROUP BY 1) ORDER BY a, 2 LIMIT 1)""", "features"))
def best_worst_campaign(spark, folder):
    return rep.best_worst_campaign(sales_features(spark, folder))


@register("campaign_detail", sql(f"""SELECT campaign_name, min(category) AS category, count(*) AS total_entries,
  min(c_date) AS start_date, max(c_date) AS end_date, {r('avg(roas)', 4)} AS avg_roas, {r('avg(ctr)', 4)} AS avg_ctr,
  {r('avg(cpc)', 4)} AS avg_cpc, {r('sum(mark_spent)', 2)} AS total_spent, {r('sum(revenue)', 2)} AS total_revenue,
  CAST(sum(is_anomaly) AS BIGINT) AS anomalies
FROM features WHERE campaign_name = '{SOME_CAMPAIGN}' GROUP BY 1""", "features"))
def campaign_detail(spark, folder):
    return rep.campaign_detail(sales_features(spark, folder), SOME_CAMPAIGN)[0]


@register("campaign_detail_rows", sql(
    f"SELECT {columns_sql(FEATURE_COLUMNS, DOUBLE_COLUMNS)} FROM features WHERE campaign_name = '{SOME_CAMPAIGN}'", "features"))
def campaign_detail_rows(spark, folder):
    return rounded(rep.campaign_detail(sales_features(spark, folder), SOME_CAMPAIGN)[1])


@register("campaign_not_found", sql("SELECT DISTINCT campaign_name FROM features ORDER BY 1", "features"))
def campaign_not_found(spark, folder):
    return rep.campaign_detail(sales_features(spark, folder), "no such campaign")[2]


@register("distinct_campaigns", sql("SELECT DISTINCT campaign_name FROM features ORDER BY 1", "features"))
def distinct_campaigns(spark, folder):
    return rep.distinct_campaigns(sales_features(spark, folder))


@register("roas_by_campaign", sql(
    f"SELECT campaign_name, {r('avg(roas)')} AS roas FROM features GROUP BY 1 ORDER BY 2, 1", "features"))
def roas_by_campaign(spark, folder):
    return rounded(rep.roas_by_campaign(sales_features(spark, folder)))


@register("anomalies_by_campaign", sql(
    "SELECT campaign_name, count(*) AS anomalies FROM features WHERE is_anomaly = 1 GROUP BY 1 ORDER BY 2, 1", "features"))
def anomalies_by_campaign(spark, folder):
    return rep.anomalies_by_campaign(sales_features(spark, folder))


@register("campaign_metrics_summary", sql(f"""SELECT campaign_name, {r('avg(roas)', 4)} AS avg_roas, {r('avg(ctr)', 4)} AS avg_ctr,
  {r('avg(cpc)', 4)} AS avg_cpc, {r('avg(conversion_rate)', 4)} AS avg_conv_rate, {r('sum(mark_spent)', 4)} AS total_spend,
  {r('sum(revenue)', 4)} AS total_revenue, CAST(sum(is_anomaly) AS BIGINT) AS anomalies FROM features GROUP BY 1""", "features"))
def campaign_metrics_summary(spark, folder):
    return rep.campaign_metrics_summary(sales_features(spark, folder))


@register("metric_timeseries", sql(
    f"SELECT {columns_sql(['c_date', 'campaign_name', 'roas', 'ctr'], ['roas', 'ctr'])} FROM features", "features"))
def metric_timeseries(spark, folder):
    return rounded(rep.metric_timeseries(sales_features(spark, folder)))


@register("kpi_cards", sql(f"""SELECT count(*) AS total_records, count(DISTINCT campaign_name) AS campaigns,
  CAST(sum(is_anomaly) AS BIGINT) AS anomalies, {r('CAST(sum(is_anomaly) AS DOUBLE) / count(*) * 100', 1)} AS anomaly_pct,
  {r('avg(roas)', 2)} AS avg_roas FROM features""", "features"))
def kpi_cards(spark, folder):
    return rep.kpi_cards(sales_features(spark, folder))
