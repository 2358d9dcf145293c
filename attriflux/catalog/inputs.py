"""Inputs of the registered queries, and the same inputs as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attriflux.operators.features import engineer_features
from attriflux.operators.journeys import CHANNEL_ROWS, build_journeys, touchpoints
from attriflux.schemas import ANOMALY_FEATURES, TRACKING_METHODS
from attriflux.sources.derived import (
    CHANNEL_BOUNDS, DETECTION_RATES, DRAW_FACTORS, TRAIT_FACTORS, facts_from_events, facts_from_sales, table, touch_events)


def sales_facts(spark: SparkSession, folder: str) -> DataFrame:
    return facts_from_sales(*[table(spark, folder, n) for n in ("lineitem", "supplier", "nation", "region")])


def event_facts(spark: SparkSession, folder: str) -> DataFrame:
    return facts_from_events(table(spark, folder, "events"))


def sales_features(spark: SparkSession, folder: str, **options) -> DataFrame:
    return engineer_features(sales_facts(spark, folder), **options)


def raw_touches(spark: SparkSession, folder: str) -> DataFrame:
    return touch_events(table(spark, folder, "events"))


def touch_table(spark: SparkSession, folder: str) -> DataFrame:
    return touchpoints(raw_touches(spark, folder))


def journey_table(spark: SparkSession, folder: str) -> DataFrame:
    """The journeys without tracking columns, which is all that attribution needs."""
    return build_journeys(raw_touches(spark, folder))


_made: dict = {}


def once(spark: SparkSession, folder: str, name: str, make):
    """Inputs that several queries share (landed files, written tables, trained models) are made once per session."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


# ---- SQL ----

def r(expression: str, digits: int = 6) -> str:
    """Half-even rounding of the scaled value, as the Spark side does it."""
    scale = f"1e{digits}::DOUBLE"
    return f"round_even(CAST({expression} AS DOUBLE) * {scale}, 0) / {scale}"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def _windowed(source: str) -> str:
    return f"""
SELECT *, {div('roas - roas_prev', 'roas_prev')} AS roas_wow, {div('ctr - ctr_prev', 'ctr_prev')} AS ctr_wow,
  {div('mark_spent - spend_prev', 'spend_prev')} AS spend_wow,
  CASE WHEN coalesce(roas < roas_rolling3 * 0.8::DOUBLE, false) OR coalesce(ctr < ctr_rolling3 * 0.8::DOUBLE, false)
       THEN 1 ELSE 0 END AS is_anomaly
FROM (
  SELECT *, lag(roas) OVER w AS roas_prev, lag(ctr) OVER w AS ctr_prev, lag(mark_spent) OVER w AS spend_prev,
    avg(roas) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roas_rolling3,
    avg(ctr) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS ctr_rolling3
  FROM (SELECT *, {div('clicks', 'impressions')} AS ctr, {div('mark_spent', 'clicks')} AS cpc,
          {div('revenue', 'mark_spent')} AS roas, {div('mark_spent', 'leads')} AS cpl,
          {div('orders', 'clicks')} AS conversion_rate FROM {source})
  WINDOW w AS (PARTITION BY campaign_name ORDER BY c_date, source))"""


_channel_case = "CASE " + " ".join(
    f"WHEN k < {bound} THEN '{name}'" for name, bound in CHANNEL_BOUNDS) + " END"


def _detected(method: str) -> str:
    blocked = ["(channel = 'google_display_retargeting' AND NOT cookies_accepted AND touch_index > 0)"]
    if method == "cookie":
        blocked.append("NOT cookies_accepted")
    if method == "referrer":
        blocked.append("has_adblocker")
    if method in ("utm", "referrer"):
        blocked.append("channel = 'direct'")
    draw = f"CAST((event_id * {DRAW_FACTORS[method]} + user_id) % 100 AS DOUBLE) / 100"
    return f"({draw} < {DETECTION_RATES[method]}::DOUBLE AND NOT ({' OR '.join(blocked)})) AS tracking_{method}"


_values = ", ".join(f"('{n}', '{p}', {c}::DOUBLE, {str(t).lower()})" for n, p, c, t in CHANNEL_ROWS)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "sales": ((), """
SELECT r_name AS source, s_name AS campaign_name, n_name AS category, c_date, impressions, clicks, leads, orders,
  CAST(spent AS DOUBLE) / 10000 AS mark_spent, CAST(earned AS DOUBLE) / 10000 AS revenue
FROM (
  SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS c_date,
    CAST(sum(l_quantity) AS BIGINT) AS impressions, count(*) AS clicks,
    count(*) FILTER (WHERE l_returnflag <> 'R') AS leads, count(*) FILTER (WHERE l_returnflag = 'N') AS orders,
    sum(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT)) AS spent,
    sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS earned
  FROM lineitem GROUP BY 1, 2)
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""),
    "webfacts": ((), """
SELECT 'web' AS source, 'campaign_' || CAST(user_id % 10 AS VARCHAR) AS campaign_name, 'web' AS category,
  CAST(ts AS DATE) AS c_date,
  count(*) FILTER (WHERE event_type = 'view') AS impressions, count(*) FILTER (WHERE event_type = 'click') AS clicks,
  count(*) FILTER (WHERE event_type = 'signup') AS leads, count(*) FILTER (WHERE event_type = 'purchase') AS orders,
  CAST(coalesce(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'click'), 0) AS DOUBLE) / 100 AS mark_spent,
  CAST(coalesce(sum(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = 'purchase'), 0) AS DOUBLE) / 100 AS revenue
FROM events GROUP BY 2, 4"""),
    "allfeatures": (("sales",), _windowed("sales")),
    "features": (("allfeatures",), "SELECT * FROM allfeatures WHERE roas_wow IS NOT NULL AND ctr_wow IS NOT NULL"),
    "touches": ((), f"""
SELECT user_id, event_id, ts, CAST(ts AS DATE) AS date, {_channel_case} AS channel, conv, value,
  user_id * {TRAIT_FACTORS['cookies']} % 100 >= 35 AS cookies_accepted,
  user_id * {TRAIT_FACTORS['adblocker']} % 100 < 25 AS has_adblocker,
  user_id * {TRAIT_FACTORS['device']} % 100 < 30 AS switches_device
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type = 'purchase' AS conv FROM events)"""),
    "paths": (("touches",), """
SELECT *, CAST(row_number() OVER (PARTITION BY user_id, path_id ORDER BY ts, event_id) - 1 AS BIGINT) AS touch_index,
  count(*) OVER (PARTITION BY user_id, path_id) AS n_touches,
  CASE WHEN conv THEN value WHEN NOT bool_or(conv) OVER (PARTITION BY user_id, path_id) THEN 0::DOUBLE END AS revenue
FROM (SELECT *, CAST(coalesce(sum(CAST(conv AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS path_id FROM touches)"""),
    "heavytouches": (("touches",), "SELECT * REPLACE (user_id % 2 AS user_id) FROM touches"),
    "heavypaths": (("heavytouches",), """
SELECT *, CAST(row_number() OVER (PARTITION BY user_id, path_id ORDER BY ts, event_id) - 1 AS BIGINT) AS touch_index,
  count(*) OVER (PARTITION BY user_id, path_id) AS n_touches,
  CASE WHEN conv THEN value WHEN NOT bool_or(conv) OVER (PARTITION BY user_id, path_id) THEN 0::DOUBLE END AS revenue
FROM (SELECT *, CAST(coalesce(sum(CAST(conv AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS path_id FROM heavytouches)"""),
    "channels": ((), f"""
SELECT * FROM (VALUES {_values}) AS v(channel, funnel_position, avg_cpc, trackable_without_cookies)"""),
    "detected": (("paths",), f"SELECT *, {', '.join(_detected(m) for m in TRACKING_METHODS)} FROM paths"),
    "journeys": (("detected", "channels"), f"""
SELECT user_id, path_id, touch_index, n_touches, channel, funnel_position, date, avg_cpc AS cost, cookies_accepted,
  has_adblocker, switches_device AND touch_index >= n_touches // 2 AS cross_device,
  tracking_cookie OR tracking_referrer AS ga4_visible,
  tracking_cookie OR tracking_utm OR tracking_fingerprint OR tracking_server_side AS enhanced_visible,
  conv AS is_converting_touch, {', '.join('tracking_' + m for m in TRACKING_METHODS)}, revenue
FROM detected LEFT JOIN channels USING (channel)"""),
    "journeyrevenue": (("journeys",), """
SELECT user_id, path_id, sum(revenue) AS jr, count(revenue) AS valued, max(date) AS jd
FROM journeys WHERE is_converting_touch GROUP BY 1, 2"""),
    "lastclick": (("journeys",), """
SELECT channel, coalesce(sum(revenue), 0) AS attributed_revenue, count(revenue) AS conversions, 'last_click' AS model
FROM journeys WHERE is_converting_touch GROUP BY channel"""),
    "firstclick": (("journeys", "journeyrevenue"), """
SELECT channel, sum(jr) AS attributed_revenue, CAST(sum(valued) AS BIGINT) AS conversions, 'first_click' AS model
FROM (SELECT user_id, path_id, arg_min(channel, touch_index) AS channel FROM journeys GROUP BY 1, 2)
JOIN journeyrevenue USING (user_id, path_id) GROUP BY channel"""),
    "linearmodel": (("journeys", "journeyrevenue"), """
SELECT channel, sum(jr / n_touches) AS attributed_revenue, count(DISTINCT (user_id, path_id)) AS conversions, 'linear' AS model
FROM journeys JOIN journeyrevenue USING (user_id, path_id) GROUP BY channel"""),
    "timedecay": (("journeys", "journeyrevenue"), """
SELECT channel, sum(jr * w / sw) AS attributed_revenue, count(DISTINCT (user_id, path_id)) AS conversions, 'time_decay' AS model
FROM (SELECT *, sum(w) OVER (PARTITION BY user_id, path_id) AS sw
      FROM (SELECT *, power(0.5::DOUBLE, date_diff('day', date, jd)) AS w
            FROM journeys JOIN journeyrevenue USING (user_id, path_id))) GROUP BY channel"""),
    "shapleymodel": (("journeys", "journeyrevenue"), f"""
SELECT channel, {r('sum(jr / size)', 2)} AS attributed_revenue, count(*) AS conversions, 'shapley' AS model
FROM (SELECT *, count(*) OVER (PARTITION BY user_id, path_id) AS size
      FROM (SELECT DISTINCT user_id, path_id, channel, jr FROM journeys JOIN journeyrevenue USING (user_id, path_id)))
GROUP BY channel"""),
    "attributed": (("lastclick", "firstclick", "linearmodel", "timedecay", "shapleymodel"), " UNION ALL ".join(
        f"SELECT channel, attributed_revenue, conversions, model FROM {m}"
        for m in ("lastclick", "firstclick", "linearmodel", "timedecay", "shapleymodel"))),
    "cleaned": (("features",), "SELECT * REPLACE (" + ", ".join(
        f"coalesce({c}, 0) AS {c}" for c in ANOMALY_FEATURES) + ") FROM features"),
}


def key_fraction_sql(*parts: str) -> str:
    text = "concat_ws('|', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return f"(CAST(('0x' || substr(md5({text}), 1, 8))::BIGINT AS DOUBLE) / 4294967296)"


CTES["drawn"] = (("features",), f"SELECT *, {key_fraction_sql('42', 'source', 'campaign_name', 'c_date')} AS draw FROM features")
CTES["randomsplit"] = (("drawn",), "SELECT *, CASE WHEN draw < 0.2::DOUBLE THEN 'test' ELSE 'train' END AS split FROM drawn")
# per class, the rows up to rank ceil(0.2 n) in the order of their draws
CTES["stratified"] = (("drawn",), """
SELECT *, CASE WHEN row_number() OVER (PARTITION BY is_anomaly ORDER BY draw)
  <= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY is_anomaly)) THEN 'test' ELSE 'train' END AS split FROM drawn""")


def sql(body: str, *needed: str) -> str:
    """The query with the common table expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for dependency in CTES[name][0]:
                visit(dependency)
            order.append(name)

    for name in needed:
        visit(name)
    ctes = ", ".join(f"{name} AS ({CTES[name][1]})" for name in order)
    return f"WITH {ctes} {body}" if ctes else body


def columns_sql(names: list[str], doubles: dict[str, int] | list[str] = (), digits: int = 6) -> str:
    """A select list in which the given double columns are rounded."""
    digits_of = doubles if isinstance(doubles, dict) else {d: digits for d in doubles}
    return ", ".join(f"{r(n, digits_of[n])} AS {n}" if n in digits_of else n for n in names)


FACT_COLUMNS = ["source", "campaign_name", "category", "c_date", "impressions", "clicks", "leads", "orders",
                "mark_spent", "revenue"]
FEATURE_COLUMNS = FACT_COLUMNS + [
    "ctr", "cpc", "roas", "cpl", "conversion_rate", "roas_prev", "ctr_prev", "spend_prev",
    "roas_wow", "ctr_wow", "spend_wow", "roas_rolling3", "ctr_rolling3", "is_anomaly"]
DOUBLE_COLUMNS = [c for c in FEATURE_COLUMNS if c not in (
    "source", "campaign_name", "category", "c_date", "impressions", "clicks", "leads", "orders", "is_anomaly")]
