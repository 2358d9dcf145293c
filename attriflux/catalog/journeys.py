"""Registered queries on journeys, attribution and tracking."""

from __future__ import annotations

from pyspark.sql import functions as F

from attriflux.catalog.core import register
from attriflux.catalog.inputs import columns_sql, journey_table, r, raw_touches, sql, touch_table
from attriflux.functions.columns import rounded
from attriflux.operators import attribution as at
from attriflux.operators import journeys as jo
from attriflux.operators import tracking as tr
from attriflux.plans.runs import attribution_report as report
from attriflux.schemas import ATTRIBUTION_MODELS, TRACKING_METHODS
from attriflux.session import fresh_path
from attriflux.sources.facts import save_table

JOURNEY_COLUMNS = [
    "user_id", "path_id", "touch_index", "n_touches", "channel", "funnel_position", "date", "cost",
    "cookies_accepted", "has_adblocker", "cross_device", "ga4_visible", "enhanced_visible",
    "is_converting_touch", *[f"tracking_{m}" for m in TRACKING_METHODS], "revenue"]
POSITION = ["user_id", "path_id", "touch_index"]
RESULT_COLUMNS = ["channel", "attributed_revenue", "conversions", "model"]

_path_columns = ["event_id", *POSITION, "n_touches", "channel", "date", "revenue"]
_paths_sql = sql(f"SELECT {columns_sql(_path_columns, ['revenue'])}, conv AS is_converting_touch FROM paths", "paths")


@register("build_journeys", _paths_sql)
def build_journeys(spark, folder):
    return rounded(jo.build_journeys(raw_touches(spark, folder)).select(*_path_columns, "is_converting_touch"))


_heavy_sql = sql(f"SELECT {columns_sql(_path_columns, ['revenue'])}, conv AS is_converting_touch FROM heavypaths", "heavypaths")


@register("build_journeys_hot", _heavy_sql)
def build_journeys_hot(spark, folder):
    """Two users hold all touches between them, and spread over the tasks."""
    heavy = raw_touches(spark, folder).withColumn("user_id", F.col("user_id") % 2)
    return rounded(jo.build_journeys_in_ranges(heavy).select(*_path_columns, "is_converting_touch"))


@register("build_journeys_ranges", _paths_sql)
def build_journeys_ranges(spark, folder):
    """All users, cut into even ranges."""
    return rounded(jo.build_journeys_in_ranges(raw_touches(spark, folder)).select(*_path_columns, "is_converting_touch"))


@register("enrich_channel", sql(f"""SELECT event_id, channel, funnel_position, {r('avg_cpc')} AS avg_cpc, trackable_without_cookies
FROM touches LEFT JOIN channels USING (channel)""", "touches", "channels"))
def enrich_channel(spark, folder):
    return rounded(jo.enrich_channel(raw_touches(spark, folder)).select(
        "event_id", "channel", "funnel_position", "avg_cpc", "trackable_without_cookies"))


_flags = [f"tracking_{m}" for m in TRACKING_METHODS]


@register("suppress_detection", sql(f"SELECT event_id, {', '.join(_flags)} FROM detected", "detected"))
def suppress_detection(spark, folder):
    return jo.add_tracking(jo.build_journeys(raw_touches(spark, folder))).select("event_id", *_flags)


@register("visibility_flags", sql(
    f"SELECT {', '.join(POSITION)}, ga4_visible, enhanced_visible FROM journeys", "journeys"))
def visibility_flags(spark, folder):
    return touch_table(spark, folder).select(*POSITION, "ga4_visible", "enhanced_visible")


@register("cross_device_flag", sql(f"SELECT {', '.join(POSITION)}, cross_device FROM journeys", "journeys"))
def cross_device_flag(spark, folder):
    return jo.build_journeys(raw_touches(spark, folder)).select(*POSITION, jo.cross_device_flag().alias("cross_device"))


@register("save_journeys", sql(f"SELECT {columns_sql(JOURNEY_COLUMNS, ['cost', 'revenue'])} FROM journeys", "journeys"))
def save_journeys(spark, folder):
    path = fresh_path(spark, "journeys")
    save_table(touch_table(spark, folder), path)
    return rounded(spark.read.parquet(path))


_models = {"last_click": ("lastclick", at.last_click), "first_click": ("firstclick", at.first_click),
           "linear": ("linearmodel", at.linear), "time_decay": ("timedecay", at.time_decay),
           "shapley": ("shapleymodel", at.shapley)}


def _register_models() -> None:
    for name, (cte, model) in _models.items():
        def run(spark, folder, model=model):
            return rounded(model(journey_table(spark, folder)), 4)
        register(f"attribution_{name}", sql(
            f"SELECT {columns_sql(RESULT_COLUMNS, ['attributed_revenue'], 4)} FROM {cte}", cte))(run)


_register_models()

_all_sql = sql(f"SELECT {columns_sql(RESULT_COLUMNS, ['attributed_revenue'], 4)} FROM attributed", "attributed")


@register("attribution_all_models", _all_sql)
def attribution_all_models(spark, folder):
    return rounded(at.attribution(journey_table(spark, folder)), 4)


_rev = ", ".join(f"{r(f'''coalesce(sum(attributed_revenue) FILTER (WHERE model = '{m}'), 0)''', 2)} AS {m}" for m in ATTRIBUTION_MODELS)
_pct = ", ".join(f"{r(f'{m} / NULLIF(sum({m}) OVER (), 0) * 100', 1)} AS {m}_pct" for m in ATTRIBUTION_MODELS)
_compare_sql = sql(f"SELECT *, {_pct} FROM (SELECT channel, {_rev} FROM attributed GROUP BY channel)", "attributed")


@register("compare_models", _compare_sql)
def compare_models(spark, folder):
    return at.compare_models(at.attribution(journey_table(spark, folder)))


_shares = f"""
SELECT *, {r('shapley_pct - last_click_pct', 1)} AS pct_difference FROM (
  SELECT channel, last_click_revenue, shapley_revenue,
    {r('last_click_revenue / sum(last_click_revenue) OVER () * 100', 1)} AS last_click_pct,
    {r('shapley_revenue / sum(shapley_revenue) OVER () * 100', 1)} AS shapley_pct
  FROM (SELECT channel, coalesce(l.attributed_revenue, 0) AS last_click_revenue, coalesce(s.attributed_revenue, 0) AS shapley_revenue
        FROM lastclick l FULL OUTER JOIN shapleymodel s USING (channel)))"""


@register("find_misattribution", sql(f"""SELECT channel, {r('last_click_revenue', 4)} AS last_click_revenue,
  {r('shapley_revenue', 4)} AS shapley_revenue, last_click_pct, shapley_pct, pct_difference,
  CASE WHEN pct_difference > 3 THEN 'UNDERVALUED by last-click' WHEN pct_difference < -3 THEN 'OVERVALUED by last-click'
       ELSE 'Fairly valued' END AS verdict FROM ({_shares})""", "lastclick", "shapleymodel"))
def find_misattribution(spark, folder):
    return rounded(at.find_misattribution(at.attribution(journey_table(spark, folder), ["last_click", "shapley"])), 4)


_seen = "count(*) FILTER (WHERE {}_visible)"
_ga4, _enh = _seen.format("ga4"), _seen.format("enhanced")


@register("tracking_loss_total", sql(f"""SELECT count(*) AS total_touchpoints, {_ga4} AS ga4_visible, {_enh} AS enhanced_visible,
  {r(f'(1 - CAST({_ga4} AS DOUBLE) / count(*)) * 100', 1)} AS ga4_loss_pct,
  {r(f'(1 - CAST({_enh} AS DOUBLE) / count(*)) * 100', 1)} AS enhanced_loss_pct,
  {r(f'CAST({_enh} - {_ga4} AS DOUBLE) / count(*) * 100', 1)} AS recovered_pct FROM journeys""", "journeys"))
def tracking_loss_total(spark, folder):
    return tr.tracking_loss_total(touch_table(spark, folder))


_by_channel_sql = sql(f"""SELECT *, {r('100 - ga4_rate', 1)} AS ga4_loss, {r('enhanced_rate - ga4_rate', 1)} AS recovered_by_enhanced
FROM (SELECT channel, count(*) AS total_touches, {_ga4} AS ga4_visible, {_enh} AS enhanced_visible,
  {r(f'CAST({_ga4} AS DOUBLE) / count(*) * 100', 1)} AS ga4_rate, {r(f'CAST({_enh} AS DOUBLE) / count(*) * 100', 1)} AS enhanced_rate
  FROM journeys GROUP BY channel)""", "journeys")


@register("tracking_loss_by_channel", _by_channel_sql)
def tracking_loss_by_channel(spark, folder):
    return tr.tracking_loss_by_channel(touch_table(spark, folder))


@register("tracking_method_effectiveness", sql(" UNION ALL ".join(
    f"""SELECT '{m}' AS method, count(*) FILTER (WHERE tracking_{m}) AS detected, count(*) AS total,
  {r(f'CAST(count(*) FILTER (WHERE tracking_{m}) AS DOUBLE) / count(*) * 100', 1)} AS detected_pct FROM journeys"""
    for m in TRACKING_METHODS), "journeys"))
def tracking_method_effectiveness(spark, folder):
    return tr.tracking_method_effectiveness(touch_table(spark, folder))


_rejection = """SELECT count(*) AS users, count(*) FILTER (WHERE NOT accepted) AS rejected FROM (
  SELECT user_id, arg_min(cookies_accepted, (path_id, touch_index)) AS accepted FROM journeys GROUP BY 1)"""


@register("cookie_rejection_rate", sql(
    f"SELECT *, {r('CAST(rejected AS DOUBLE) / users * 100', 1)} AS rejection_pct FROM ({_rejection})", "journeys"))
def cookie_rejection_rate(spark, folder):
    return tr.cookie_rejection_rate(touch_table(spark, folder))


@register("journey_stats", sql(f"""SELECT *, {r('CAST(converting_users AS DOUBLE) / total_users * 100', 1)} AS conversion_pct,
  {r('CAST(total_touchpoints AS DOUBLE) / total_users', 1)} AS avg_touchpoints,
  {r('CAST(ga4_visible AS DOUBLE) / total_touchpoints * 100', 1)} AS ga4_pct,
  {r('CAST(enhanced_visible AS DOUBLE) / total_touchpoints * 100', 1)} AS enhanced_pct
FROM (SELECT count(DISTINCT user_id) AS total_users, count(DISTINCT user_id) FILTER (WHERE is_converting_touch) AS converting_users,
  count(*) AS total_touchpoints, {_ga4} AS ga4_visible, {_enh} AS enhanced_visible FROM journeys)""", "journeys"))
def journey_stats(spark, folder):
    return tr.journey_stats(touch_table(spark, folder))


_conversion = f"""SELECT total_users, converting_users, total_revenue,
  {r('CAST(converting_users AS DOUBLE) / total_users * 100', 1)} AS conversion_rate
FROM (SELECT count(DISTINCT user_id) AS total_users, count(DISTINCT user_id) FILTER (WHERE is_converting_touch) AS converting_users,
  {r('coalesce(sum(revenue), 0)', 2)} AS total_revenue FROM journeys)"""


@register("conversion_summary", sql(_conversion, "journeys"))
def conversion_summary(spark, folder):
    return tr.conversion_summary(touch_table(spark, folder))


_pctext = lambda e: f"printf('%.1f', {r(e, 1)}) || '%'"
_insights_sql = sql(f"""SELECT 'Last-click attribution misallocates revenue: ' || u.channel || ' is undervalued by ' ||
    printf('%+.1f', u.pct_difference) || 'pp, while ' || o.channel || ' is overvalued by ' || printf('%.1f', abs(o.pct_difference)) || 'pp.' AS headline,
  {_pctext('t.loss')} AS ga4_data_loss, {_pctext('t.recovered')} AS enhanced_recovery,
  {_pctext('CAST(c.rejected AS DOUBLE) / c.users * 100')} AS cookie_rejection_rate,
  u.channel AS undervalued, u.last_click_pct AS undervalued_last_click_pct, u.shapley_pct AS undervalued_shapley_pct, u.pct_difference AS undervalued_difference,
  o.channel AS overvalued, o.last_click_pct AS overvalued_last_click_pct, o.shapley_pct AS overvalued_shapley_pct, o.pct_difference AS overvalued_difference,
  s.total_users, s.converting_users, {_pctext('s.conversion_rate')} AS conversion_rate, s.total_revenue
FROM (SELECT * FROM ({_shares}) ORDER BY pct_difference DESC, channel LIMIT 1) u,
  (SELECT * FROM ({_shares}) ORDER BY pct_difference, channel DESC LIMIT 1) o,
  (SELECT (1 - CAST({_ga4} AS DOUBLE) / count(*)) * 100 AS loss, CAST({_enh} - {_ga4} AS DOUBLE) / count(*) * 100 AS recovered FROM journeys) t,
  ({_rejection}) c, ({_conversion}) s""", "lastclick", "shapleymodel", "journeys")


def _flat(insights):
    under, over = F.col("attribution.most_undervalued"), F.col("attribution.most_overvalued")
    sides = [side[c].alias(f"{name}_{c}") for name, side in (("undervalued", under), ("overvalued", over))
             for c in ("last_click_pct", "shapley_pct", "difference")]
    return insights.select(
        "headline", "tracking.*", under["channel"].alias("undervalued"), over["channel"].alias("overvalued"), *sides, "summary.*")


@register("attribution_insights", _insights_sql)
def attribution_insights(spark, folder):
    path = fresh_path(spark, "touches")
    save_table(touch_table(spark, folder), path)         # read by the attribution and by the figures
    journeys = spark.read.parquet(path)
    return _flat(tr.attribution_insights(journeys, at.attribution(journeys, ["last_click", "shapley"])))


@register("save_results", _all_sql)
def save_results(spark, folder):
    path = fresh_path(spark, "results")
    save_table(at.attribution(journey_table(spark, folder)), path)
    return rounded(spark.read.parquet(path), 4)


@register("attribution_report", _compare_sql)
def attribution_report(spark, folder):
    """The whole run; shown is its comparison of the models."""
    return report(raw_touches(spark, folder), fresh_path(spark, "report"))["comparison"]


@register("attribution_report_insights", _insights_sql)
def attribution_report_insights(spark, folder):
    """The insights text that the whole run saves, read back."""
    text = report(raw_touches(spark, folder), fresh_path(spark, "report"))["insights"]
    side = "struct<channel:string,last_click_pct:double,shapley_pct:double,difference:double>"
    schema = (
        "headline string, tracking struct<ga4_data_loss:string,enhanced_recovery:string,cookie_rejection_rate:string>, "
        f"attribution struct<most_undervalued:{side},most_overvalued:{side}>, "
        "summary struct<total_users:bigint,converting_users:bigint,conversion_rate:string,total_revenue:double>")
    return _flat(text.select(F.from_json("insights", schema).alias("i")).select("i.*"))
