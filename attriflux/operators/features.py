"""Per-campaign time-series features and the rule-based anomaly flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attriflux.functions.columns import ratio
from attriflux.operators import ranges
from attriflux.schemas import DERIVED_COLUMNS

DROP_THRESHOLD = 0.8   # an anomaly is a fall below this share of the rolling mean
ROLLING_ROWS = 3


def ctr() -> Column:
    return ratio("clicks", "impressions")


def cpc() -> Column:
    return ratio("mark_spent", "clicks")


def roas() -> Column:
    return ratio("revenue", "mark_spent")


def cpl() -> Column:
    return ratio("mark_spent", "leads")


def conversion_rate() -> Column:
    return ratio("orders", "clicks")


def add_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "ctr": ctr(), "cpc": cpc(), "roas": roas(), "cpl": cpl(), "conversion_rate": conversion_rate()})


def order_columns(df: DataFrame) -> list[str]:
    """Date first; source and id, where the table has them, settle equal dates."""
    return ["c_date"] + [c for c in ("source", "id") if c in df.columns]


def sort_by_campaign_date(df: DataFrame) -> DataFrame:
    return df.orderBy("campaign_name", *order_columns(df))


def _previous_and_rolling(df: DataFrame, *keys: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order_columns(df))
    recent = w.rowsBetween(1 - ROLLING_ROWS, Window.currentRow)
    return df.withColumns({
        "roas_prev": F.lag("roas").over(w),
        "ctr_prev": F.lag("ctr").over(w),
        "spend_prev": F.lag("mark_spent").over(w),
        "roas_rolling3": F.avg("roas").over(recent),
        "ctr_rolling3": F.avg("ctr").over(recent),
    })


def add_windows(df: DataFrame) -> DataFrame:
    """Previous values and rolling means per campaign: one exchange, one sort, frames of three rows at most."""
    return _previous_and_rolling(df.filter(F.col("campaign_name").isNotNull()), "campaign_name")


def add_windows_in_ranges(df: DataFrame) -> DataFrame:
    """The same for campaigns of any size: rows are cut into even ranges, and the two rows before a range are carried into it.

    One pass more over the rows than ``add_windows``, which sorts a campaign in one task.
    """
    order = order_columns(df)
    rows = ranges.with_last_rows(ranges.cut_in_ranges(df, "campaign_name", order), "campaign_name", order, ROLLING_ROWS - 1)
    out = _previous_and_rolling(rows, ranges.PART, "campaign_name")
    return out.filter("NOT _carried").drop("_carried", ranges.PART)


def add_changes(df: DataFrame) -> DataFrame:
    """Relative change against the campaign's previous row, whatever the gap in days."""
    def change(now, before):
        return ratio(F.col(now) - F.col(before), before)
    return df.withColumns({
        "roas_wow": change("roas", "roas_prev"),
        "ctr_wow": change("ctr", "ctr_prev"),
        "spend_wow": change("mark_spent", "spend_prev"),
    })


def anomaly_rule() -> Column:
    """1 where ROAS or CTR falls more than 20% below its rolling mean; comparisons with missing values fail."""
    def falls(metric):
        return F.coalesce(F.col(metric) < F.col(f"{metric}_rolling3") * F.lit(DROP_THRESHOLD), F.lit(False))
    return (falls("roas") | falls("ctr")).cast("int")


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["roas_wow", "ctr_wow"])


def engineer_features(df: DataFrame, keep_incomplete: bool = False, in_ranges: bool = False) -> DataFrame:
    """Facts to features: ratios, previous values, changes, rolling means, anomaly flag.

    ``in_ranges`` spreads single campaigns over tasks.
    """
    facts = df.columns
    out = add_changes((add_windows_in_ranges if in_ranges else add_windows)(add_ratios(df))).withColumn("is_anomaly", anomaly_rule())
    out = out if keep_incomplete else drop_incomplete(out)
    return out.select(*facts, *DERIVED_COLUMNS)


def feature_run_stats(features: DataFrame) -> DataFrame:
    """Input rows, output rows and anomalies, from features that still hold the incomplete rows."""
    complete = F.col("roas_wow").isNotNull() & F.col("ctr_wow").isNotNull()
    return features.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count(F.when(complete, 1)).alias("output_rows"),
        F.count(F.when(complete & (F.col("is_anomaly") == 1), 1)).alias("anomalies"))
