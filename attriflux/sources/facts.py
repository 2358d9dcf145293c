"""Load, validate, combine, filter, summarise and save campaign facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attriflux.functions.columns import ratio
from attriflux.schemas import FACT_TYPES, NUMERIC_COLUMNS, UNIFIED_COLUMNS
from attriflux.session import fresh_path


def standardise_columns(df: DataFrame) -> DataFrame:
    """Lower-case and strip headers, cast the known columns, fill in source and category."""
    df = df.toDF(*[c.lower().strip() for c in df.columns])
    df = df.select([_typed(c).alias(c) if c in FACT_TYPES else F.col(c) for c in df.columns])
    if "source" not in df.columns:
        df = df.withColumn("source", F.lit("csv_import"))
    if "category" not in df.columns:
        df = df.withColumn("category", F.col("source"))
    return df


def _typed(name: str) -> Column:
    """A known column in its declared type, NaN as null."""
    if name == "c_date":
        return F.col(name).try_cast("date")
    value = F.col(name).try_cast("double")       # whole numbers also come as 1000.0, where a column has gaps
    value = F.when(~F.isnan(value), value)
    if FACT_TYPES[name] == T.DoubleType():
        return value
    exact = F.col(name).try_cast(FACT_TYPES[name])
    return F.coalesce(exact, value.try_cast(FACT_TYPES[name])) if FACT_TYPES[name] == T.LongType() else exact


def unread_values(df: DataFrame) -> DataFrame:
    """(column, unread): how many texts of the known columns are no value of their type and load as null."""
    named = df.toDF(*[c.lower().strip() for c in df.columns])
    known = [c for c in named.columns if c in FACT_TYPES]
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") | (F.lower(F.col(c).cast("string")) == "nan")
    counts = named.agg(*[F.count(F.when(~blank(c) & _typed(c).isNull(), 1)).alias(c) for c in known])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("unread")) for c in known])).alias("r")).select("r.*")


def load_campaigns(spark: SparkSession, original: str, combined: str | None = None,
                   source: str = "auto", fmt: str = "csv") -> DataFrame:
    """Read raw facts: the combined table if asked for or (auto) if it is there, else the original.

    CSV columns are read as text and cast to their declared types, so no
    pass over the file is spent on guessing a schema.
    """
    if source not in ("auto", "original", "combined"):
        raise ValueError(f"unknown source option {source!r}")
    path = original
    if source == "combined" or (source == "auto" and combined and _exists(spark, combined)):
        if not combined:
            raise ValueError("no path is given for the combined table")
        path = combined
    reader = spark.read
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    return standardise_columns(df)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def save_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write facts, features, journeys or results; parquet unless another format is asked for."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


DAY = "day"              # partition column of tables that are replaced by range


def save_range(df: DataFrame, path: str, start: str | dt.date, end: str | dt.date, date: str = "c_date") -> None:
    """Put the rows of [start, end], both included, in the place of what the table holds of these days; other days stay.

    The table has a folder per day. A day of the range of which there are no rows
    any more is removed. Saving the same range again changes nothing. Rows
    outside of the range and without a date are not saved.
    """
    first, last = (dt.date.fromisoformat(d) if isinstance(d, str) else d for d in (start, end))
    spark = df.sparkSession
    rows = df.filter(F.col(date).between(F.lit(first), F.lit(last))).withColumn(DAY, F.col(date))
    staged = fresh_path(spark, "range")
    rows.hint("rebalance", DAY).write.partitionBy(DAY).parquet(staged)      # the input may be the table that is replaced
    staged_rows = spark.read.schema(rows.schema).parquet(staged)
    days = {r[0] for r in staged_rows.select(DAY).distinct().collect()}     # days of the range at most
    writer = staged_rows.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(path)
    for n in range((last - first).days + 1):
        gone = first + dt.timedelta(days=n)
        if gone not in days:
            _remove(spark, f"{path}/{DAY}={gone.isoformat()}")


def load_range(spark: SparkSession, path: str, schema: T.StructType, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """The rows of [start, end] of a table saved by range: folders of other days are not read."""
    known = T.StructType([f for f in schema.fields if f.name != DAY] + [T.StructField(DAY, T.DateType())])
    first, last = (dt.date.fromisoformat(d) if isinstance(d, str) else d for d in (start, end))
    return spark.read.schema(known).parquet(path).filter(F.col(DAY).between(F.lit(first), F.lit(last))).drop(DAY)


def _remove(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """Read a feature table written by ``save_table``."""
    return spark.read.parquet(path)


def fetch_date_range(df: DataFrame, start: str | dt.date | None = None,
                     end: str | dt.date | None = None) -> DataFrame:
    """Keep facts of [start, end], both included; by default the last 30 days up to today."""
    end = dt.date.fromisoformat(end) if isinstance(end, str) else end or dt.date.today()
    start = dt.date.fromisoformat(start) if isinstance(start, str) else (
        start or dt.date.today() - dt.timedelta(days=30))
    return df.filter(F.col("c_date").between(F.lit(start), F.lit(end)))


REJECTS = "_rejects"     # column and raw text of every value of a row that cannot be read


def is_blank(text: Column) -> Column:
    """Nothing was given: null, white space or nan."""
    return text.isNull() | (F.trim(text) == "") | (F.lower(F.trim(text)) == "nan")


def rejects(checks: Mapping[str, tuple[Column, Column]]) -> Column:
    """Of each (raw value, value read) those that were given and could not be read."""
    found = [F.when(~is_blank(raw.cast("string")) & value.isNull(), F.struct(F.lit(name).alias("column"), raw.cast("string").alias("raw")))
             for name, (raw, value) in checks.items()]
    return F.filter(F.array(*found), lambda r: r.isNotNull())


def check_unified(df: DataFrame, source_name: str) -> DataFrame:
    """All rows under the unified contract, with ``_rejects``: empty, or what of the row cannot be read.

    A normaliser's own ``_rejects`` are kept. Numbers and dates that cannot be read are null here.
    """
    missing = [c for c in UNIFIED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(
            f"Connector '{source_name}' is missing columns: {missing}. Required: {UNIFIED_COLUMNS}")

    def read(name: str) -> Column:
        if name == "c_date":
            return F.col(name).try_cast("date")
        number = F.col(name).try_cast("double")
        return F.when(~F.isnan(number), number).try_cast(FACT_TYPES[name])

    values = {c: read(c) for c in ["c_date", *NUMERIC_COLUMNS]}
    found = rejects({c: (F.col(c), v) for c, v in values.items()})
    if REJECTS in df.columns:
        found = F.concat(F.col(REJECTS), found)

    def column(name: str) -> Column:
        if name == "source":
            return F.lit(source_name)
        if name in NUMERIC_COLUMNS:
            zero = F.lit(0).cast(FACT_TYPES[name])
            return F.when(is_blank(F.col(name).cast("string")), zero).otherwise(values[name])
        return values.get(name, F.col(name))

    return df.select([column(c).alias(c) for c in UNIFIED_COLUMNS] + [found.alias(REJECTS)])


def validate_unified(df: DataFrame, source_name: str) -> DataFrame:
    """Enforce the unified contract: columns and order, date type, source name, missing numbers as 0.

    Rows with a number or date that cannot be read are left out; ``combine_checked`` tells which.
    """
    return without_rejects(check_unified(df, source_name))


def without_rejects(checked: DataFrame) -> DataFrame:
    """The rows with empty ``_rejects``, without that column.

    Kept by a generator, not a filter: Spark pushes a filter into the source's own
    columns, which repeats their parsing (a JSON text's) for every value checked.
    """
    names = [c for c in checked.columns if c != REJECTS]
    kept = F.when(F.size(REJECTS) == 0, F.array(F.struct(*names)))
    rows = checked.select(F.explode_outer(kept).alias("_kept"))
    return rows.filter(F.col("_kept").isNotNull()).select([F.col("_kept")[c].alias(c) for c in names])


def rejected_values(checked: DataFrame) -> DataFrame:
    """(source, campaign_name, c_date, column, raw): every value that cannot be read, with what can be of its row."""
    return checked.filter(F.size(REJECTS) > 0).select(
        "source", "campaign_name", "c_date", F.explode(REJECTS).alias("r")).select("source", "campaign_name", "c_date", "r.*")


def unread_dates(frames: Mapping[str, DataFrame | Callable[[], DataFrame]]) -> DataFrame | None:
    """(source, unread_dates): how many rows of every source have a date that cannot be read, which no date range keeps.

    A lazy sum over the rows as they come. Sources that fail to load or have no date column are left out: ``combine_sources``
    reports them. None if no source is left.
    """
    counted = None
    for name, frame in frames.items():
        try:
            frame = frame() if callable(frame) else frame
            text = F.col("c_date").cast("string")
            bad = (F.trim(text) != "") & (F.lower(F.trim(text)) != "nan") & F.col("c_date").try_cast("date").isNull()
            part = frame.agg(F.lit(name).alias("source"), F.count(F.when(bad, 1)).alias("unread_dates"))
        except Exception:  # one bad source must not stop the others
            continue
        counted = part if counted is None else counted.unionByName(part)
    return counted


def combine_sources(frames: Mapping[str, DataFrame | Callable[[], DataFrame]], start: str | None = None,
                    end: str | None = None, ordered: bool = True) -> tuple[DataFrame | None, list[dict[str, str]]]:
    """Validate every source and stack the valid ones, in (source, campaign, date) order unless that is not asked for.

    With a start or an end only the facts of that range are kept. A source that fails to load or to validate is left out and reported in
    the second result. Only schemas are looked at here; no data is read.
    """
    stacked, errors = None, []
    for name, frame in frames.items():
        try:
            part = validate_unified(frame() if callable(frame) else frame, name)
        except Exception as exc:  # one bad source must not stop the others
            errors.append({"connector": name, "error": str(exc)})
            continue
        stacked = part if stacked is None else stacked.unionByName(part)
    if stacked is None:
        return None, errors
    if start is not None or end is not None:
        stacked = fetch_date_range(stacked, start, end)
    return stacked.orderBy("source", "campaign_name", "c_date") if ordered else stacked, errors


def combine_checked(spark: SparkSession, frames: Mapping[str, DataFrame | Callable[[], DataFrame]], start: str | None = None,
                    end: str | None = None) -> tuple[DataFrame | None, DataFrame | None, list[dict[str, str]]]:
    """Accepted facts, rejected values, and errors of whole sources. Every source is read once.

    Like ``combine_sources``, but one bad row costs only itself and is told. The
    checked rows are written to the shared folder, accepted and rejected ones
    apart; a date range is applied to the accepted ones.
    """
    stacked, errors = None, []
    for name, frame in frames.items():
        try:
            part = check_unified(frame() if callable(frame) else frame, name)
        except Exception as exc:  # one bad source must not stop the others
            errors.append({"connector": name, "error": str(exc)})
            continue
        stacked = part if stacked is None else stacked.unionByName(part)
    if stacked is None:
        return None, None, errors
    path = fresh_path(spark, "checked")
    stacked = stacked.withColumn("_accepted", F.size(REJECTS) == 0)
    stacked.write.partitionBy("_accepted").parquet(path)
    checked = spark.read.schema(stacked.schema).parquet(path)
    accepted = checked.filter("_accepted").select(UNIFIED_COLUMNS)
    if start is not None or end is not None:
        accepted = fetch_date_range(accepted, start, end)
    return accepted, rejected_values(checked.filter("NOT _accepted")), errors


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """(source, column, n_rejected)."""
    return rejected.groupBy("source", "column").agg(F.count(F.lit(1)).alias("n_rejected"))


def source_summary(df: DataFrame) -> DataFrame:
    """Rows, campaigns, totals, overall ROAS (only with spend) and date range of each source.

    Facts are summed per (source, campaign) first: the distinct count then
    is a plain count, and a source with most of the rows shuffles as little
    as the others.
    """
    per_campaign = df.filter(F.col("source").isNotNull()).groupBy("source", "campaign_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("mark_spent").alias("spend"),
        F.sum("revenue").alias("rev"),
        F.min("c_date").alias("first_day"),
        F.max("c_date").alias("last_day"))
    totals = per_campaign.groupBy("source").agg(
        F.sum("n").alias("n_rows"),
        F.count("campaign_name").alias("n_campaigns"),
        F.sum("spend").alias("total_spend"),
        F.sum("rev").alias("total_revenue"),
        F.min("first_day").alias("start_date"),
        F.max("last_day").alias("end_date"))
    return totals.withColumn(
        "overall_roas",
        F.when(F.col("total_spend") > 0, ratio("total_revenue", "total_spend")))
