"""Small column expressions: safe ratios, rounding and number formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator with a zero denominator read as missing."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return num / F.nullif(den.cast("double"), F.lit(0.0))


def half_even(value: Column | str, digits: int) -> Column:
    """Round the scaled value half to even, as numpy and pandas do."""
    col = F.col(value) if isinstance(value, str) else value
    scale = float(10 ** digits)
    return F.rint(col.cast("double") * F.lit(scale)) / F.lit(scale)


def fixed(value: Column, digits: int, signed: bool = False) -> Column:
    """Text with a fixed number of decimals; a missing number reads ``nan``."""
    pattern = f"%{'+' if signed else ''}.{digits}f"
    return F.coalesce(
        F.when(value.isNotNull(), F.format_string(pattern, half_even(value, digits))), F.lit("nan"))


def shortest(value: Column, digits: int) -> Column:
    """Rounded number as text without trailing zeros, one decimal at least."""
    text = F.format_string(f"%.{digits}f", half_even(value, digits))
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1")


def clean_number(value: Column) -> Column:
    """Missing, NaN and infinite values become 0."""
    inf = F.lit(float("inf"))
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == inf), F.lit(0.0)).otherwise(value)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round all double columns for output; other columns pass through."""
    return df.select([
        half_even(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields])


def key_fraction(*columns: Column | str) -> Column:
    """A uniform number in [0, 1) from the row's business key.

    It depends on the key's text only, so it is the same whatever the
    partitioning, the run or the machine.
    """
    text = F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
