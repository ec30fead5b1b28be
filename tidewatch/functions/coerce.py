"""Typing of raw text columns: header trim, dates, numbers, day differences, item lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
MICROS_PER_DAY = 86_400_000_000
# Two-digit years 69-99 belong to the 1900s, 00-68 to the 2000s.
LAST_2000S_YEAR = 2068


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def to_date(text: Column, pattern: str = "d-MMM-yy") -> Column:
    """Parse day-month-year text; unparsable text is NULL. Also takes ISO dates."""
    clean = F.trim(text.cast("string"))
    parsed = F.try_to_timestamp(clean, F.lit(pattern))
    if "yyyy" not in pattern:
        parsed = F.when(F.year(parsed) > LAST_2000S_YEAR, F.add_months(parsed, -1200).cast("timestamp")).otherwise(parsed)
    iso = F.try_to_timestamp(clean, F.lit("yyyy-MM-dd"))
    return F.to_date(F.coalesce(parsed, iso))


def to_number(text: Column) -> Column:
    """Parse a number; anything else, NaN included, is NULL."""
    clean = F.trim(text.cast("string"))
    return F.when(clean.rlike(NUMBER), clean.try_cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def day_difference(begin: Column, end: Column) -> Column:
    """Whole elapsed days, rounded down."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(begin.cast("timestamp"))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("bigint")


def split_items(text: Column) -> Column:
    """Comma-separated text to a list of trimmed, non-empty items; NULL gives an empty list."""
    parts = F.transform(F.split(text, ","), lambda x: F.trim(x))
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def as_label(df: DataFrame, column: str) -> Column:
    """Text form of a category; whole doubles lose their trailing ``.0``."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        whole = value == F.floor(value)
        return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
    return value.cast("string")


def numeric_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in set(skip)]


def string_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in set(skip)]


def coerce(df: DataFrame, dates: Iterable[str] = (), numbers: Iterable[str] = (), pattern: str = "d-MMM-yy") -> DataFrame:
    """Type a raw table: the named columns that exist are parsed, the rest is left alone."""
    df = trim_headers(df)
    typed = {c: to_date(F.col(c), pattern) for c in dates if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)}
    typed |= {c: to_number(F.col(c)) for c in numbers if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)}
    return nan_to_null(df.withColumns(typed) if typed else df)
