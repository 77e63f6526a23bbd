"""Repairs of badly loaded text tables: null text, logical text, epoch text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklake.functions.times import epoch_text_to_iso, is_epoch_text
from tracklake.functions.values import (
    logical_text_to_digit,
    text_to_null,
    text_to_null_loosely,
    without_line_breaks,
)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _apply(df: DataFrame, columns: list[str], rule) -> DataFrame:
    return df.withColumns({n: rule(F.col(n)) for n in columns}) if columns else df


def _affected(df: DataFrame, columns: list[str], test) -> DataFrame:
    """Rows a repair touches, per column, from one pass."""
    counted = df.agg(*[F.count(F.when(test(F.col(n)), 1)).alias(n) for n in columns])
    return counted.unpivot([], columns, "column_name", "num_rows")


def null_text(df: DataFrame, value: str = "NA", loosely: bool = False, columns=None) -> DataFrame:
    """Empty every text cell that holds the value."""
    rule = text_to_null_loosely if loosely else text_to_null
    return _apply(df, columns or text_columns(df), lambda c: rule(c, value))


def null_text_report(df: DataFrame, value: str = "NA", loosely: bool = False, columns=None):
    def test(c):
        return F.upper(F.trim(c)) == value.upper() if loosely else c == value

    return _affected(df, columns or text_columns(df), test)


def logical_text(df: DataFrame, columns=None) -> DataFrame:
    """TRUE and FALSE text become 1 and 0."""
    return _apply(df, columns or text_columns(df), logical_text_to_digit)


def logical_text_report(df: DataFrame, columns=None) -> DataFrame:
    return _affected(df, columns or text_columns(df), lambda c: c.isin("TRUE", "FALSE"))


def epoch_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Seconds since 1970 as text become ISO text."""
    return _apply(df, columns, epoch_text_to_iso)


def epoch_text_report(df: DataFrame, columns: list[str]) -> DataFrame:
    return _affected(df, columns, is_epoch_text)


def tidy_text(df: DataFrame, columns=None) -> DataFrame:
    """No line breaks, no blanks at the ends."""
    return _apply(df, columns or text_columns(df), without_line_breaks)
