"""Missing values, text and number rules as column expressions."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.DoubleType, T.FloatType)

# White space as R's regular expressions understand it, for Java and RE2 alike.
BLANK = r"[\t\n\f\r\p{Z}]"
HAS_LINE_BREAK = r"[\r\n]"
STARTS_BLANK = f"^{BLANK}"
ENDS_BLANK = rf"{BLANK}\z"


def present(df: DataFrame, name: str) -> Column:
    """True where the column has a value; NaN counts as missing."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, FLOATING):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def missing(df: DataFrame, name: str) -> Column:
    return ~present(df, name)


def value_count(df: DataFrame, names: list[str]) -> Column:
    """How many of the named columns have a value in this row."""
    ones = [F.when(present(df, n), 1).otherwise(0) for n in names]
    return reduce(lambda a, b: a + b, ones, F.lit(0)).cast("int")


def first_present(df: DataFrame, preferred: str, fallback: str) -> Column:
    """The preferred value, or the fallback where it is missing."""
    return F.when(present(df, preferred), F.col(preferred)).otherwise(F.col(fallback))


def without_line_breaks(c: Column) -> Column:
    """Line breaks become blanks, then blanks at both ends go."""
    return F.regexp_replace(F.regexp_replace(c, "[\r\n]", " "), "^[ \t\r\n]+|[ \t\r\n]+$", "")


def untidy(c: Column) -> Column:
    """True for text with a line break or with blanks at either end."""
    return c.rlike(HAS_LINE_BREAK) | c.rlike(STARTS_BLANK) | c.rlike(ENDS_BLANK)


def contains_ignoring_case(c: Column, part: str) -> Column:
    return F.lower(c).contains(part.lower())


def logical_text_to_digit(c: Column) -> Column:
    """TRUE becomes 1 and FALSE becomes 0; other text stays."""
    return F.when(c == "TRUE", F.lit("1")).when(c == "FALSE", F.lit("0")).otherwise(c)


def text_to_null(c: Column, value: str) -> Column:
    return F.when(c == value, F.lit(None)).otherwise(c)


def text_to_null_loosely(c: Column, value: str) -> Column:
    """As text_to_null, but blanks around the text and its case do not matter."""
    return F.when(F.upper(F.trim(c)) == value.upper(), F.lit(None)).otherwise(c)


def round_even(c: Column, digits: int) -> Column:
    """Round half to even."""
    return F.bround(c, digits)
