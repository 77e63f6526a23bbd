"""Timestamp rules as column expressions. The session time zone must be UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLIS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
EPOCH_TEXT = r"^-?\d+$"
DATE_START = r"^\s*\d{4}-\d{2}-\d{2}"


def millis_text(ts: Column) -> Column:
    """Text with milliseconds, rounded (half a millisecond is added before the cut)."""
    return F.date_format(ts + F.expr("interval 500 microseconds"), MILLIS_FORMAT)


def parse_time(text: Column) -> Column:
    """Text such as `2013-06-11 10:01:01.001` or `2013-06-11T10:01:01Z`; else missing."""
    return F.when(text.rlike(DATE_START), text.try_cast("timestamp"))


def is_epoch_text(text: Column) -> Column:
    """True for text that holds nothing but a whole number of seconds."""
    return text.rlike(EPOCH_TEXT)


def epoch_text_to_iso(text: Column) -> Column:
    """Seconds since 1970 as text become `2011-06-21T23:00:00Z`; other text stays."""
    seconds = F.when(is_epoch_text(text), text.try_cast("bigint"))
    return F.coalesce(F.date_format(F.timestamp_seconds(seconds), ISO_FORMAT), text)


def to_unit(ts: Column, unit: str | None) -> Column:
    """Cut to a whole second, hour, ...; no unit keeps the time as it is."""
    return ts if unit is None else F.date_trunc(unit, ts).cast("timestamp")


def year_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy")


def day(ts: Column) -> Column:
    return F.to_date(ts)


def second_text(ts: Column) -> Column:
    return F.date_format(ts, SECOND_FORMAT)


def millis_suffix(text: Column) -> Column:
    """The last four characters of a time with milliseconds, such as `.001`."""
    return F.substring(text, -4, 4)


def millis_of(ts: Column) -> Column:
    """The milliseconds within the second, as a whole number."""
    return F.floor(F.pmod(F.unix_micros(ts), F.lit(1_000_000)) / F.lit(1000)).cast("int")


def millis_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1000.0)
