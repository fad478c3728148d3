"""Event time: parsing of the accepted spellings and the parts the models use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings of an event time.
DIGITS = r"^[0-9]+$"
ISO_LIKE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$"


def parse_event_time(text: Column) -> Column:
    """A digit string is epoch nanoseconds; otherwise ISO `T` or space form; else null (F1)."""
    nanos = F.when(text.rlike(DIGITS), text).try_cast("bigint")
    iso = F.when(text.rlike(ISO_LIKE), text).try_cast("timestamp")
    return F.coalesce(F.timestamp_micros(F.call_function("div", nanos, F.lit(1000))), iso)


def event_date(time: Column, epoch_seconds: bool = False) -> Column:
    """The UTC day of a time string, or of epoch seconds (F2)."""
    return F.to_date(F.timestamp_seconds(time) if epoch_seconds else parse_event_time(time))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def iso_weekday(ts: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(ts) + 1


def sunday_weekday(ts: Column) -> Column:
    """1 = Sunday ... 7 = Saturday; only the baseline model counts this way."""
    return F.dayofweek(ts)


def is_weekend(ts: Column) -> Column:
    return (iso_weekday(ts) >= 6).cast("int")


def unix_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)
