"""Scalar column functions over measures and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def hours_between(start: Column, end: Column) -> Column:
    """Fractional hours from start to end; NULL if either is missing."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_HOUR))


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end, floored: 23:00 to 01:00 is 0, half a day back is -1."""
    return F.floor(micros_between(start, end) / F.lit(float(MICROS_PER_DAY))).cast("bigint")


def add_time(ts: Column, days: Column | int = 0, hours: Column | float = 0) -> Column:
    """Timestamp plus whole days and fractional hours."""
    days = days if isinstance(days, Column) else F.lit(days)
    hours = hours if isinstance(hours, Column) else F.lit(hours)
    micros = days.cast("bigint") * F.lit(MICROS_PER_DAY) + F.round(
        hours.cast("double") * F.lit(float(MICROS_PER_HOUR))
    ).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, ts)


def sub_days(ts: Column, days: int) -> Column:
    return add_time(ts, days=-days)


def parse_ts(text: Column, fmt: str | None = None) -> Column:
    """Text to a timestamp without zone; text that does not parse becomes NULL."""
    parsed = F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)
    return parsed.cast("timestamp_ntz")


def key_long(col: Column) -> Column:
    """Key to bigint, also from text such as ``123.0``; a bad key becomes NULL."""
    return col.try_cast("double").try_cast("bigint")


def age_at(year: Column, reference_year: int) -> Column:
    return F.lit(reference_year) - year


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in which a zero denominator gives NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round2(x: Column) -> Column:
    return F.round(x, 2)


def clip(x: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; a missing value stays missing."""
    bounded = F.least(F.greatest(x, F.lit(low)), F.lit(high))
    return F.when(x.isNotNull(), bounded)


def fill(x: Column, value) -> Column:
    return F.coalesce(x, F.lit(value))


def finite_or_null(x: Column) -> Column:
    """NaN and the two infinities become NULL."""
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def month_abbr(ts: Column) -> Column:
    return F.date_format(ts, "MMM")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")
