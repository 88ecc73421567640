"""Timestamps on an hour or six-hour grid.

All arithmetic is on whole microseconds, so exact multiples and half-hour ties
are decided exactly. Times are UTC: sessions run with the UTC time zone, and
zone-less input is read as UTC by the cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MICROS = 3_600_000_000
SIX_HOUR_MICROS = 6 * HOUR_MICROS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str) -> Column:
    """Text to timestamp, unreadable text to null."""
    return _col(c).try_cast("timestamp")


def as_utc(c: Column | str) -> Column:
    """Read zone-less times as UTC; zoned times keep their instant."""
    return _col(c).cast("timestamp")


def timestamp_literal(text: str) -> Column:
    """A fixed point in time."""
    return F.lit(text).cast("timestamp")


def date_and_military_hour(date: Column | str, hour: Column | str) -> Column:
    """``'2019-01-05'`` and ``930`` to 09:30 that day.

    Hours that are no clock time (2400, 1075, negative) and unreadable dates
    give null, and so does a null hour.
    """
    whole = _col(hour).cast("int")

    def two_digits(part: Column) -> Column:
        # lpad would cut longer text; three digits must stay unreadable
        text = part.cast("string")
        return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)

    hours = two_digits(F.floor(whole / 100).cast("int"))
    minutes = two_digits(F.pmod(whole, F.lit(100)))
    stamp = F.concat(_col(date).cast("string"), F.lit(" "), hours, F.lit(":"), minutes, F.lit(":00"))
    return stamp.try_cast("timestamp")


def floor_hour(c: Column | str) -> Column:
    """Start of the hour."""
    return F.date_trunc("hour", as_utc(c))


def floor_six_hours(c: Column | str) -> Column:
    """T4: start of the six-hour slot."""
    micros = F.unix_micros(as_utc(c))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(SIX_HOUR_MICROS)))


def ceil_six_hours(c: Column | str) -> Column:
    """T5: end of the six-hour slot; exact multiples stay."""
    micros = F.unix_micros(as_utc(c))
    return F.timestamp_micros(micros + F.pmod(-micros, F.lit(SIX_HOUR_MICROS)))


def round_hour(c: Column | str) -> Column:
    """Nearest hour, a half hour goes to the even hour."""
    micros = F.unix_micros(as_utc(c))
    rest = F.pmod(micros, F.lit(HOUR_MICROS))
    base = micros - rest
    odd = F.pmod(F.floor(base / HOUR_MICROS), F.lit(2)) == 1
    up = (rest * 2 > HOUR_MICROS) | ((rest * 2 == HOUR_MICROS) & odd)
    return F.timestamp_micros(F.when(up, base + HOUR_MICROS).otherwise(base))


def crosses_midnight(start: Column | str, end: Column | str) -> Column:
    """1 when the two times fall on different days, else 0."""
    return (F.to_date(as_utc(start)) != F.to_date(as_utc(end))).cast("int")
