"""Time expressions.

Trip times are zone-less: their seconds are counted without a zone, so results are the same in every
session time zone and on days when clocks change.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def whole_seconds_between(start: Column, end: Column) -> Column:
    """Seconds from `start` to `end`, each cut to its whole second."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def whole_minutes_between(start: Column, end: Column) -> Column:
    """Minutes as a double, from whole seconds."""
    return whole_seconds_between(start, end) / F.lit(60.0)


def epoch_micros(ts: Column) -> Column:
    """Microseconds of a timestamp since the epoch."""
    of_minute = F.rint(F.date_part(F.lit("SECOND"), ts).cast("double") * 1e6).cast("long")
    # Seconds are cut towards zero, which before 1970 is one second after the last whole one.
    cut = F.unix_timestamp(ts)
    whole = cut - F.pmod(cut - F.floor(of_minute / 1_000_000), F.lit(60))
    return whole * 1_000_000 + of_minute % 1_000_000


def from_epoch_micros(micros: Column) -> Column:
    """The zone-less timestamp of an `epoch_micros` value."""
    seconds = (micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def fractional_minutes_between(start: Column, end: Column) -> Column:
    """Minutes as a double, to the microsecond."""
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(60_000_000.0)


def weekday_from_sunday(day: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(day) - 1
