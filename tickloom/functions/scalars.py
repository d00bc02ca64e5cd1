"""Column expressions shared by the models. All stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Two averages of the same prices can differ in the last bits of a double.
TREND_TOLERANCE = 1e-12


def trade_date(timestamp: Column | str) -> Column:
    """The day in UTC, whatever the session's time zone. Where that is UTC too, it is a plain cast,
    through which Spark pushes date filters to the scan."""
    if SparkSession.active().conf.get("spark.sql.session.timeZone") == "UTC":
        return F.to_date(timestamp)
    return F.date_from_unix_date(F.floor(micros(timestamp) / F.lit(86_400_000_000)).cast("int"))


def micros(timestamp: Column | str) -> Column:
    """Microseconds since 1970; a timestamp without zone is taken in the session's."""
    return F.unix_micros(_c(timestamp).cast("timestamp"))


def epoch_seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds with fraction from start to end."""
    return (micros(end) - micros(start)) / F.lit(1e6)


def percent_change(new: Column | str, old: Column | str) -> Column:
    """(new - old) / old * 100; null when old is zero."""
    return F.try_divide(_c(new) - _c(old), _c(old)) * 100


def range_percent(high: Column | str, low: Column | str) -> Column:
    """Range as a percentage of the mid price; null when the mid price is zero."""
    return F.try_divide(_c(high) - _c(low), (_c(high) + _c(low)) / 2) * 100


def trend(fast: Column | str, slow: Column | str) -> Column:
    """Bullish when the fast average is above the slow one, Bearish below, else or null Neutral."""
    gap = _c(fast) - _c(slow)
    noise = F.abs(_c(slow)) * TREND_TOLERANCE
    return F.when(gap > noise, "Bullish").when(gap < -noise, "Bearish").otherwise("Neutral")


def order_key(timestamp: Column | str, tick_id: Column | str) -> Column:
    """(timestamp, id) as one decimal(38,0).

    A struct would order the same but forces a sort-based aggregate; a decimal fits the hash
    aggregate's fixed-width buffer. Ids of any sign fit between two microseconds, 2**64 apart.
    """
    at = micros(timestamp).cast("decimal(38,0)")
    step = F.lit(str(2**64)).cast("decimal(20,0)")
    return (at * step + F.coalesce(_c(tick_id), F.lit(0))).cast("decimal(38,0)")


def text_to_double(text: Column | str) -> Column:
    """Number from text with an optional percent sign; null when it is not a number."""
    return F.btrim(_c(text), F.lit("%")).try_cast("double")


def text_to_long(text: Column | str) -> Column:
    return _c(text).try_cast("bigint")


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
