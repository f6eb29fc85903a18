"""Column functions for trip timestamps, keys and calendar labels.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..period import MONTH_NAMES

PARTS = ("year", "month", "day", "hour", "minute")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trip_parts(pickup, dropoff) -> list[Column]:
    """Ten calendar/clock parts: ``pickup_year`` … ``dropoff_minute``."""
    out = []
    for role, ts in (("pickup", _c(pickup)), ("dropoff", _c(dropoff))):
        out += [F.year(ts).alias(f"{role}_year"), F.month(ts).alias(f"{role}_month"),
                F.dayofmonth(ts).alias(f"{role}_day"), F.hour(ts).alias(f"{role}_hour"),
                F.minute(ts).alias(f"{role}_minute")]
    return out


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds (fraction dropped), read as wall clock for
    ``TIMESTAMP_NTZ`` input so that a DST change never alters a duration."""
    return F.unix_timestamp(_c(ts))


def trip_minutes(pickup, dropoff) -> Column:
    """(dropoff - pickup) in minutes, truncated toward zero; negatives kept."""
    return ((epoch_seconds(dropoff) - epoch_seconds(pickup)) / 60).try_cast("int")


def seconds_to_minutes(secs) -> Column:
    return (_c(secs) / 60).try_cast("int")


def date_key(ts) -> Column:
    """``yyyymmdd`` integer key of a date or timestamp."""
    ts = _c(ts)
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def date_key_from_parts(y, m, d) -> Column:
    return (_c(y) * 10000 + _c(m) * 100 + _c(d)).cast("int")


def time_key(ts) -> Column:
    """``hhmm`` integer key of a timestamp's clock minute."""
    ts = _c(ts)
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def legacy_date_key(y, m, d) -> Column:
    """The unpadded key of the original pipeline: concat(y, m, d) as int.
    Not unique (2023-01-11 and 2023-11-01 are both 2023111); audits only."""
    return F.concat(_c(y).cast("string"), _c(m).cast("string"), _c(d).cast("string")).cast("int")


def legacy_time_key(h, m) -> Column:
    """The unpadded string key concat(hour, minute); 1:10 and 11:00 clash."""
    return F.concat(_c(h).cast("string"), _c(m).cast("string"))


def in_date_range(ts, start: dt.date, end: dt.date) -> Column:
    """``start <= date(ts) <= end`` written as a timestamp range, so that the
    predicate can reach a Parquet scan of the raw timestamp column."""
    # Literals from text: a Python datetime would pass through the session
    # and process time zones; text cast to TIMESTAMP_NTZ does not.
    lo = F.lit(f"{start.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{(end + dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    ts = _c(ts)
    return (ts >= lo) & (ts < hi)


def key_range(year: int, month: int) -> tuple[int, int]:
    """Smallest and largest ``yyyymmdd`` key of a month."""
    base = year * 10000 + month * 100
    return base + 1, base + 31


def month_label(month) -> Column:
    """English month name of a month number or zero-padded month string;
    anything else, null included, gives null."""
    names = F.create_map(*[x for i, n in enumerate(MONTH_NAMES)
                           for x in (F.lit(i + 1), F.lit(n))])
    return F.try_element_at(names, _c(month).try_cast("int"))


def default_period_cols(today, lag_months: int = 3) -> list[Column]:
    """Column form of ``period.default_period``: ``today`` minus the lag,
    rendered as ``period_year`` (yyyy) and ``period_month`` (MM)."""
    d = F.add_months(F.to_date(_c(today)), -lag_months)
    return [F.date_format(d, "yyyy").alias("period_year"),
            F.date_format(d, "MM").alias("period_month")]
