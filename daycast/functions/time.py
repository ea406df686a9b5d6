"""Time expressions over naive local timestamps (TIMESTAMP_NTZ).

Local hours with daylight saving are stored as naive wall-clock stamps. Every helper
here stays in TIMESTAMP_NTZ / DATE arithmetic, so no session time zone can move an
hour (the spring gap 02:00 stays 02:00, both autumn 01:00 rows stay 01:00).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c) -> Column:
    """Parse a string (or coerce a timestamp) to TIMESTAMP_NTZ. Malformed text raises
    under ANSI mode, like a strict cast."""
    return _c(c).cast("timestamp_ntz")


def hour_floor(c) -> Column:
    """Start of the hour, computed from fields so it never leaves NTZ."""
    c = _c(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def epoch_day(c) -> Column:
    """Whole days since 1970-01-01 of the local date (INT)."""
    return F.unix_date(F.to_date(_c(c)))


def shift_days(c, n: int) -> Column:
    """Same wall-clock time ``n`` days later (negative: earlier)."""
    return F.timestamp_add("DAY", F.lit(n), _c(c))


def cutoff_time(target, days_before: int = 1, hour: int = 10) -> Column:
    """``hour`` o'clock on the day ``days_before`` days before the target's date (NTZ)."""
    midnight = F.to_date(_c(target)).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", F.lit(hour - 24 * days_before), midnight)


def day_of_week0(c) -> Column:
    """Day of week with Sunday = 0 .. Saturday = 6 (INT)."""
    return (F.dayofweek(_c(c)) - 1).cast("int")


def month_key(c) -> Column:
    """Month period as text 'yyyy-MM'."""
    return F.date_format(_c(c), "yyyy-MM")


def month_start(c) -> Column:
    """First day of the month (DATE)."""
    return F.trunc(F.to_date(_c(c)), "month")


def range_text(first, last) -> Column:
    """Feed range text 'MM-dd-yyyy 00:00 to MM-dd-yyyy 23:59' for a first and last day."""
    return F.concat(
        F.date_format(_c(first), "MM-dd-yyyy"), F.lit(" 00:00 to "),
        F.date_format(_c(last), "MM-dd-yyyy"), F.lit(" 23:59"),
    )


def week_start(c) -> Column:
    """Monday of the ISO week (DATE)."""
    d = F.to_date(_c(c))
    return F.date_sub(d, (F.dayofweek(d) + 5) % 7)


def week_label(c) -> Column:
    """Week period as text: Monday's date 'yyyy-MM-dd'."""
    return F.date_format(week_start(c), "yyyy-MM-dd")
