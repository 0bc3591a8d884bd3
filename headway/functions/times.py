"""Service-day time helpers (GTFS ``H:MM:SS`` with hours past 24)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400
SECONDS_PER_HOUR = 3_600

# Fixed value: the accepted time shape is one or two hour digits, then two
# minute and two second digits.  Minutes and seconds are not range-checked.
# ``\z`` anchors at the true end of the text (Java's ``$`` would also match
# before a trailing newline).
_TIME_PATTERN = r"^\d{1,2}:\d{2}:\d{2}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gtfs_time_digits(c: Column | str) -> Column:
    """The digits of a time as one number (``5:07:30`` -> 50730); NULL for
    NULL or malformed text."""
    text = _col(c).cast("string")
    digits = F.replace(text, F.lit(":"), F.lit("")).cast("long")
    return F.when(text.rlike(_TIME_PATTERN), digits)


def digits_to_seconds(c: Column | str) -> Column:
    """Seconds from service midnight of ``gtfs_time_digits``."""
    n = _col(c)
    hours, minutes = F.call_function("div", n, F.lit(10_000)), F.call_function("div", n, F.lit(100))
    # n is 10000 h + 100 m + s, and ``minutes`` is 100 h + m.
    return n - minutes * 40 - hours * 2400


def gtfs_time_to_seconds(c: Column | str) -> Column:
    """Seconds from service midnight; NULL for NULL or malformed text.

    Hours of 24 and more are kept (``25:15:00`` -> 90900)."""
    return digits_to_seconds(gtfs_time_digits(c))


def clock_date(service_date: Column | str, offset_days: Column | str) -> Column:
    """Service date moved forward by the overflow offset."""
    return F.date_add(_col(service_date), _col(offset_days).cast("int"))
