"""Date parsing and calendar arithmetic.

A layout is recognised by its shape before it is cast. The frequent numeric layouts become ISO text
for ``try_cast``, which answers null without raising; format strings, which raise and swallow an
exception per layout that does not fit, are tried for the few wordy layouts only. This also keeps
the generated code small enough for the JIT compiler.

All functions need the session time zone to be UTC (``session.prepare``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NTZ = "timestamp_ntz"

# The shapes of the numeric layouts.
YEAR_FIRST = r"^\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?)?$"
YEAR_LAST = (r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4})"
             r"( \d{1,2}:\d{1,2}(?::\d{1,2})?)?$")
_ZONE = r"(Z|UTC|GMT|[+-]\d{2}:?\d{2})$"
ZONED = r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}(?::[\d.]+)? ?" + _ZONE
ZONED_MINUTE = r"^(\S+[T ]\d{1,2}:\d{1,2}) ?" + _ZONE
WORDY = (r"(?i)^(?:\d{8}|\d{4}/.*|.*\d ?[ap]m|\d{1,2}/\d{1,2}/\d{2}( .*)?"
         r"|.*(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec).*)$")

# The wordy layouts as optional sections of one pattern, then with the day first.
WORDY_PATTERNS = (
    "[yyyy/M/d H:m:s][yyyy/M/d H:m][yyyy/M/d][yyyyMMdd]"
    "[M/d/yyyy h:m:s a][M/d/yyyy h:m a][M/d/yy H:m:s][M/d/yy H:m][M/d/yy]"
    "[MMM d, yyyy][MMMM d, yyyy][MMM d yyyy][MMMM d yyyy][MMM yyyy][MMMM yyyy]",
    "[d/M/yyyy h:m:s a][d/M/yyyy h:m a][d/M/yy H:m:s][d/M/yy H:m][d/M/yy]"
    "[d-MMM-yyyy][d-MMMM-yyyy][d MMM yyyy][d MMMM yyyy]",
)


# The first and last whole second that a nanosecond time of 64 bits can hold. Times
# outside, such as 9999-12-31 for "still open", count as unparseable.
FIRST, LAST = "1677-09-21 00:12:44", "2262-04-11 23:47:16"


def _ntz(text: Column) -> Column:
    return text.try_cast(_NTZ)


def parse_datetime(text: Column) -> Column:
    """Stripped ticket time text to TIMESTAMP_NTZ cut to the second; null if nothing fits.

    Month before day wherever both are possible; day before month only for an impossible month.
    Instants with an offset become UTC wall-clock time; times outside FIRST .. LAST become null.
    """
    return in_range(parse_any_year(text))


def in_range(time: Column) -> Column:
    """``time``, which should be a plain column as it is referred to three times; null outside FIRST .. LAST."""
    return F.when(time.between(F.lit(FIRST).cast(_NTZ), F.lit(LAST).cast(_NTZ)), time)


def parse_any_year(text: Column) -> Column:
    """parse_datetime without the limits FIRST and LAST."""
    year_first = _ntz(F.substring_index(text, ".", 1))
    month_first = _ntz(F.regexp_replace(text, YEAR_LAST, "$4-$1-$3$5"))
    day_first = _ntz(F.regexp_replace(text, YEAR_LAST, "$4-$3-$1$5"))
    wordy = F.coalesce(*(F.try_to_timestamp(text, F.lit(p)) for p in WORDY_PATTERNS))
    zoned = F.regexp_replace(text, ZONED_MINUTE, "$1:00$2").try_cast("timestamp")
    instant = (F.when(text.rlike(ZONED), F.date_trunc("second", zoned))
               .when(text.rlike(WORDY), wordy))
    return (
        F.when(text.rlike(YEAR_FIRST), year_first)
        .when(text.rlike(YEAR_LAST), F.coalesce(month_first, day_first))
        .otherwise(instant.cast(_NTZ)))


def to_second(value: Column) -> Column:
    """Cut a TIMESTAMP_NTZ to the second (``date_trunc`` returns the zoned type)."""
    return F.date_trunc("second", value).cast(_NTZ)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def hour_boundaries(start: Column, end: Column) -> Column:
    """Clock-hour boundaries crossed: 00:59:59 to 01:00:00 counts as one."""
    return F.timestamp_diff("HOUR", F.date_trunc("hour", start), F.date_trunc("hour", end))


def date_key(value: Column) -> Column:
    """Integer ``yyyymmdd``; one reference to ``value``, so a pushed-down null test stays small."""
    return F.date_format(value, "yyyyMMdd").cast("int")


def monday_week(day: Column) -> Column:
    """Week of year 0-53 where week 1 starts on the first Monday (not the ISO week)."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")


def as_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
