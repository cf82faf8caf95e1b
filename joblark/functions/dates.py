"""Date texts of the job sites as ``yyyy-MM-dd`` strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from joblark.functions.text import NON_SPACE_CLASS, SPACE_CLASS, let, or_empty, pad2, strip

MINUTE, HOUR, DAY = 60, 3600, 86400

# Unit words in the order they are tried, with their length in seconds.
UNIT_SECONDS = (
    ("month", 30 * DAY), ("tháng", 30 * DAY),
    ("year", 365 * DAY), ("năm", 365 * DAY),
    ("second", 1), ("giây", 1),
    ("minute", MINUTE), ("phút", MINUTE),
    ("hour", HOUR), ("giờ", HOUR),
    ("day", DAY), ("ngày", DAY),
    ("week", 7 * DAY), ("tuần", 7 * DAY),
)

_AMOUNT_AND_UNIT = f"(?:^|{SPACE_CLASS})([0-9]+){SPACE_CLASS}+({NON_SPACE_CLASS}+)"
_MAX_AMOUNT = 10**11  # more than that lies before year 1 even in seconds
_FIRST_DAY = -719162  # 0001-01-01 as days since 1970-01-01

DMY = r"([0-9]{1,2})[-/]([0-9]{1,2})[-/]([0-9]{4})"


def relative_date(text: Column, anchor: Column) -> Column:
    """``3 days ago`` seen at ``anchor`` (a timestamp) as a UTC date string.

    The first all-digit word is the amount and the next word the unit. Text
    without both, with an unknown unit, or that would lie before year 1 comes
    back as it is; null and empty text give ``""``.
    """
    def unit_seconds(unit: Column) -> Column:
        chain = F.when(F.lit(False), F.lit(0).cast("bigint"))
        for word, length in UNIT_SECONDS:
            chain = chain.when(F.contains(unit, F.lit(word)), F.lit(length).cast("bigint"))
        return chain

    def days_of(low: Column) -> Column:
        amount = F.regexp_extract(low, _AMOUNT_AND_UNIT, 1).try_cast("bigint")
        seconds = let(F.regexp_extract(low, _AMOUNT_AND_UNIT, 2), unit_seconds)
        back = F.when(amount <= _MAX_AMOUNT, amount) * seconds
        return F.floor((F.unix_seconds(anchor) - back) / F.lit(DAY)).cast("bigint")

    def shown(days: Column) -> Column:
        return F.when(days >= _FIRST_DAY, F.date_format(F.date_from_unix_date(days.try_cast("int")), "yyyy-MM-dd"))

    date = let(let(F.lower(text), days_of), shown)
    return F.when(or_empty(text) == "", F.lit("")).otherwise(F.coalesce(date, text))


def dmy_date(text: Column) -> Column:
    """The first ``d/m/yyyy`` or ``d-m-yyyy`` as ``yyyy-mm-dd``.

    There is no calendar check. Text without one comes back stripped, null as ``""``.
    """
    day, month, year = (F.regexp_extract(text, DMY, i) for i in (1, 2, 3))
    return (
        F.when(or_empty(text) == "", F.lit(""))
        .when(F.rlike(text, F.lit(DMY)), F.concat_ws("-", year, pad2(month), pad2(day)))
        .otherwise(strip(text))
    )


def key_date(posted_date: Column) -> Column:
    """A raw posted date as key text: the calendar date, or ``""`` when it is none.

    Both sides of a key comparison go through this, so a raw text that the typed
    table stores as null still meets its own row again.
    """
    return or_empty(F.date_format(F.try_to_date(posted_date, "yyyy-MM-dd"), "yyyy-MM-dd"))


def ntz_as_utc(ts: Column) -> Column:
    """A zone-less timestamp taken as UTC, whatever the session's zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")
