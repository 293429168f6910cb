"""Dates out of text, and month arithmetic."""

from __future__ import annotations

import calendar
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabprep.functions.text import as_column, strip

# Names of months, long or of three letters, and one of four.
MONTHS = tuple(m.lower() for m in calendar.month_name[1:])
MONTH_NAME = "^(" + "|".join(f"{m[:3]}({m[3:]})?" if len(m) > 3 else m for m in MONTHS) + "|sept)$"

# What the classes of dates look like; each may be followed by a time of day.
TIME = r"( +\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
NUMBERS = r"^\d{1,2}([/.-])\d{1,2}\1\d{4}" + TIME
YEAR_FIRST = r"^\d{4}(\D|$)"
ORDINAL = r"(?:st|nd|rd|th)?"
NAME_FIRST = r"^(\p{L}+)\.?[ /-](\d{1,2})" + ORDINAL + r",?[ /-](\d{4})" + TIME
DAY_FIRST = r"^(\d{1,2})" + ORDINAL + r"[ /-](\p{L}+)\.?,?[ /-](\d{4})" + TIME

AVERAGE_MONTH_DAYS = 30.44


def clean_date(c: Column | str, formats: Sequence[str] | None = None) -> Column:
    """Timestamp from text in any known layout; null where none fits.

    Day and month in numbers are read day first, and month first only where that is no date; with
    dots or a time of day it is the other way round. ``formats`` replaces the built-in layouts by
    Spark datetime patterns. A few characters tell which class a text belongs to, and only that
    class is tried; all parts are put together as an ISO text, which needs no formatter.
    """
    text = strip(c)
    if formats is not None:
        return F.coalesce(*[F.try_to_date(text, f).cast("timestamp_ntz") for f in formats])
    found = (
        F.when(F.substring(text, 5, 1) == "-", text)
        .when(text.rlike(r"\p{L}"), _named_month(text))
        .when(text.rlike(r"^\d{8}$"), _iso(F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)))
        # The cast alone would also take five and six digits as a year.
        .when(text.rlike(YEAR_FIRST), F.regexp_replace(text, r"^(\d{4})[/.](\d{1,2})[/.]", "$1-$2-"))
        .when(text.rlike(NUMBERS), _numbers(text))
    )
    return found.try_cast("timestamp_ntz")


def _iso(year: Column, month: Column, day: Column, text: Column | None = None) -> Column:
    """ISO text of a date, with the time of day that stands in ``text`` after it."""
    date = F.concat_ws("-", year, month, day)
    if text is None:
        return date
    # The time is the last word, if that holds a colon.
    last = F.substring_index(text, " ", -1)
    return F.when(F.contains(text, F.lit(":")), F.concat_ws(" ", date, last)).otherwise(date)


def _numbers(text: Column) -> Column:
    """Two numbers and a year: whichever order makes a date, the usual one first."""
    date = F.translate(F.substring_index(text, " ", 1), ".-", "//")
    first, second, year = (F.split_part(date, F.lit("/"), F.lit(i)) for i in (1, 2, 3))
    inferred = F.contains(text, F.lit(":")) | F.contains(text, F.lit("."))
    usual = F.when(inferred, _iso(year, first, second)).otherwise(_iso(year, second, first))
    month_first = F.when(usual.try_cast("date").isNotNull(), inferred).otherwise(~inferred)
    return F.when(month_first, _iso(year, first, second, text)).otherwise(_iso(year, second, first, text))


def _named_month(text: Column) -> Column:
    """A month by name, a day and a year."""
    name_first = text.rlike(NAME_FIRST)

    def part(in_name_first: int, in_day_first: int) -> Column:
        a, b = F.regexp_extract(text, NAME_FIRST, in_name_first), F.regexp_extract(text, DAY_FIRST, in_day_first)
        return F.when(name_first, a).otherwise(b)

    name = F.lower(part(1, 2))
    starts = "".join(m[:3] for m in MONTHS)
    number = ((F.instr(F.lit(starts), F.substring(name, 1, 3)) + 2) / 3).cast("int").cast("string")
    return F.when(name.rlike(MONTH_NAME), _iso(part(3, 3), number, part(2, 1), text))


def as_date(c: Column | str) -> Column:
    """Date of a date, timestamp or ISO text; null where it is none of them."""
    return as_column(c).try_cast("timestamp_ntz").cast("date")


def duration_months(start: Column | str, end: Column | str) -> Column:
    """Whole months between two dates, at least 1; null if either date is missing."""
    start, end = as_column(start), as_column(end)
    months = (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))
    months = months - F.when(F.day(end) < F.day(start), 1).otherwise(0)
    # greatest() skips nulls, so the floor needs its own null test.
    return F.when(start.isNotNull() & end.isNotNull(), F.greatest(months, F.lit(1))).cast("bigint")


def duration_months_avg(start: Column | str, end: Column | str) -> Column:
    """Months between two dates counted in average-length months."""
    days = F.datediff(as_column(end), as_column(start))
    return F.round(days / F.lit(AVERAGE_MONTH_DAYS)).cast("bigint")
