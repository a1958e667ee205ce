"""Date expressions: several layouts, first match wins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqspark.fixed import DATE_LAYOUTS
from dqspark.functions.text import strip

#: Tried after the known layouts, in this order.
FALLBACK_LAYOUTS = (
    "yyyyMMdd", "M/d/yyyy", "M-d-yyyy",
    "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy",
)
TIME_LAYOUTS = (
    "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d H:m:s.SSSSSS", "yyyy-M-d'T'H:m:s.SSSSSS",
    "yyyy-M-d H:m", "yyyy-M-d'T'H:m",
)
#: Days a 64-bit nanosecond timestamp can hold; others count as unreadable.
FIRST_DAY, LAST_DAY = "1677-09-22", "2262-04-11"


def _shape(layout: str) -> str:
    """Regular expression of what a layout can read.

    Tested first: a failed parse costs an exception, and mixed layouts would
    raise several of them per row.
    """
    fields = {"yyyy": r"\d{4}", "MM": r"\d{2}", "dd": r"\d{2}", "MMM": r"\p{L}+", "MMMM": r"\p{L}+", "SSSSSS": r"\d{6}"}

    def part(match: re.Match) -> str:
        quoted, field, _, other = match.groups()
        return fields.get(field, r"\d{1,2}") if field else re.escape(quoted or other)

    return "^" + re.sub(r"'([^']*)'|(([A-Za-z])\3*)|([^A-Za-z'])", part, layout) + "$"


def _day(text: Column, layout: str) -> Column:
    return F.when(text.rlike(_shape(layout)), _in_range(F.try_to_date(text, layout)))


def _in_range(day: Column) -> Column:
    return F.when(day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), day)


def parse_timestamp(c: Column) -> Column:
    """Text as a timestamp without zone; unreadable text is missing."""
    text = strip(c)
    days = [_day(text, layout).cast("timestamp_ntz") for layout in DATE_LAYOUTS + FALLBACK_LAYOUTS]
    times = [
        F.when(_day(text, layout).isNotNull(), F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz"))
        for layout in TIME_LAYOUTS
    ]
    return F.coalesce(*days, *times)


def parse_date(c: Column) -> Column:
    """Text as a date; a time of day, if written, is dropped."""
    text = strip(c)
    return F.coalesce(*[_day(text, layout) for layout in DATE_LAYOUTS + FALLBACK_LAYOUTS + TIME_LAYOUTS])


def weekday_name(c: Column) -> Column:
    """Full English name of the day."""
    return F.date_format(c, "EEEE")


def month_start(c: Column) -> Column:
    return F.date_trunc("month", c).cast("date")
