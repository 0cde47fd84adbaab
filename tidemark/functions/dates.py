"""Weeks and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed format of a week label.
WEEK_PATTERN = r"^\d{4}-W(0[1-9]|[1-4]\d|5[0-3])$"


def iso_week(day: Column) -> Column:
    """``YYYY-Www``: the year is that of the week's Thursday."""
    year = F.year(F.date_add(F.date_trunc("week", day).cast("date"), 3))
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def week_index(day: Column) -> Column:
    """Number of the Monday-based week since 1969-12-29, for differences between weeks."""
    return F.floor((F.datediff(day.cast("date"), F.lit("1970-01-01").cast("date")) + F.lit(3)) / F.lit(7)).cast("long")


def any_timestamp(text: Column) -> Column:
    """First reading that fits: ISO 8601 with Z, MM/DD/YYYY HH:MM:SS, seconds since 1970, a plain date."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.try_to_timestamp(text, F.lit("MM/dd/yyyy HH:mm:ss")),
        F.when(text.rlike(r"^\d{9,11}$"), F.timestamp_seconds(text.try_cast("long"))),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd")),
    )
