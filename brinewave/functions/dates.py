"""Calendar functions of the field season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinewave.functions.nulls import as_col

# The 2017 survey weeks (week, first day, last day). Week 4 ends a month late on
# purpose: the published table has it so, and later weeks override it.
SURVEY_WEEKS_2017 = [
    (1, "2017-05-03", "2017-05-08"),
    (2, "2017-05-09", "2017-05-15"),
    (3, "2017-05-16", "2017-05-22"),
    (4, "2017-05-23", "2017-06-29"),
    (5, "2017-05-30", "2017-06-05"),
    (6, "2017-06-06", "2017-06-12"),
    (7, "2017-06-13", "2017-06-19"),
    (8, "2017-06-20", "2017-06-26"),
    (9, "2017-06-27", "2017-07-03"),
    (10, "2017-07-04", "2017-07-10"),
    (11, "2017-07-11", "2017-07-18"),
]


def yday(c: Column | str) -> Column:
    return F.dayofyear(as_col(c))


def week_of_year(c: Column | str) -> Column:
    """Complete seven-day periods since 1 January, plus one (not the ISO week)."""
    return F.floor((F.dayofyear(as_col(c)) - 1) / F.lit(7)).cast("int") + 1


def iso_week(c: Column | str) -> Column:
    return F.weekofyear(as_col(c))


def sampling_week(c: Column | str) -> Column:
    """Number of the sampling week: (day of year + 4) div 7."""
    return F.floor((F.dayofyear(as_col(c)) + 4) / F.lit(7)).cast("int")


def survey_week(c: Column | str, weeks=None) -> Column:
    """Week of a table of date ranges; where ranges overlap the last one listed wins."""
    c = as_col(c)
    chosen = None
    for week, first, last in reversed(weeks or SURVEY_WEEKS_2017):
        inside = c.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        chosen = F.when(inside, week) if chosen is None else chosen.when(inside, week)
    return chosen


def in_year(c: Column | str, year: int) -> Column:
    """Same month and day in another year; null for 29 February in a common year."""
    c = as_col(c)
    text = F.concat_ws("-", F.lit(year).cast("string"), F.month(c).cast("string"), F.dayofmonth(c).cast("string"))
    return F.when(c.isNotNull(), text.try_cast("date"))


def between_open(c: Column | str, first: str, last: str) -> Column:
    """Strictly between two dates."""
    c = as_col(c)
    return (c > F.lit(first).cast("date")) & (c < F.lit(last).cast("date"))


def in_season(c: Column | str, year: int) -> Column:
    """Within a calendar year, as a half-open range that the scan can use."""
    c = as_col(c)
    return (c >= F.lit(f"{year}-01-01").cast("date")) & (c < F.lit(f"{year + 1}-01-01").cast("date"))


def seasons_observed(df: DataFrame, date: str, first_season: int = 2015) -> DataFrame:
    """One row: seasons from the first one to the latest date."""
    return df.agg((F.max(F.year(date)) - first_season + 1).alias("n_seasons"))
