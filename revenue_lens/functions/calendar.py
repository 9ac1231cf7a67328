from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_end(day: Column) -> Column:
    """Monday that closes the week of ``day``; weeks run Tuesday to Monday."""
    return F.next_day(F.date_sub(F.to_date(day), 1), "MON")


def month_index(day: Column) -> Column:
    """Months since year 0, so that two indexes subtract to a whole month difference."""
    return F.year(day) * 12 + F.month(day) - 1


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier).cast("bigint")
