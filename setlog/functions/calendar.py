"""Calendar attributes of a date."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from setlog.functions.fixed import MONTHS, WEEKDAYS_FROM_SUNDAY


def weekday(date: Column) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(date) - 1


def weekday_name(date: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS_FROM_SUNDAY)), F.dayofweek(date))


def month_label(year: Column, month: Column) -> Column:
    return F.concat_ws(" ", F.element_at(F.array(*map(F.lit, MONTHS)), month), year.cast("string"))


def year_week(year: Column, week: Column) -> Column:
    """'2024-S07'. The year is the calendar year, so 2024-12-30 (ISO week 1) is '2024-S01'."""
    return F.concat(year.cast("string"), F.lit("-S"), F.lpad(week.cast("string"), 2, "0"))


def year_month(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
