"""Calendar expressions. Every one of them reads the session zone, which riskflow pins to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LABEL_WIDTH = 9  # day and month names are blank-padded to the longest name


def parse_event_time(text: Column) -> Column:
    """Event text to timestamp; unparsable text gives NULL instead of an ANSI error."""
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT))


def hour_of_day(at: Column) -> Column:
    return F.hour(at)


def day_of_week(at: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(at) - 1


def is_weekend(at: Column) -> Column:
    """A missing date is not a weekend."""
    return F.coalesce(F.dayofweek(at).isin(1, 7), F.lit(False))


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def padded_day_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "EEEE"), LABEL_WIDTH, " ")


def padded_month_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "MMMM"), LABEL_WIDTH, " ")


def completed_years(born: Column, as_of: Column) -> Column:
    """Birthdays passed by ``as_of``; 29 February births turn a year older on 1 March."""

    def month_and_day(day: Column) -> Column:
        return F.month(day) * 100 + F.dayofmonth(day)

    not_yet = (month_and_day(as_of) < month_and_day(born)).cast("int")
    return F.year(as_of) - F.year(born) - not_yet
