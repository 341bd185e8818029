"""Calendar expressions and the date dimension."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskflow.functions import completed_years, full_name, is_weekend, parse_event_time
from riskflow.functions.measures import percentage
from riskflow.plans import star


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("born", "as_of", "years"),
    [
        ("2000-02-29", "2023-02-28", 22),
        ("2000-02-29", "2023-03-01", 23),
        ("2000-02-29", "2024-02-29", 24),
        ("1980-06-15", "2020-06-14", 39),
        ("1980-06-15", "2020-06-15", 40),
        (None, "2020-06-15", None),
    ],
)
def test_completed_years(spark, born, as_of, years):
    column = completed_years(F.lit(born).cast("date"), F.lit(as_of).cast("date"))
    assert value(spark, column) == years


@pytest.mark.parametrize("text", ["2001-13-45 99:00:00", "yesterday", "", None])
def test_bad_event_time_is_null(spark, text):
    assert value(spark, parse_event_time(F.lit(text).cast("string"))) is None


def test_event_time(spark):
    parsed = value(spark, parse_event_time(F.lit("2020-06-21 12:14:25")))
    assert parsed == dt.datetime(2020, 6, 21, 12, 14, 25)


def test_missing_time_is_no_weekend(spark):
    assert value(spark, is_weekend(F.lit(None).cast("timestamp"))) is False


@pytest.mark.parametrize(
    ("first", "last", "name"), [(" Ada", "Byron ", "Ada Byron"), ("Ada", None, None)]
)
def test_full_name(spark, first, last, name):
    columns = F.lit(first).cast("string"), F.lit(last).cast("string")
    assert value(spark, full_name(*columns)) == name


def test_original_calendar(spark):
    dates = star.dim_date(star.date_spine(spark, star.SPINE_START, star.SPINE_END))
    rows = {row.date_id: row for row in dates.collect()}
    assert len(rows) == 1096
    leap = rows[20200229]
    assert (leap.day_name, leap.month_name) == ("Saturday ", "February ")
    assert (leap.day_of_week, leap.quarter, leap.is_weekend) == (6, 1, True)
    assert rows[20190922].day_of_week == 0
    for key, row in rows.items():
        assert key == int(row.full_date.strftime("%Y%m%d"))
        assert len(row.day_name) == len(row.month_name) == 9


def test_spine_follows_the_data(spark):
    times = spark.sql("SELECT timestamp'2003-05-05' AS trans_at UNION SELECT '2004-01-02'")
    days = star.data_spine(times).agg(F.min("full_date"), F.max("full_date"), F.count("*"))
    assert tuple(days.first()) == (dt.date(2003, 1, 1), dt.date(2004, 12, 31), 731)


@pytest.mark.parametrize(
    ("part", "whole", "rate"), [(1, 3, 33.3333), (2, 3, 66.6667), (1, 16000, 0.0063), (0, 0, None)]
)
def test_percentage_rounds_half_up(spark, part, whole, rate):
    assert value(spark, percentage(F.lit(part), F.lit(whole))) == rate
