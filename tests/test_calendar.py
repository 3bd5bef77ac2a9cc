import datetime as dt

from pyspark.sql import functions as F

from quayside.functions.calendar import fiscal_week_key, generate_calendar
from quayside.operators import period_keys, period_start
from tests.conftest import rows


def test_week_key_pads_one_digit_period(spark):
    df = spark.createDataFrame([(2022, "P6", "W4"), (2022, "P12", "W1")], "MarsYear int, MarsPeriodName string, "
                                                                          "MarsWeekName string")
    assert rows(df.select(fiscal_week_key().alias("k")), "k") == [("2022P06W4",), ("2022P12W1",)]


def test_generated_calendar_rule(spark):
    span = spark.createDataFrame([(dt.date(2000, 1, 1), dt.date(2000, 12, 31))], "start date, end date")
    cal = generate_calendar(span)
    assert cal.count() == 366
    r = {x["OriginalDate"]: x for x in cal.collect()}
    assert (r[dt.date(2000, 1, 1)]["MarsPeriod"], r[dt.date(2000, 1, 1)]["MarsWeekName"]) == (1, "W1")
    assert (r[dt.date(2000, 1, 29)]["MarsPeriod"], r[dt.date(2000, 1, 29)]["MarsWeekName"]) == (2, "W1")
    assert (r[dt.date(2000, 12, 31)]["MarsPeriod"], r[dt.date(2000, 12, 31)]["MarsWeekName"]) == (13, "W5")


def test_period_keys_and_start(spark):
    span = spark.createDataFrame([(dt.date(2000, 1, 1), dt.date(2000, 12, 31))], "start date, end date")
    cal = generate_calendar(span)
    k = period_keys(cal, "2000-03-01").collect()[0]   # day 61 -> period 3
    assert (k["CurrentPeriodYear"], k["CurrentPeriodYearWithZeros"]) == ("200003", "2000003")
    k = period_keys(cal, "2000-12-01").collect()[0]   # period 12
    assert (k["CurrentPeriodYear"], k["CurrentPeriodYearWithZeros"]) == ("200012", "2000012")
    assert period_start(cal, "2000-03-01").collect()[0][0] == dt.date(2000, 2, 26)
    assert period_start(cal, "1999-01-01").collect()[0][0] is None
