"""Fiscal calendar expressions (C2, C3) and a rule-based calendar generator.

The jobs read a fiscal calendar dimension (one row per date with year,
period and week labels).  ``fiscal_week_key`` builds the demand week key
``<year>P<nn>W<n>`` from those labels, zero-padding one-digit period names.

``generate_calendar`` builds such a dimension from a date span by a fixed
rule (13 periods of 28 days, the last one absorbing the remaining days;
weeks of 7 days inside a period).  It is used where no calendar table is
given, e.g. for the test tables, and covers any span in a few thousand
rows per decade.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exprs import ColumnOrName, c

CALENDAR_COLUMNS = ["OriginalDate", "MarsYear", "MarsPeriod", "MarsPeriodName",
                    "MarsPeriodFullName", "MarsWeekName", "MarsWeekFullName"]


def fiscal_week_key(year: ColumnOrName = "MarsYear", period_name: ColumnOrName = "MarsPeriodName",
                    week_name: ColumnOrName = "MarsWeekName") -> Column:
    """``2022``, ``P6``, ``W4`` -> ``2022P06W4``; ``P12`` stays ``P12``."""
    pn = c(period_name)
    padded = F.when(F.length(pn) == 2, F.concat(F.lit("P0"), F.substring(pn, 2, 1))).otherwise(pn)
    return F.concat(c(year), padded, c(week_name))


def period_year_key(year: ColumnOrName = "MarsYear", period: ColumnOrName = "MarsPeriod",
                    zeros: int = 1) -> Column:
    """``year || 0?period`` (``zeros=1``) or ``year || 0 || 0?period`` (``zeros=2``)."""
    small = F.concat(c(year), F.lit("0" * zeros), c(period))
    large = F.concat(c(year), F.lit("0" * (zeros - 1)), c(period))
    return F.when(c(period) < 10, small).otherwise(large)


def fiscal_labels_of(date_col: ColumnOrName) -> dict[str, Column]:
    """Label columns of the rule-based calendar for a DATE column."""
    d = c(date_col)
    doy0 = F.dayofyear(d) - 1
    period = F.least(F.floor(doy0 / 28) + 1, F.lit(13)).cast("int")
    week = (F.floor((doy0 - (period - 1) * 28) / 7) + 1).cast("int")
    year = F.year(d)
    return {
        "MarsYear": year,
        "MarsPeriod": period,
        "MarsPeriodName": F.concat(F.lit("P"), period),
        "MarsPeriodFullName": F.concat(year, F.lit(" P"), period),
        "MarsWeekName": F.concat(F.lit("W"), week),
        "MarsWeekFullName": F.concat(year, F.lit(" P"), period, F.lit(" W"), week),
    }


def generate_calendar(span: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per date between ``start`` and ``end`` (inclusive) of each span row.

    ``span`` is normally a one-row aggregate (min/max date of the data); the
    result size is bounded by the number of days covered, not by data volume.
    """
    days = span.select(F.explode(F.sequence(F.col(start_col), F.col(end_col))).alias("OriginalDate")).distinct()
    return days.withColumns(fiscal_labels_of("OriginalDate")).select(*CALENDAR_COLUMNS)
