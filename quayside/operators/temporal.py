"""Calendar and time operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import fiscal_week_key, period_year_key
from ..functions.exprs import as_of_date, exact_sum
from .joins import BROADCAST_BYTES, expand_days
from .latest import latest_per_key


def fiscal_labels(calendar: DataFrame, out_col: str = "MARS_WEEK_FOR_DEMAND") -> DataFrame:
    """Add the demand week key (``2022P06W4``) to the calendar."""
    return calendar.withColumn(out_col, fiscal_week_key())


def period_keys(calendar: DataFrame, as_of) -> DataFrame:
    """The calendar row of the run date with its two period keys."""
    return (calendar.where(F.col("OriginalDate") == as_of_date(as_of))
            .withColumn("CurrentPeriodYear", period_year_key(zeros=1))
            .withColumn("CurrentPeriodYearWithZeros", period_year_key(zeros=2)))


def period_start(calendar: DataFrame, as_of, period_col: str = "MarsPeriodFullName") -> DataFrame:
    """C4: one row, ``FirstDateCurrentPeriod`` = first date of the run date's period.

    The self join of the original is a semi join: only the period label of
    the run date is needed.  NULL when the calendar lacks the run date.
    """
    current = calendar.where(F.col("OriginalDate") == as_of_date(as_of)).select(period_col)
    return (calendar.join(current, period_col, "left_semi")
            .agg(F.min("OriginalDate").alias("FirstDateCurrentPeriod")))


def valid_at(df: DataFrame, as_of, start: str, end: str) -> DataFrame:
    """rows whose half-open interval ``[start, end)`` contains the run date."""
    d = as_of_date(as_of)
    return df.where((F.col(start) <= d) & (d < F.col(end)))


STOCK_KEYS = ["WAREHOUSE", "MATERIAL_CODE"]


def latest_stock(stock: DataFrame, as_of=None) -> DataFrame:
    """Latest stock row per (warehouse, material) (L1b); with ``as_of``, of the rows up to that day.

    Ties on the day are broken by the remaining columns, so equal rows are
    the only ones that can swap.
    """
    if as_of is not None:
        stock = stock.where(F.col("DAY") <= as_of_date(as_of))
    return latest_per_key(stock, STOCK_KEYS, [F.col("DAY").desc()],
                          tie_break=[F.col("FREE_STOCK").desc(), F.col("TMS").desc()])


#: a calendar of up to 100 years makes a horizon table of under 20 MB
CALENDAR_DAYS = 36_600
WEEK_ROW_BYTES = 48  # date, week key and number, with the row around them


def project_demand(stock: DataFrame, forecast: DataFrame, calendar: DataFrame, horizon: int = 56,
                   divisor: int = 56, days_per_week: int = 7, pairs: DataFrame | None = None,
                   calendar_days: int | None = CALENDAR_DAYS) -> DataFrame:
    """Average daily demand over the horizon for each latest stock row.

    ``stock`` holds the stock snapshots; the latest one per (warehouse,
    material) is taken here (``latest_stock``).  With ``pairs`` (WAREHOUSE, MATERIAL_CODE)
    only the stock and forecast of those are read on (semi joins before any other work).

    For every stock row and every calendar day in ``[DAY, DAY + horizon]``
    (inclusive: ``horizon + 1`` days) the weekly forecast of that day's
    fiscal week, of every forecast version valid on the stock day
    (``F_STARTDATE <= DAY < F_ENDDATE``), contributes ``cases / 7``; days
    without a forecast contribute 0; the total is divided by ``divisor``.
    Days the calendar lacks contribute nothing (inner calendar join).

    Plan: which weeks a horizon covers, and with how many days, depends only
    on its first day, so ``horizon_weeks`` tabulates it for every day whose
    horizon meets the calendar — from the calendar alone, about 9 rows per
    calendar day, never from the stock.  Its size follows from the number of days that the
    calendar spans: up to ``calendar_days`` (which the plan itself checks, without a job
    of its own) it is broadcast; for longer calendars pass None, and the planner shuffles both sides.
    It is joined to the stock rows on the day: each stock row meets ~9
    week rows instead of 57 day rows, and a stock day whose horizon misses
    the calendar finds no row, as with the original inner calendar join.  The
    forecast is summed per version (partial sums first) and joined on (plant,
    material, week) with the validity interval as a residual condition.
    """
    stock_cols = ["WAREHOUSE", "MATERIAL_CODE", "DAY", "TMS", "FREE_STOCK"]
    cal = fiscal_labels(calendar).select("OriginalDate", "MARS_WEEK_FOR_DEMAND")
    if pairs is not None:
        stock = stock.join(pairs, STOCK_KEYS, "left_semi")
        forecast = forecast.join(pairs.withColumnRenamed("WAREHOUSE", "PLANT"), ["PLANT", "MATERIAL_CODE"], "left_semi")
    table = horizon_weeks(cal, horizon, calendar_days)
    if calendar_days is not None and (calendar_days + horizon) * (horizon // days_per_week + 2) * WEEK_ROW_BYTES <= BROADCAST_BYTES:
        table = F.broadcast(table)
    weeks = latest_stock(stock).select(*stock_cols).join(table, "DAY")
    # Versions are summed before they are shuffled (exactly: the total is tested
    # against a threshold), then meet the stock on the join keys.
    fc = (forecast.withColumnRenamed("MATERIAL_CODE", "__mat")
          .groupBy("PLANT", "__mat", "MARS_WEEK", "F_STARTDATE", "F_ENDDATE")
          .agg(exact_sum(F.col("FORECAST_CASES")).alias("__cases")))
    cond = ((weeks["WAREHOUSE"] == fc["PLANT"]) & (weeks["MATERIAL_CODE"] == fc["__mat"])
            & (weeks["MARS_WEEK_FOR_DEMAND"] == fc["MARS_WEEK"])
            & weeks["DAY"].between(fc["F_STARTDATE"], F.date_add(fc["F_ENDDATE"], -1)))
    joined = weeks.join(fc, cond, "left")
    cases = exact_sum(F.col("__days") * F.col("__cases"))
    total = joined.groupBy(*stock_cols).agg(F.coalesce(cases / days_per_week, F.lit(0.0)).alias("DEMAND_TOTAL"))
    return total.withColumn("FORECAST_CASES_8_WEEK_BY_PER_DAY", F.col("DEMAND_TOTAL") / divisor)


def horizon_weeks(cal: DataFrame, horizon: int, calendar_days: int | None = None) -> DataFrame:
    """(DAY, week, number of horizon days in that week) for every day whose
    ``[DAY, DAY + horizon]`` meets the calendar; ``cal`` = (OriginalDate, MARS_WEEK_FOR_DEMAND).

    Fails when the calendar spans more than ``calendar_days``, if given.
    """
    start, end = F.min("OriginalDate"), F.max("OriginalDate")
    if calendar_days is not None:
        long_ = F.raise_error(F.lit(f"the calendar spans over {calendar_days} days: pass a larger calendar_days, or None")).cast("date")
        end = F.when(F.date_diff(end, start) < calendar_days, end).when(start.isNotNull(), long_)
    span = cal.agg(F.date_add(start, -horizon).alias("__s"), end.alias("__e"))
    days = span.select(F.explode(F.sequence("__s", "__e")).alias("DAY"))
    return (expand_days(days, "DAY", horizon).join(cal, "OriginalDate")
            .groupBy("DAY", "MARS_WEEK_FOR_DEMAND").agg(F.count(F.lit(1)).alias("__days")))


def validity_interval(df: DataFrame, keys: Sequence[str], date_col: str, tie_break: Sequence[str],
                      first: str = "2000-01-01", last: str = "9999-12-31", start_col: str = "StartDate",
                      end_col: str = "EndDate") -> DataFrame:
    """``[start, end]`` per version from the version dates of each key.

    Versions of a key are ordered by ``date_col`` (NULL first) then
    ``tie_break``, which must make the order total within a date.
    start = the version's date, or ``first`` if no version with a date precedes it;
    end = the next version's date - 1 day, or ``last`` if there is none or it has no date.
    ``date_col`` must be a DATE (Q13).  With equal dates the next version
    starts on the same day, giving ``end < start`` — kept, as in the original.

    No window runs over a key's versions (one key can hold a large share of
    all rows): the versions are first reduced to one row per (key, date) with
    the first and last tie-break values (partial aggregation), the previous and
    next *dates* come from a window over that table — bounded by the number of
    distinct dates of a key — and the result is joined back on (key, date).
    A version's neighbour has the version's own date unless the version is the
    first or last of its date.
    """
    if not tie_break:
        raise ValueError("tie_break must name the columns that order versions of one date")
    tb = F.struct(*[F.col(t) for t in tie_break])
    days = (df.groupBy(*keys, date_col)
            .agg(F.min(tb).alias("__tb_first"), F.max(tb).alias("__tb_last")))
    w = Window.partitionBy(*keys).orderBy(date_col)
    days = (days.withColumn("__prev", F.lag(date_col, 1).over(w))
                .withColumn("__next", F.lead(date_col, 1).over(w)))
    j = df.join(days.withColumnsRenamed({k: f"__k_{k}" for k in [*keys, date_col]}).alias("__d"),
                [df[k].eqNullSafe(F.col(f"__d.__k_{k}")) for k in [*keys, date_col]], "inner")
    own = F.col(date_col)
    before = F.when(tb.eqNullSafe(F.col("__tb_first")), F.col("__prev")).otherwise(own)
    after = F.when(tb.eqNullSafe(F.col("__tb_last")), F.col("__next")).otherwise(own)
    out = (j.withColumn(start_col, F.when(before.isNull(), F.lit(first)).otherwise(own).cast("date"))
            .withColumn(end_col, F.when(after.isNull(), F.lit(last)).otherwise(F.date_add(after, -1)).cast("date")))
    return out.select(*df.columns, start_col, end_col)
