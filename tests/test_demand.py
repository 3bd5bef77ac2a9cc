"""C10 demand projection: horizon bounds, validity interval, brute force, donor cover."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quayside.functions.calendar import fiscal_labels_of, fiscal_week_key, generate_calendar
from quayside.operators import donor_cover, expand_donors, project_demand
from tests.conftest import rows
from tests.lines_fixture import D, make_lines

STOCK_DDL = "WAREHOUSE int, MATERIAL_CODE string, DAY date, TMS double, FREE_STOCK double"
FC_DDL = ("PLANT int, MATERIAL_CODE string, MARS_WEEK string, F_STARTDATE date, F_ENDDATE date, "
          "FORECAST_CASES double")


def calendar(spark, start=D(2000, 1, 1), end=D(2002, 12, 31)):
    return generate_calendar(spark.createDataFrame([(start, end)], "start date, end date"))


def week_of(spark, d):
    lab = fiscal_labels_of(F.lit(d))
    return spark.range(1).select(fiscal_week_key(lab["MarsYear"], lab["MarsPeriodName"], lab["MarsWeekName"])
                                 ).collect()[0][0]


def test_horizon_is_inclusive_57_days(spark):
    day = D(2000, 6, 1)
    stock = spark.createDataFrame([(0, "m", day, 1.0, 10.0)], STOCK_DDL)
    # one forecast per week touched, 7 cases each => 1 case per covered day
    weeks = sorted({week_of(spark, day + dt.timedelta(k)) for k in range(0, 60)})
    fc = spark.createDataFrame([(0, "m", w, D(2000, 1, 1), D(2001, 1, 1), 7.0) for w in weeks], FC_DDL)
    out = project_demand(stock, fc, calendar(spark)).collect()[0]
    assert out["DEMAND_TOTAL"] == 57.0          # days 0..56
    assert abs(out["FORECAST_CASES_8_WEEK_BY_PER_DAY"] - 57 / 56) < 1e-12


def test_forecast_validity_half_open_on_stock_day(spark):
    day = D(2000, 6, 1)
    stock = spark.createDataFrame([(0, "m", day, 1.0, 10.0)], STOCK_DDL)
    w = week_of(spark, day)
    fc = spark.createDataFrame([(0, "m", w, day, D(2000, 7, 1), 7.0),     # starts on the stock day: valid
                                (0, "m", w, D(2000, 5, 1), day, 70.0)],   # ends on the stock day: not valid
                               FC_DDL)
    out = project_demand(stock, fc, calendar(spark)).collect()[0]
    days_in_week = sum(1 for k in range(57) if week_of(spark, day + dt.timedelta(k)) == w)
    assert out["DEMAND_TOTAL"] == days_in_week * 1.0


def test_latest_stock_only_and_missing_forecast_is_zero(spark):
    stock = spark.createDataFrame([(0, "m", D(2000, 6, 1), 1.0, 10.0), (0, "m", D(2000, 5, 1), 1.0, 99.0),
                                   (1, "m", D(2000, 6, 1), 1.0, 5.0)], STOCK_DDL)
    fc = spark.createDataFrame([], FC_DDL)
    assert rows(project_demand(stock, fc, calendar(spark)), "WAREHOUSE", "FREE_STOCK", "DEMAND_TOTAL") == [
        (0, 10.0, 0.0), (1, 5.0, 0.0)]


def test_matches_per_day_brute_force(spark):
    rnd = random.Random(3)
    base = D(2000, 3, 1)
    stock = [(rnd.randint(0, 1), rnd.choice("ab"), base + dt.timedelta(rnd.randint(0, 40)), 2.0, 50.0)
             for _ in range(30)]
    cal = {base + dt.timedelta(k): week_of(spark, base + dt.timedelta(k)) for k in range(0, 120)}
    fc = []
    for _ in range(80):
        d = base + dt.timedelta(rnd.randint(0, 100))
        s = d - dt.timedelta(rnd.randint(0, 60))
        fc.append((rnd.randint(0, 1), rnd.choice("ab"), cal[d], s, s + dt.timedelta(rnd.randint(1, 60)),
                   float(rnd.randint(1, 30))))
    sdf = spark.createDataFrame(stock, STOCK_DDL)
    got = {(r[0], r[1]): (r[2], round(r[3], 9)) for r in project_demand(
        sdf, spark.createDataFrame(fc, FC_DDL), calendar(spark, base, base + dt.timedelta(200))).select(
        "WAREHOUSE", "MATERIAL_CODE", "DAY", "DEMAND_TOTAL").collect()}
    latest = {}
    for w, m, d, tms, fs in stock:
        if (w, m) not in latest or d > latest[(w, m)]:
            latest[(w, m)] = d
    exp = {}
    for (w, m), d in latest.items():
        tot = 0.0
        for k in range(57):
            od = d + dt.timedelta(k)
            tot += sum(c / 7 for p, mm, wk, s, e, c in fc if p == w and mm == m and wk == cal.get(od) and s <= d < e)
        exp[(w, m)] = (d, round(tot, 9))
    assert got == exp


def test_donor_cover_threshold_and_zero_demand(spark):
    targets = make_lines(spark, dict(SalesOrderId=1, Material="m", MarsDc=0, CsOrdered=10.0),
                         dict(SalesOrderId=2, Material="z", MarsDc=3)).select(
        "SalesOrderId", "Material", "MarsDc", "CsOrdered", "CsConfirmed")
    pairs = spark.createDataFrame([(0, 1), (0, 2)], "SourcePlant int, DonorPlant int")
    demand = spark.createDataFrame([(1, "m", 2.0, 20.0, 10.0), (2, "m", 2.0, 20.0, 0.0)],
                                   "WAREHOUSE int, MATERIAL_CODE string, TMS double, FREE_STOCK double, "
                                   "FORECAST_CASES_8_WEEK_BY_PER_DAY double")
    out = donor_cover(expand_donors(targets, pairs), demand, coefficient=0.5)
    # donor 1: (20-10)/10 = 1 day, /2 = 0.5 >= 0.5 -> 1; donor 2: zero demand -> NULL -> 0; order 2: no donor
    assert rows(out, "SalesOrderId", "DonorPlant", "AlertForGRD") == [(1, 1, 1), (1, 2, 0), (2, None, 0)]
