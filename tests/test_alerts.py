"""Restock as-of (C14/C15), quota (C16), later order (C17), discontinued (C18), merge (C19), output (C20)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quayside.operators import (OUTPUT_CONTRACT, discontinued_alert, merge_decisions, next_event_after,
                                quota_exceeded, quota_in_later_order, restock_asof, typed_output)
from tests.conftest import rows
from tests.lines_fixture import D, make_lines

AS_OF = "2000-12-31"
ARR_DDL = ("Delivery_ActualGI__DTTM date, GRD string, Delivery_LocationFrom__FK int, Delivery_LocationTo__FK int, "
           "TransitDate date")


def arrivals(spark, *pairs):
    return spark.createDataFrame([(None, m, 9, dc, d) for m, dc, d in pairs], ARR_DDL)


def test_restock_strictly_after_planned_and_fallback(spark):
    lines = make_lines(
        spark,
        dict(SalesOrderId=1, PositionNumber=1, Material="a", FactPlanBillingDate=D(2001, 1, 10)),
        dict(SalesOrderId=2, PositionNumber=1, Material="b", FactPlanBillingDate=D(2001, 1, 10)),
        dict(SalesOrderId=3, PositionNumber=1, Material="a", Discontinue="Yes"),       # not a candidate
    )
    arr = arrivals(spark, ("a", 0, D(2001, 1, 10)), ("a", 0, D(2001, 1, 12)), ("a", 0, D(2001, 1, 11)),
                   ("a", 1, D(2001, 1, 11)), ("b", 0, D(2001, 1, 1)))
    out = {r["SalesOrderId"]: r["Alert"] for r in restock_asof(lines, arr, AS_OF, found=("on ", "!"),
                                                                not_found="none").collect()}
    assert out == {1: "on 2001-01-11!", 2: "none"}


def test_restock_repeated_position_prefers_unmatched(spark):
    lines = make_lines(spark,
                       dict(SalesOrderId=1, PositionNumber=1, Material="a"),
                       dict(SalesOrderId=1, PositionNumber=1, Material="z"))
    arr = arrivals(spark, ("a", 0, D(2001, 2, 1)))
    out = restock_asof(lines, arr, AS_OF, not_found="none").collect()
    assert [(r["Material"], r["Alert"]) for r in out] == [("z", "none")]


def test_next_event_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.date(2001, 1, 1)
    left = [(rnd.choice("xy"), rnd.randint(0, 2), base + dt.timedelta(rnd.randint(0, 30))) for _ in range(120)]
    right = [(rnd.choice("xy"), rnd.randint(0, 2), base + dt.timedelta(rnd.randint(0, 30))) for _ in range(60)]
    ldf = spark.createDataFrame(left, "m string, w int, d date")
    rdf = spark.createDataFrame(right, "g string, t int, e date")
    for strict in (True, False):
        got = sorted(tuple(r) for r in next_event_after(ldf, rdf, ["m", "w"], ["g", "t"], "d", "e", "nx", strict)
                     .select("m", "w", "d", "nx").collect())
        exp = sorted((m, w, d, min((e for g, t, e in right if g == m and t == w and (e > d if strict else e >= d)),
                                   default=None)) for m, w, d in left)
        assert got == exp


def test_quota_valid_half_open_and_positive(spark):
    q = spark.createDataFrame([
        ("m", 1, D(2000, 12, 31), D(2001, 2, 1), 5, "s"),    # starts on the run date: valid
        ("m", 2, D(2000, 1, 1), D(2000, 12, 31), 5, "s"),    # ends on the run date: not valid
        ("m", 3, D(2000, 1, 1), D(2001, 1, 1), 0, "s"),      # nothing left
        ("m", 4, D(2000, 1, 1), D(2001, 1, 1), 3, None),     # NULL summary: text is NULL
    ], "Material string, Customer bigint, ForecastVersionStartDate date, ForecastVersionEndDate date, "
       "RemainingUnconfirmedQuota bigint, Summary string")
    out = quota_exceeded(q, AS_OF, parts=("over ", " cs;", "top:", "."))
    assert rows(out, "Alert4_Customer", "Alert") == [(1, "over 5 cs;top:s."), (4, None)]


def test_later_order_gap_and_other_order(spark):
    base = dict(Material="m", SoldTo=5, OrderCreationDate=D(2000, 12, 1))
    lines = make_lines(
        spark,
        dict(base, SalesOrderId=1, Allocation=True, CsConfirmed=0.0, OrderProcessingDate=D(2000, 12, 29),
             FactPlanBillingDate=D(2001, 1, 10)),
        dict(base, SalesOrderId=2, CsConfirmed=3.7, FactPlanBillingDate=D(2001, 1, 11)),   # 1 day later: excluded
        dict(base, SalesOrderId=3, CsConfirmed=4.2, FactPlanBillingDate=D(2001, 1, 12)),   # 2 days later: kept
        dict(base, SalesOrderId=4, CsConfirmed=2.0, FactPlanBillingDate=D(2001, 1, 20)),   # kept
        dict(base, SalesOrderId=5, CsConfirmed=2.0, FactPlanBillingDate=D(2001, 1, 20),
             OrderCreationDate=D(2000, 12, 2)),                                                # created later: excluded
        dict(base, SalesOrderId=1, PositionNumber=2, CsConfirmed=9.0, FactPlanBillingDate=D(2001, 1, 5)),  # same order
    )
    out = quota_in_later_order(lines, AS_OF, header="H", separator="|", item=("", "(", ")"), trailer="T").collect()
    assert [(r["A_SalesOrderId"], r["Alert"]) for r in out] == [(1, "H|3(4)|4(2)|T")]


def test_discontinued_and_merge(spark):
    lines = make_lines(
        spark,
        dict(SalesOrderId=1, Material="p", Discontinue="Yes", Allocation=True, AllocationAvailable=0.0),
        dict(SalesOrderId=2, Material="q", Allocation=True, AllocationAvailable=3.0),
        dict(SalesOrderId=3, Material="r"),
    ).withColumn("FlagPriceDisagreement", F.when(F.col("SalesOrderId") == 1, F.lit(1)))\
     .withColumn("AlertPriceDisagreement", F.when(F.col("SalesOrderId") == 1, F.lit("P;")))
    src = [c for c in lines.columns if c not in ("FlagPriceDisagreement", "AlertPriceDisagreement")]
    stock = spark.createDataFrame([(1, "p", D(2001, 1, 10), 1, 0, "S;", 5)], "SalesOrderId bigint, Material string, "
                                  "FactPlanBillingDate date, PositionNumber int, MarsDc int, Alert string, AlertPriority int")
    later = spark.createDataFrame([(1, "p", 70, "L;", 3)], "A_SalesOrderId bigint, A_Material string, A_SoldTo int, "
                                  "Alert string, AlertPriority int")
    quota = spark.createDataFrame([("p", 7, "Q;", 4), ("q", 7, "Q2;", 4)], "Alert4_Material string, "
                                  "Alert4_Customer bigint, Alert string, AlertPriority int")
    mats = spark.createDataFrame([("p", "BrandP")], "MATERIAL string, Brand string")
    out = merge_decisions(discontinued_alert(lines, text="D;"), stock, later, quota, mats, source_columns=src)
    got = {r["SalesOrderId"]: (r["Decision"], r["DecisionDescription"], r["FlagPriceDisagreement"], r["Brand"])
           for r in out.collect()}
    # line 2 is allocated but has stock available: the guarded quota join leaves it without quota
    assert got == {1: (1, "P;D;L;Q;S;", 1, "BrandP"), 2: (0, "", 0, None), 3: (0, "", 0, None)}
    typed = typed_output(out.withColumn("Technology", F.lit(None).cast("string")).select(
        "*", *[F.lit(None).cast(t).alias(n) for n, t, _ in OUTPUT_CONTRACT
               if n not in out.columns and n not in ("Promo", "Subbrand", "Technology", "SiKg", "SiRur", "SiPcs",
                                                     "SiCase")]))
    assert [f.name for f in typed.schema.fields] == [n for n, _, _ in OUTPUT_CONTRACT]
    assert len(typed.columns) == 60
    r1 = typed.where("SalesOrderId = '1'").collect()[0]
    assert (r1["Promo"], r1["FlagPriceDisagreement"], r1["Subbrand"], r1["MarsDc"]) == (False, True, "BrandP", "0")
