"""Literal order lines in the open-order contract, with defaults per column."""

import datetime as dt

D = dt.date
LINE_DDL = ("SalesOrderId bigint, PositionNumber int, PurchaseOrderId bigint, Material string, Customer bigint, "
            "SoldTo int, MarsDc int, FactPlanBillingDate date, OrderProcessingDate date, OrderCreationDate date, "
            "CsOrdered double, CsConfirmed double, CsPreSl double, SlicePallet double, CUT_QTY_PALLET double, "
            "AGREED_ORDEREDQTY_PALLET double, Allocation boolean, AllocationAvailable double, Discontinue string, "
            "MarsWeekFullName string")
DEFAULTS = dict(SalesOrderId=1, PositionNumber=1, PurchaseOrderId=1, Material="m1", Customer=7, SoldTo=70, MarsDc=0,
                FactPlanBillingDate=D(2001, 1, 10), OrderProcessingDate=D(2000, 12, 30),
                OrderCreationDate=D(2000, 12, 30), CsOrdered=10.0, CsConfirmed=5.0, CsPreSl=0.5, SlicePallet=0.5,
                CUT_QTY_PALLET=5.0, AGREED_ORDEREDQTY_PALLET=10.0, Allocation=None, AllocationAvailable=1.0,
                Discontinue="No", MarsWeekFullName="2001 P1 W2")
COLS = [c.split()[0] for c in LINE_DDL.split(", ")]


def make_lines(spark, *overrides):
    data = []
    for o in overrides:
        r = dict(DEFAULTS)
        r.update(o)
        data.append(tuple(r[c] for c in COLS))
    return spark.createDataFrame(data, LINE_DDL)
