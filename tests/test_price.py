from quayside.operators import attach_flag, price_disagreement, prepare_materials
from quayside.functions.units import technology_rules
from tests.conftest import rows
from tests.lines_fixture import make_lines

ITEM_DDL = ("VBELN bigint, POSNR int, MATNR string, VKORG int, SPART int, BSTNK bigint, KWMENG double, "
            "UMVKZ double, UMVKN double, KZWI3 double, NETPR double")
SOH_DDL = "SALESORDERID bigint, POSITION_NUMBER int, REJECTIONREASON_TYPE string, SALESORDERTYPE string, GISTATUS boolean"
MAT_DDL = ("MATERIAL string, MATNR string, START_DATE date, VMSTD date, `0CREATEDON` date, UOM_PC2Case string, "
           "Brand string, Technology string")


def mats(spark, *rows_):
    return prepare_materials(spark.createDataFrame(list(rows_), MAT_DDL), technology_rules())


def item(vbeln, posnr, matnr, po, qty, amount, price, num=1.0, den=1.0, org=100, div=2):
    return (vbeln, posnr, matnr, org, div, po, qty, num, den, amount, price)


def test_tolerance_edge_and_zero_divisors(spark):
    items = spark.createDataFrame([
        item(1, 1, "0000000001", 100, 10.0, 100.2, 10.0),     # expected 10.02, diff 0.02: not flagged
        item(2, 1, "0000000002", 100, 10.0, 100.201, 10.0),   # diff 0.0201: flagged
        item(3, 1, "0000000003", 100, 10.0, 500.0, 10.0, den=0.0),  # zero denominator -> NULL -> not flagged
        item(4, 1, "000", 100, 10.0, 500.0, 10.0),            # all-zero code -> ''
        item(5, 1, "0000000005", 100, 10.0, 500.0, 10.0, org=1),   # other org
    ], ITEM_DDL)
    soh = spark.createDataFrame([(i, 1, None, "ZOR", False) for i in range(1, 6)], SOH_DDL)
    m = mats(spark)
    out = price_disagreement(items, soh, m, org=100, division=2)
    assert rows(out, "MATERIAL_CODE", "PurchaseOrderId", "FlagPriceDisagreement") == [("", 100, 1), ("2", 100, 1)]


def test_open_sales_order_filter_keeps_null_reason(spark):
    items = spark.createDataFrame([item(i, 1, f"000{i}", 200 + i, 1.0, 100.0, 1.0) for i in range(1, 6)], ITEM_DDL)
    soh = spark.createDataFrame([
        (1, 1, None, "ZOR", False),        # NULL reason kept
        (2, 1, "GOOD", "ZOR", False),      # rejected reason
        (3, 1, "LATE", "ZIC1", False),     # other reason kept
        (4, 1, None, "ZRE", False),        # other order type
        (5, 1, None, "ZOR", True),         # already issued
    ], SOH_DDL)
    out = price_disagreement(items, soh, mats(spark), org=100, division=2)
    assert rows(out, "MATERIAL_CODE") == [("1",), ("3",)]


def test_pieces_per_case_from_latest_material(spark):
    import datetime as dt
    m = mats(spark, ("1", "1", dt.date(2000, 1, 1), None, None, "2", "B", "Dry"),
             ("1", "1", dt.date(1999, 1, 1), None, None, "1", "B", "Dry"))
    items = spark.createDataFrame([item(1, 1, "1", 300, 10.0, 200.0, 10.0)], ITEM_DDL)  # 200/10/2 = 10 -> ok
    soh = spark.createDataFrame([(1, 1, None, "ZOR", False)], SOH_DDL)
    assert price_disagreement(items, soh, m, org=100, division=2).count() == 0


def test_attach_flag_left_join(spark):
    lines = make_lines(spark, dict(Material="2", PurchaseOrderId=100), dict(Material="9", PurchaseOrderId=100))
    flags = spark.createDataFrame([("2", 100, 1, "x")], "MATERIAL_CODE string, PurchaseOrderId bigint, "
                                                          "FlagPriceDisagreement int, AlertPriceDisagreement string")
    assert rows(attach_flag(lines, flags), "Material", "FlagPriceDisagreement") == [("2", 1), ("9", None)]
