"""Binding of the driver's test tables to the jobs' input contracts.

The original jobs read supply-chain datasets that are not available; the
test tables (``lineitem orders supplier nation part events``) are mapped onto
the same column contracts (FIXTURES.md) so that every operator runs on data
that grows with the tables.  Each function takes ``(spark, sf_dir)`` and
returns a lazy DataFrame; the DuckDB oracle (``plans/oracle.py``) builds the
same relations in SQL.

Mapping (one order line per ``lineitem`` row):

* order ``l_orderkey``, position ``l_linenumber``, material ``l_partkey`` (text),
  customer ``o_custkey``, sold-to party = the customer's nation, warehouse = region of the supplier's nation,
  planned date = ship date, created = processing date = order date,
  ordered = quantity, confirmed = quantity * (1 - 10 * discount);
* allocation: urgent orders TRUE, high-priority FALSE, others NULL;
  nothing available on returned lines; discontinued = returnflag A & open;
* stock, forecast and transports are the lines seen per (warehouse, part);
* the change logs of the dimension job are the ``events`` of each user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import fiscal_labels_of, fiscal_week_key, generate_calendar
from ..operators.joins import broadcast_if_small
from ..sources.readers import inline_relation, read_parquet
from ..sources.sinks import write_once_by
from ..session import dealt_by, planned_bytes, tasks_for
from . import params


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


# Supplier files up to which the dimension is broadcast unseen; beyond that its values
# are measured (``broadcast_if_small``).  Files are compressed: even at 16 times their size
# this stays within the library's bound of 64 MB.  Without the hint, the planner's size
# estimate of supplier x nation (product of both sizes) can exceed the estimate
# of the filtered line table, and it would broadcast the fact side instead.
SUPPLIER_BROADCAST_BYTES = 4 << 20


def _supplier_region(spark, d) -> DataFrame:
    supplier = table(spark, d, "supplier")
    s = supplier.select("s_suppkey", "s_nationkey", "s_name")
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey", "n_name")
    sr = s.join(n, s["s_nationkey"] == n["n_nationkey"]).drop("n_nationkey")
    return F.broadcast(sr) if planned_bytes(supplier) <= SUPPLIER_BROADCAST_BYTES else broadcast_if_small(sr)


# Bytes of line files for each task of the work by order, so that a task's share does not grow with the table.
ORDER_PARTITION_BYTES = 4 << 20


def _lines_with_region(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.join(_supplier_region(spark, d), li["l_suppkey"] == F.col("s_suppkey"))


ORDER_LINE_SOURCE_COLUMNS = [
    "SalesOrderId", "PositionNumber", "PurchaseOrderId", "Material", "Customer", "SoldTo", "MarsDc",
    "FactPlanBillingDate", "OrderProcessingDate", "OrderCreationDate", "RequestedDeliveryDate",
    "CsOrdered", "CsConfirmed", "CsPreSl", "CsPreUnderdeliver", "SlicePallet", "SliceCase", "SliceFlag",
    "CUT_QTY_PALLET", "AGREED_ORDEREDQTY_PALLET", "Allocation", "AllocationAvailable", "Discontinue",
    "MarsWeekFullName", "MarsWeekRollingNum", "MarsDay", "CustomerProductId", "Division", "CustomerDc",
    "CustomerDcCode", "Region", "Technology", "LsvOrdered", "LsvConfirmed", "LsvPreSl", "LsvPreUnderdeliver",
    "UnitsOrdered", "UnitsConfirmed", "UnitsPreSl", "UnitsPreUnderdeliver", "Zrep", "MaterialDescription",
    "Status", "Delivery", "Slices", "TMSWeighted", "PerformanceClient", "PerformanceCountry",
    "PerformanceClientPlant", "CaseFillClient", "CaseFillCountry", "SFAClient", "CurrentStatus",
]


# what the columns of a line up to ``MarsWeekFullName`` come from: all that a decision depends on
DECISION_SOURCE = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                   "l_shipdate", "n_regionkey", "o_custkey", "o_orderdate", "o_orderpriority", "c_nationkey"]


# and what all columns of a line come from, but for the supplier's, who is looked up where the lines are read
LINE_SOURCE = [*(c for c in DECISION_SOURCE if c != "n_regionkey"), "l_suppkey", "l_extendedprice", "o_orderstatus"]


def _orders_dealt(spark: SparkSession, d: str, size: int) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    cu = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return dealt_by(o.join(cu, F.col("o_custkey") == F.col("c_custkey")), "o_orderkey", size, ORDER_PARTITION_BYTES)


def order_tasks(spark: SparkSession, d: str) -> int:
    """To how many tasks the kept lines are dealt."""
    return tasks_for(spark, planned_bytes(table(spark, d, "lineitem")), ORDER_PARTITION_BYTES)


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    """Open order lines (``open_orders`` contract), dealt by order.

    Customers meet the orders, not the lines, so that the lines are dealt once, as the narrow
    columns of the files: what follows by order finds them in place.
    """
    li = table(spark, d, "lineitem")
    size = planned_bytes(li)
    o = _orders_dealt(spark, d, size)
    li = dealt_by(li, "l_orderkey", size, ORDER_PARTITION_BYTES).hint("merge")  # a broadcast side would lose the deal
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(_supplier_region(spark, d), F.col("l_suppkey") == F.col("s_suppkey")))
    return _lines_of(j, ORDER_LINE_SOURCE_COLUMNS)


def kept_order_lines(spark: SparkSession, d: str, whole: bool = False) -> DataFrame:
    """The columns of ``order_lines`` that a decision depends on, ``whole``: all, for jobs that read them in several branches.

    What they are made of is written once, in buckets by order: no branch deals or joins the lines again.
    """
    li = table(spark, d, "lineitem")
    size, source = planned_bytes(li), LINE_SOURCE if whole else DECISION_SOURCE
    o, region = _orders_dealt(spark, d, size), _supplier_region(spark, d)
    if not whole:
        li = li.join(region, F.col("l_suppkey") == F.col("s_suppkey"))
    li = dealt_by(li.select(*[c for c in source if c in li.columns]), "l_orderkey", size, ORDER_PARTITION_BYTES).hint("merge")
    made = write_once_by(li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(*source), "lines", "l_orderkey",
                         order_tasks(spark, d))
    if whole:
        return _lines_of(made.join(region, F.col("l_suppkey") == F.col("s_suppkey")), ORDER_LINE_SOURCE_COLUMNS)
    upto = ORDER_LINE_SOURCE_COLUMNS.index("MarsWeekFullName") + 1
    return _lines_of(made, ORDER_LINE_SOURCE_COLUMNS[:upto])


def _lines_of(j: DataFrame, names: list[str]) -> DataFrame:
    planned = F.col("l_shipdate").cast("date")
    created = F.col("o_orderdate").cast("date")
    conf_factor = 1 - 10 * F.col("l_discount")
    confirmed = F.round(F.col("l_quantity") * conf_factor, 2)
    labels = fiscal_labels_of(planned)
    cols = {
        "SalesOrderId": F.col("l_orderkey"),
        "PositionNumber": F.col("l_linenumber"),
        "PurchaseOrderId": F.col("l_orderkey"),
        "Material": F.col("l_partkey").cast("string"),
        "Customer": F.col("o_custkey"),
        "SoldTo": F.col("c_nationkey"),
        "MarsDc": F.col("n_regionkey"),
        "FactPlanBillingDate": planned,
        "OrderProcessingDate": created,
        "OrderCreationDate": created,
        "RequestedDeliveryDate": planned,
        "CsOrdered": F.col("l_quantity"),
        "CsConfirmed": confirmed,
        "CsPreSl": F.try_divide(confirmed, F.col("l_quantity")),
        "CsPreUnderdeliver": F.col("l_quantity") - confirmed,
        "SlicePallet": F.round(10 * F.col("l_discount"), 2),
        "SliceCase": F.col("l_quantity") - confirmed,
        "SliceFlag": F.col("l_discount") >= 0.05,
        "CUT_QTY_PALLET": F.col("l_quantity") - confirmed,
        "AGREED_ORDEREDQTY_PALLET": F.col("l_quantity"),
        "Allocation": F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(True))
                       .when(F.col("o_orderpriority") == "2-HIGH", F.lit(False)),
        "AllocationAvailable": F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_tax") * 100),
        "Discontinue": F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), F.lit("Yes"))
                        .otherwise(F.lit("No")),
        "MarsWeekFullName": labels["MarsWeekFullName"],
        "MarsWeekRollingNum": labels["MarsPeriod"],
        "MarsDay": F.dayofyear(planned),
        "CustomerProductId": F.concat(F.col("o_custkey"), F.lit("-"), F.col("l_partkey")),
        "Division": F.col("o_orderstatus"),
        "CustomerDc": F.col("s_name"),
        "CustomerDcCode": F.col("s_nationkey").cast("string"),
        "Region": F.col("n_name"),
        "Technology": F.when(F.col("l_linestatus") == "F", F.lit("Dry")),
        "LsvOrdered": F.col("l_extendedprice"),
        "LsvConfirmed": F.col("l_extendedprice") * conf_factor,
        "LsvPreSl": F.try_divide(confirmed, F.col("l_quantity")),
        "LsvPreUnderdeliver": F.col("l_extendedprice") - F.col("l_extendedprice") * conf_factor,
        "UnitsOrdered": 12 * F.col("l_quantity"), "UnitsConfirmed": 12 * confirmed,
        "UnitsPreSl": F.try_divide(confirmed, F.col("l_quantity")),
        "UnitsPreUnderdeliver": 12 * F.col("l_quantity") - 12 * confirmed,
        "Zrep": F.concat(F.lit("Z"), F.col("l_partkey")),
        "MaterialDescription": F.concat(F.lit("Material "), F.col("l_partkey")),
        "Status": F.col("o_orderstatus"),
        "Delivery": F.col("l_linestatus") == "F",
        "Slices": F.col("l_discount") > 0,
        "TMSWeighted": F.col("l_tax") * F.col("l_quantity"), "PerformanceClient": 1 - F.col("l_tax"),
        "PerformanceCountry": 1 - F.col("l_discount"), "PerformanceClientPlant": F.col("l_tax") + F.col("l_discount"),
        "CaseFillClient": conf_factor, "CaseFillCountry": F.col("l_discount"), "SFAClient": F.col("l_tax"),
        "CurrentStatus": F.concat(F.col("l_returnflag"), F.col("l_linestatus")),
    }
    return j.select(*[cols[n].alias(n) for n in names])


def sales_orders(spark: SparkSession, d: str) -> DataFrame:
    """Sales-order lines with rejection reason, order type and goods-issue status."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    reason = (F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit("DELETED"))
              .when(F.col("l_returnflag") == "R", F.lit("GOOD"))
              .when(F.col("l_returnflag") == "A", F.lit("LATE")))
    otype = (F.when(F.col("o_orderstatus") == "O", F.lit("ZOR")).when(F.col("o_orderstatus") == "F", F.lit("ZIC1"))
             .otherwise(F.lit("ZRE")))
    return j.select(F.col("l_orderkey").alias("SALESORDERID"), F.col("l_linenumber").alias("POSITION_NUMBER"),
                    reason.alias("REJECTIONREASON_TYPE"), otype.alias("SALESORDERTYPE"),
                    (F.col("l_linestatus") == "F").alias("GISTATUS"))


def order_items(spark: SparkSession, d: str) -> DataFrame:
    """Billing items: material with leading zeros, quantity, conversion, amount, net price."""
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part").select("p_partkey", "p_type", "p_retailprice")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(
        F.col("l_orderkey").alias("VBELN"), F.col("l_linenumber").alias("POSNR"),
        F.concat(F.lit("000"), F.col("l_partkey")).alias("MATNR"),
        F.lit(params.SALES_ORG).alias("VKORG"),
        F.when(F.col("p_type") == "PROMO", F.lit(9)).otherwise(F.lit(params.DIVISION_CODE)).alias("SPART"),
        F.col("l_orderkey").alias("BSTNK"), F.col("l_quantity").alias("KWMENG"),
        F.lit(1.0).alias("UMVKZ"),
        F.when(F.col("l_tax") == 0, F.lit(0.0)).otherwise(F.lit(1.0)).alias("UMVKN"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
         .alias("KZWI3"),
        F.col("p_retailprice").alias("NETPR"))


def materials(spark: SparkSession, d: str) -> DataFrame:
    """Material master: two versions a part, of which the second holds, and a third with the same dates for some.

    Earlier versions carry another brand, technology and conversion.
    """
    versions = F.explode(F.sequence(F.lit(0), F.when(F.col("p_size") % 3 == 0, 2).otherwise(1))).alias("v")
    p = table(spark, d, "part").select("*", versions)
    p = p.select("p_partkey", "v", "p_size",
                 F.when(F.col("v") == 1, F.col("p_type")).otherwise(F.lit("SMALL")).alias("p_type"),
                 F.when(F.col("v") == 1, F.col("p_brand")).otherwise(F.lit("old")).alias("p_brand"))
    tech = (F.when(F.col("p_type") == "ECONOMY", F.lit("Dry")).when(F.col("p_type") == "SMALL", F.lit("Care & Treats"))
            .when(F.col("p_type") == "LARGE", F.lit("Pouch")).when(F.col("p_type") == "PROMO", F.lit(None))
            .otherwise(F.col("p_type")))
    return p.select(
        F.col("p_partkey").cast("string").alias("MATERIAL"), F.col("p_partkey").cast("string").alias("MATNR"),
        F.when(F.col("v") == 0, F.lit("1990-01-01")).otherwise("1995-01-01").cast("date").alias("START_DATE"),
        F.when(F.col("v") == 1, F.lit("1995-02-01").cast("date")).alias("VMSTD"),
        F.date_add(F.lit("1990-01-01").cast("date"), F.col("v")).alias("0CREATEDON"),
        F.when(F.col("p_type") == "SMALL", F.lit("2")).when(F.col("p_type") == "LARGE", F.lit(None))
         .otherwise(F.lit("1")).cast("string").alias("UOM_PC2Case"),
        F.col("p_brand").alias("Brand"), tech.alias("Technology"))


def calendar(spark: SparkSession, d: str) -> DataFrame:
    """Fiscal calendar over the ship-date span of the data (+ margin for horizons)."""
    span = table(spark, d, "lineitem").agg(
        F.min(F.col("l_shipdate").cast("date")).alias("start"),
        F.date_add(F.max(F.col("l_shipdate").cast("date")), params.CALENDAR_MARGIN_DAYS).alias("end"))
    return generate_calendar(span)


def stock(spark: SparkSession, d: str) -> DataFrame:
    """Stock snapshots per (warehouse, part)."""
    j = _lines_with_region(spark, d)
    return j.select(F.col("n_regionkey").alias("WAREHOUSE"), F.col("l_partkey").cast("string").alias("MATERIAL_CODE"),
                    F.col("l_shipdate").cast("date").alias("DAY"), (1 + F.col("l_linenumber")).cast("double").alias("TMS"),
                    (2 * F.col("l_quantity")).alias("FREE_STOCK"))


def forecast(spark: SparkSession, d: str) -> DataFrame:
    """Forecast per (warehouse, part) for the week after each shipment, valid from 13 weeks before it to 4 weeks after."""
    planned = F.col("l_shipdate").cast("date")
    lab = fiscal_labels_of(F.date_add(planned, 7))
    week = fiscal_week_key(lab["MarsYear"], lab["MarsPeriodName"], lab["MarsWeekName"])
    return _lines_with_region(spark, d).select(
        F.col("n_regionkey").alias("PLANT"), F.col("l_partkey").cast("string").alias("MATERIAL_CODE"),
        week.alias("MARS_WEEK"), F.date_add(planned, -91).alias("F_STARTDATE"),
        F.date_add(planned, 28).alias("F_ENDDATE"), F.col("l_quantity").alias("FORECAST_CASES"))


def transport(spark: SparkSession, d: str) -> DataFrame:
    """Goods issues from the supplier's nation (plant) to its region (warehouse)."""
    return _lines_with_region(spark, d).select(
        F.when(F.col("l_returnflag") == "R", F.lit("Other")).otherwise(F.lit(params.TRANSPORT_DIVISION))
         .alias("Division"),
        F.col("l_shipdate").cast("date").alias("Delivery_ActualGI__DTTM"),
        F.col("l_partkey").cast("string").alias("GRD"),
        F.col("s_nationkey").alias("Delivery_LocationFrom__FK"),
        F.col("n_regionkey").alias("Delivery_LocationTo__FK"),
        F.col("l_quantity").alias("GoodsIssue_Qty__CS"))


def transit(spark: SparkSession, d: str) -> DataFrame:
    """Transit + quality days per (plant, warehouse, technology), as text like a CSV column."""
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    x = n.select("n_nationkey", "n_regionkey", F.explode(F.array(F.lit("DRY"), F.lit("WET"))).alias("Tech"))
    days = 1 + F.col("n_nationkey") % 7 + F.when(F.col("Tech") == "WET", F.lit(2)).otherwise(F.lit(0))
    return x.select(F.col("n_nationkey").alias("from2"), F.col("n_regionkey").alias("to4"), "Tech",
                    days.cast("string").alias("TransitQIdays"))


def quotas(spark: SparkSession, d: str) -> DataFrame:
    """Quota versions per (part, customer): one per order date, valid until the next one."""
    from pyspark.sql import Window
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").cast("string").alias("Material"), F.col("o_custkey").alias("Customer"),
        F.col("o_orderdate").cast("date").alias("ForecastVersionStartDate"), "l_quantity")
    g = (lines.repartition("Material", "Customer").groupBy("Material", "Customer", "ForecastVersionStartDate")  # the window's deal
         .agg(F.sum("l_quantity").alias("__qty"), F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy("Material", "Customer").orderBy("ForecastVersionStartDate")
    nxt = F.lead("ForecastVersionStartDate", 1).over(w)
    return g.select("Material", "Customer", "ForecastVersionStartDate",
                    F.coalesce(nxt, F.lit("9999-12-31").cast("date")).alias("ForecastVersionEndDate"),
                    (F.col("__qty").cast("bigint") - 30).alias("RemainingUnconfirmedQuota"),
                    F.concat(F.lit("lines: "), F.col("__n")).alias("Summary"))


def donor_pairs(spark: SparkSession) -> DataFrame:
    return inline_relation(spark, params.DONOR_PAIRS, "SourcePlant int, DonorPlant int")


# -- material dimension -------------------------------------------------------

def _event_log(spark, d) -> DataFrame:
    return table(spark, d, "events")


def address_type_log(spark: SparkSession, d: str) -> DataFrame:
    """Address-type change log: each user's events; the event type is the prefix, errors delete."""
    e = _event_log(spark, d)
    return e.select(F.col("user_id").alias("ID"), F.col("ts").alias("STAMP"),
                    F.col("event_id").alias("__PIPELINE_UNIX_TS__"),
                    F.when(F.col("event_type") == "error", F.col("ts").cast("date")).alias("REMOVEDATE"),
                    F.col("event_type").alias("PREFIX"))


def address_log(spark: SparkSession, d: str) -> DataFrame:
    """Address change log: each user's events; the type id is the event's ``k`` property."""
    e = _event_log(spark, d)
    k = F.regexp_extract(F.col("props"), r'"k": (\d+)', 1).try_cast("bigint")
    return e.select(F.col("user_id").alias("ID"), F.col("ts").alias("STAMP"),
                    F.col("event_id").alias("__PIPELINE_UNIX_TS__"),
                    F.when(F.col("event_type") == "error", F.col("ts").cast("date")).alias("REMOVEDATE"),
                    k.alias("ADDRESSTYPEID"), F.col("user_id").cast("string").alias("SAPID"))


def shipments(spark: SparkSession, d: str) -> DataFrame:
    """Delivery items: document, material, issuing site (supplier), text creation date, goods issue."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(F.col("l_orderkey").alias("VBELN"), F.col("l_partkey").cast("string").alias("MATNR"),
                    F.col("l_suppkey").cast("string").alias("WERKS"),
                    F.date_format(F.col("o_orderdate"), "yyyy.MM.dd").alias("ERDAT"),
                    F.col("l_shipdate").cast("date").alias("WADAT_IST"))


def _part(spark, d) -> DataFrame:
    return table(spark, d, "part")


def material_attr_history(spark: SparkSession, d: str) -> DataFrame:
    """Material attribute loads: one load per (part, ship year) carrying the part's attributes."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_shipdate")
    loads = (li.groupBy("l_partkey", F.year("l_shipdate").alias("__y"))
             .agg(F.min(F.col("l_shipdate").cast("date")).alias("LAEDA"), F.count(F.lit(1)).alias("DI_SEQUENCE_NUMBER")))
    p = _part(spark, d)
    j = loads.join(p, F.col("l_partkey") == F.col("p_partkey"))
    meabm = (F.when(F.col("p_type") == "ECONOMY", F.lit("MM")).when(F.col("p_type") == "LARGE", F.lit("M"))
             .when(F.col("p_type") == "SMALL", F.lit("IN")).when(F.col("p_type") == "MEDIUM", F.lit("CM")))
    return j.select(
        F.col("p_partkey").cast("string").alias("MATNR_PK"), F.make_date("__y", F.lit(12), F.lit(31)).alias("LOAD_DATE"),
        "DI_SEQUENCE_NUMBER", "LAEDA", F.concat(F.lit("Z"), F.col("p_partkey")).alias("ZZREPMATNR"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("MEINS"), F.col("p_type").alias("MTART"),
        F.col("p_size").cast("string").alias("SPART"), F.col("p_type").alias("ZZCLF02"),
        F.col("p_brand").alias("ZZCLF03"), F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("ZZCLF20"),
        meabm.alias("MEABM"), F.col("p_size").cast("double").alias("LAENG"),
        (F.col("p_retailprice") / 100).alias("BREIT"), F.length("p_name").cast("double").alias("HOEHE"),
        F.when(F.col("p_size") > 25, F.lit("KG")).otherwise(F.lit("G")).alias("GEWEI"),
        F.col("p_retailprice").alias("NTGEW"), (F.col("p_retailprice") + F.col("p_size")).alias("BRGEW"))


def material_units(spark: SparkSession, d: str) -> DataFrame:
    """Unit-of-measure loads per part: unit code from the return flag, one per line."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_partkey").cast("string").alias("MATNR"),
        F.when(F.col("l_returnflag") == "A", F.lit("ST")).when(F.col("l_returnflag") == "R", F.lit("SB"))
         .otherwise(F.lit("PAL")).alias("MEINH"),
        F.col("l_shipdate").cast("date").alias("LOAD_DATE"),
        F.col("l_quantity").cast("bigint").cast("string").alias("UMREN"),
        F.when(F.col("l_linestatus") == "F", F.lit("KG")).otherwise(F.lit("G")).alias("GEWEI"),
        (F.col("l_tax") * 100).alias("ZZNTGEW"))


def material_text(spark: SparkSession, d: str) -> DataFrame:
    p = _part(spark, d)
    return p.select(F.col("p_partkey").cast("string").alias("MATNR"),
                    F.when(F.col("p_size") > 45, F.lit("DE")).otherwise(F.lit("EN")).alias("SPRAS"),
                    F.col("p_name").alias("TXTMD"))


def uom_text(spark: SparkSession, d: str) -> DataFrame:
    code = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
    return _part(spark, d).select(code.alias("CHRCOD")).distinct().select("CHRCOD", F.upper("CHRCOD").alias("VTEXT"))


def brand_text(spark: SparkSession, d: str) -> DataFrame:
    return (_part(spark, d).select(F.col("p_brand").alias("CHRCOD_PK")).distinct()
            .select("CHRCOD_PK", F.upper("CHRCOD_PK").alias("VTEXT")))


def segment_text(spark: SparkSession, d: str) -> DataFrame:
    return (_part(spark, d).select(F.col("p_type").alias("CHRCOD_PK")).distinct()
            .select("CHRCOD_PK", F.lower("CHRCOD_PK").alias("VTEXT")))


def _tech_class():
    return (F.when(F.col("p_size") <= 10, F.lit("T1")).when(F.col("p_size") <= 30, F.lit("T2"))
            .otherwise(F.lit("T3")))


def material_class(spark: SparkSession, d: str) -> DataFrame:
    return _part(spark, d).select(F.col("p_partkey").cast("string").alias("MATNR_PK"), _tech_class().alias("UDCTECH001"))


def class_values(spark: SparkSession, d: str) -> DataFrame:
    """Texts of the technology classes; class T3 has no text."""
    codes = _part(spark, d).select(_tech_class().alias("ATWRT_PK")).distinct().where(F.col("ATWRT_PK") != "T3")
    return codes.select("ATWRT_PK", F.concat(F.lit("Technology "), F.col("ATWRT_PK")).alias("TEXT"))
