"""Registered queries: one per operator group of SURVEY §2, over the test tables.

Every query reads whole tables through ``binding`` and returns a lazy
DataFrame whose column names match the oracle SQL in ``oracle.py``.
Doubles that come out of sums are rounded to 6 decimals so that the
order of floating-point additions does not matter in comparisons.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.calendar import fiscal_week_key
from ..functions.exprs import strip_leading_zeros
from . import binding as b
from . import params as P
from ..session import apply_job_conf, checkpoint_dir
from ..sources.sinks import write_overwrite, write_partitions
from .jobs import (DimensionInputs, DimensionPaths, OpenOrderBranches, OpenOrderInputs, OpenOrderParams, OpenOrderPaths,
                   files_for, material_dimension_job, material_dimension_job_from, open_order_job)

Query = Callable[[SparkSession, str], DataFrame]


class LazyOpenOrderInputs:
    """The decision job's inputs bound to the test tables on first use.

    A query that needs only the materials does not build (nor plan) the other
    ten inputs; ``OpenOrderBranches`` reads them as attributes.
    """

    _LOADERS = {
        "lines": b.order_lines, "sales_orders": b.sales_orders, "items": b.order_items, "materials": b.materials,
        "calendar": b.calendar, "stock": b.stock, "forecast": b.forecast, "transport": b.transport,
        "transit": b.transit, "quotas": b.quotas, "donor_pairs": lambda spark, d: b.donor_pairs(spark),
    }

    def __init__(self, spark: SparkSession, d: str, keep_lines: bool = False, whole: bool = False):
        self._spark, self._d, self._got = spark, d, {}
        if keep_lines:
            self._LOADERS = self._LOADERS | {"lines": lambda spark, d: b.kept_order_lines(spark, d, whole)}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._LOADERS:
            raise AttributeError(name)
        if name not in self._got:
            self._got[name] = self._LOADERS[name](self._spark, self._d)
        return self._got[name]


def open_order_inputs(spark: SparkSession, d: str) -> OpenOrderInputs:
    """All inputs, eagerly (for callers that want the plain dataclass)."""
    lazy = LazyOpenOrderInputs(spark, d)
    return OpenOrderInputs(**{k: getattr(lazy, k) for k in LazyOpenOrderInputs._LOADERS})


def open_order_params() -> OpenOrderParams:
    return OpenOrderParams(as_of=P.AS_OF, warehouses=P.WAREHOUSES, org=P.SALES_ORG, division=P.DIVISION_CODE,
                           price_tolerance=P.PRICE_TOLERANCE, dry_brands=P.DRY_BRANDS,
                           transport_division=P.TRANSPORT_DIVISION, later_back=P.LATER_BACK)


def branches(spark: SparkSession, d: str, persist: bool = False, by_order: bool = False, keep: bool = False,
             whole: bool = False) -> OpenOrderBranches:
    """Branches of the decision job; ``persist`` only for queries that use several, ``by_order`` for those that join
    several alerts to the lines, ``keep`` with it: lines, with the columns of decisions only or ``whole``, and what
    branches share are written once."""
    apply_job_conf(spark)
    return OpenOrderBranches(LazyOpenOrderInputs(spark, d, keep_lines=keep, whole=whole), open_order_params(), persist=persist,
                             by_order=by_order, keep=keep, tasks=b.order_tasks(spark, d) if keep else None)


def dimension_inputs(spark: SparkSession, d: str) -> DimensionInputs:
    return DimensionInputs(
        address=b.address_log(spark, d), address_type=b.address_type_log(spark, d), shipments=b.shipments(spark, d),
        attr_history=b.material_attr_history(spark, d), units=b.material_units(spark, d),
        material_text=b.material_text(spark, d), uom_text=b.uom_text(spark, d), brand_text=b.brand_text(spark, d),
        segment_text=b.segment_text(spark, d), classes=b.material_class(spark, d),
        class_values=b.class_values(spark, d))


def r6(c):
    return F.round(c, 6)


LINE_KEY = ["SalesOrderId", "PositionNumber", "Material", "MarsDc", "FactPlanBillingDate"]


# -- step 1 -------------------------------------------------------------------

def q_latest_event(spark, d):
    """Latest event per user of the events change log."""
    e = b.table(spark, d, "events")
    latest = op.latest_per_key(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.select("user_id", "event_id", "event_type", "value")


def q_price_flag(spark, d):
    """C6 (+A1, J1, X4, F1-F4)."""
    return branches(spark, d).price_flags()


# -- step 2 -------------------------------------------------------------------

def q_null_keeping_filter(spark, d):
    """open sales-order lines (rejection reason outside the list or NULL)."""
    return op.open_sales_lines(b.sales_orders(spark, d))


def q_fiscal_week(spark, d):
    """Demand week key on every calendar date."""
    cal = op.fiscal_labels(b.calendar(spark, d))
    return cal.select("OriginalDate", "MarsYear", "MarsPeriodName", "MarsWeekName", "MARS_WEEK_FOR_DEMAND")


def q_period_keys(spark, d):
    """Period keys of the run date's calendar row."""
    return op.period_keys(b.calendar(spark, d), P.AS_OF).select(
        "OriginalDate", "MarsYear", "MarsPeriod", "CurrentPeriodYear", "CurrentPeriodYearWithZeros")


def q_period_start(spark, d):
    """First date of the run date's fiscal period."""
    return op.period_start(b.calendar(spark, d), P.AS_OF)


def q_classify(spark, d):
    """C5 + L1a: latest material version with technology class."""
    return branches(spark, d).materials().select("MATERIAL", "Brand", "Technology", "UOM_PC2Case", "Tech")


def q_normalize_units(spark, d):
    """C24 + L1i: latest attribute load with lengths in cm."""
    a = op.normalize_units(op.latest_attributes(b.material_attr_history(spark, d)))
    return a.select("MATNR_PK", "LOAD_DATE", "MEABM", "LAENG_cm", "BREIT_cm", "HOEHE_cm")


def q_strip_zeros(spark, d):
    """Material code without leading zeros."""
    it = b.order_items(spark, d)
    return it.select("VBELN", "POSNR", "MATNR", strip_leading_zeros("MATNR").alias("MATERIAL_CODE"))


# -- step 3 -------------------------------------------------------------------

def q_cut_orders(spark, d):
    """Under-served, mostly cut orders at the checked warehouses."""
    return branches(spark, d).targets()


def q_windowed_distinct(spark, d):
    """Distinct materials of each line's order, as a window result.

    Lines meet their orders, so none is without one.
    """
    lines = op.count_distinct_over(b.order_lines(spark, d).select(*LINE_KEY), ["SalesOrderId"], "Material",
                                   "CountUniqueMaterials", "CountLines", null_keys=False)
    return lines.select(*LINE_KEY, "CountUniqueMaterials", "CountLines")


def q_rank_ties(spark, d):
    """L2/K2: per order the warehouse(s) with the most lines, ties kept."""
    return op.most_frequent(b.order_lines(spark, d), ["SalesOrderId"], ["MarsDc"], "n_lines")


# -- step 4 -------------------------------------------------------------------

def q_project_demand(spark, d):
    """Average daily demand over 57 days per latest stock row."""
    dem = branches(spark, d).demand()
    return dem.select("WAREHOUSE", "MATERIAL_CODE", "DAY", "TMS", "FREE_STOCK", r6(F.col("DEMAND_TOTAL")).alias(
        "DEMAND_TOTAL"), r6(F.col("FORECAST_CASES_8_WEEK_BY_PER_DAY")).alias("FORECAST_CASES_8_WEEK_BY_PER_DAY"))


def q_valid_at(spark, d):
    """Quota versions valid at the run date with quota left, and their text."""
    return branches(spark, d).quota_alert()


def q_arrivals(spark, d):
    """Distinct shipments since the period start with arrival date."""
    return branches(spark, d).arrivals()


def q_restock_asof(spark, d):
    """First arrival after the planned date for under-served lines."""
    return branches(spark, d).stock_alert()


def q_later_order(spark, d):
    """C17/J14/A7/L1f: quota held in a later order of the same customer, seen from a run date with many lines ahead."""
    return op.quota_in_later_order(b.order_lines(spark, d), P.LATER_AS_OF, back=P.LATER_BACK)


# -- step 5 -------------------------------------------------------------------

def q_donor_cover(spark, d):
    """Every (cut line, donor) with the donor's cover flag."""
    cov = branches(spark, d).covered()
    return cov.select("SalesOrderId", "Material", "MarsDc", "FactPlanBillingDate", "CsOrdered", "DonorPlant",
                      "TMS", "FREE_STOCK", r6(F.col("FORECAST_CASES_8_WEEK_BY_PER_DAY")).alias("DAILY_DEMAND"),
                      "AlertForGRD")


def q_feasible_orders(spark, d):
    """Orders a single donor can ship whole, with the qualifying donors."""
    f = branches(spark, d).feasible()
    return f.select("SalesOrderId", "Material", "FactPlanBillingDate", "CsOrdered", "DonorPlant",
                    "CountMaterialsInDonorPlant", "CountUniqueMaterialsInSalesorder",
                    r6(F.col("CsPreSlSalesOrder")).alias("CsPreSlSalesOrder"))


def q_best_donor(spark, d):
    """Donor text per order."""
    return branches(spark, d).donor_alert()


# -- step 6 -------------------------------------------------------------------

def q_attach_flag(spark, d):
    """Order lines with the price flag attached."""
    fl = branches(spark, d).flagged_lines()
    return fl.select(*LINE_KEY, "PurchaseOrderId", "FlagPriceDisagreement", "AlertPriceDisagreement")


def q_discontinued(spark, d):
    """Discontinued priority and text per line."""
    x = op.discontinued_alert(b.order_lines(spark, d))
    return x.select(*LINE_KEY, "Discontinue", "DiscontinueAlertPriority", "DiscontinueAlert")


def q_guarded_left_join(spark, d):
    """Quota text joined only to allocated lines with nothing available."""
    br = branches(spark, d)
    lines, q = br.inp.lines, br.quota_alert()
    j = op.guarded_left_join(lines, q, (lines["Material"] == q["Alert4_Material"])
                             & (lines["Customer"] == q["Alert4_Customer"]),
                             (lines["Allocation"] == F.lit(True)) & (lines["AllocationAvailable"] == 0))
    return j.select(*LINE_KEY, "Allocation", "AllocationAvailable", F.col("Alert").alias("QuotaAlert"))


def q_decisions(spark, d):
    """One decision per order line (flagship)."""
    dec = branches(spark, d, by_order=True, keep=True).decisions()
    return dec.select(*LINE_KEY, "Customer", "FlagPriceDisagreement", "Decision", "DecisionDescription", "Brand")


def q_typed_output(spark, d):
    """C20/P10: the 60-column typed output of the decision job."""
    return op.typed_output(branches(spark, d, by_order=True, keep=True, whole=True).decisions())


# -- step 7 -------------------------------------------------------------------

def q_active_sites(spark, d):
    """C21/L1g/F17: latest undeleted addresses of an active address type."""
    return op.active_sites(b.address_log(spark, d), b.address_type_log(spark, d), P.SITE_PREFIXES)


def q_shipped_materials(spark, d):
    """Materials on documents issued from active sites."""
    sites = op.active_sites(b.address_log(spark, d), b.address_type_log(spark, d), P.SITE_PREFIXES)
    return op.shipped_materials(b.shipments(spark, d), sites, P.CREATED_FROM, P.ISSUED_FROM)


def q_unit_pivot(spark, d):
    """C23/J17/L1h: latest ST and SB unit rows per material as columns."""
    return op.unit_pivot(b.material_units(spark, d))


def q_validity_interval(spark, d):
    """Validity interval of each order among its customer's orders."""
    o = b.table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("odate"))
    v = op.validity_interval(o, ["o_custkey"], "odate", tie_break=["o_orderkey"])
    return v.select("o_custkey", "o_orderkey", "odate", "StartDate", "EndDate")


def q_coded_text(spark, d):
    """Material technology class with its text."""
    return op.coded_text_lookup(b.material_class(spark, d), b.class_values(spark, d))


def q_material_dimension(spark, d):
    """The material dimension (without the load-time audit column)."""
    return material_dimension_job(dimension_inputs(spark, d), prefixes=P.SITE_PREFIXES, created_from=P.CREATED_FROM,
                                  issued_from=P.ISSUED_FROM, audit=False)


def q_material_dimension_history(spark, d):
    """C27 with every attribute load kept: several validity intervals per material."""
    return material_dimension_job(dimension_inputs(spark, d), prefixes=P.SITE_PREFIXES, created_from=P.CREATED_FROM,
                                  issued_from=P.ISSUED_FROM, audit=False, history=True)


def q_decisions_with_donor(spark, d):
    """C19 with the donor proposal merged in."""
    dec = branches(spark, d, by_order=True, keep=True).decisions(with_donor=True)
    return dec.select(*LINE_KEY, "Decision", "DecisionDescription", "DonorAlert", "DonorAlertPriority")


def _files(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> dict[str, str]:
    """Write each table below a new folder of the shared checkpoint folder; its path by name."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"
    for t, df in tables.items():
        write_overwrite(df, f"{root}/{t}")
    return {t: f"{root}/{t}" for t in tables} | {"root": root}


def _open_order_files(spark, d, quotas_by: str | None = None) -> tuple[OpenOrderPaths, str]:
    """The decision job's inputs as files: routes as CSV with other columns and their order changed, stock by partition."""
    inp = LazyOpenOrderInputs(spark, d)
    names = [f.name for f in fields(OpenOrderPaths) if f.name not in ("transit", "stock", *(["quotas"] if quotas_by else []))]
    paths = _files(spark, "open-orders", {n: getattr(inp, n) for n in names})
    root = paths.pop("root")
    routes = inp.transit.select("TransitQIdays", F.lit("x").alias("note"), "Tech", "to4", "from2")
    routes.write.option("header", "true").csv(f"{root}/transit")
    write_partitions(inp.stock, f"{root}/stock", ["WAREHOUSE"])
    if quotas_by:
        division = F.when(F.col("Customer") % 2 == 0, F.lit("even")).otherwise(F.lit("odd"))
        write_partitions(inp.quotas.withColumn(quotas_by, division), f"{root}/quotas", [quotas_by])
    paths |= {n: f"{root}/{n}" for n in ("transit", "stock", "quotas")}
    return OpenOrderPaths(**paths), root


def q_decisions_from_files(spark, d):
    """The decision job from dataset paths: its inputs written as files and read back by their contracts."""
    paths, root = _open_order_files(spark, d)
    return open_order_job(spark, paths, open_order_params(), P.DONOR_PAIRS, f"{root}/result", warehouse_type="int")


def q_decisions_for_partition(spark, d):
    """The decision job of one division: its partition of the quotas is read, its partition of the result replaced."""
    paths, root = _open_order_files(spark, d, P.PARTITION[0])
    return open_order_job(spark, paths, open_order_params(), P.DONOR_PAIRS, f"{root}/result", warehouse_type="int",
                          partition=P.PARTITION)


def q_dimension_from_files(spark, d):
    """The dimension job from dataset paths; its result is written with a number of files that
    grows with the inputs."""
    inp = dimension_inputs(spark, d)
    paths = _files(spark, "dimension", {f.name: getattr(inp, f.name) for f in fields(DimensionPaths)})
    root = paths.pop("root")
    paths = DimensionPaths(**paths)
    return material_dimension_job_from(spark, paths, f"{root}/result", files_for(spark, paths), prefixes=P.SITE_PREFIXES,
                                       created_from=P.CREATED_FROM, issued_from=P.ISSUED_FROM, audit=False)


QUERIES: dict[str, Query] = {
    "latest_event": q_latest_event,
    "price_flag": q_price_flag,
    "null_keeping_filter": q_null_keeping_filter,
    "fiscal_week": q_fiscal_week,
    "period_keys": q_period_keys,
    "period_start": q_period_start,
    "classify": q_classify,
    "normalize_units": q_normalize_units,
    "strip_zeros": q_strip_zeros,
    "cut_orders": q_cut_orders,
    "windowed_distinct": q_windowed_distinct,
    "rank_ties": q_rank_ties,
    "project_demand": q_project_demand,
    "valid_at": q_valid_at,
    "arrivals": q_arrivals,
    "restock_asof": q_restock_asof,
    "later_order": q_later_order,
    "donor_cover": q_donor_cover,
    "feasible_orders": q_feasible_orders,
    "best_donor": q_best_donor,
    "attach_flag": q_attach_flag,
    "discontinued": q_discontinued,
    "guarded_left_join": q_guarded_left_join,
    "decisions": q_decisions,
    "typed_output": q_typed_output,
    "active_sites": q_active_sites,
    "shipped_materials": q_shipped_materials,
    "unit_pivot": q_unit_pivot,
    "validity_interval": q_validity_interval,
    "coded_text": q_coded_text,
    "material_dimension": q_material_dimension,
    "material_dimension_history": q_material_dimension_history,
    "decisions_with_donor": q_decisions_with_donor,
    "decisions_from_files": q_decisions_from_files,
    "decisions_for_partition": q_decisions_for_partition,
    "dimension_from_files": q_dimension_from_files,
}
