"""The two end-to-end jobs, assembled from the operators.

``open_order_decisions`` (entry 1) and ``material_dimension_job`` (entry 2)
take their inputs as DataFrames and return the final typed DataFrame; the
``run_*`` functions add the write, and ``open_order_job`` and
``material_dimension_job_from`` start from dataset paths: they read through
the readers, check the input contracts, run, write, and read the result back.  Shared sub-results (flagged
order lines, prepared materials, the last line per order material) are built
once and referenced by every branch, so Spark can reuse their exchanges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.units import DRY_BRANDS, technology_rules
from ..session import apply_job_conf, dealt_by, planned_bytes, tasks_for
from ..sources.readers import (assert_types, assert_unique, inline_relation, read_csv, read_delta, read_format,
                               read_history, read_partition, read_snapshot)
from ..sources.sinks import write_bounded, write_once, write_once_by, write_overwrite, write_partition
from .checks import JobReport


# the columns of the lines that the alerts, but for the donors', and the materials are looked up by
ALERT_COLUMNS = ["SalesOrderId", "PositionNumber", "PurchaseOrderId", "Material", "Customer", "SoldTo", "MarsDc", "FactPlanBillingDate",
                 "OrderProcessingDate", "OrderCreationDate", "CsConfirmed", "CsPreSl", "SlicePallet", "Allocation",
                 "AllocationAvailable", "Discontinue"]


@dataclass
class OpenOrderInputs:
    lines: DataFrame
    sales_orders: DataFrame
    items: DataFrame
    materials: DataFrame
    calendar: DataFrame
    stock: DataFrame
    forecast: DataFrame
    transport: DataFrame
    transit: DataFrame
    quotas: DataFrame
    donor_pairs: DataFrame


@dataclass
class OpenOrderParams:
    as_of: str
    warehouses: Sequence
    org: object
    division: object
    transport_division: str
    price_tolerance: float = 0.02
    dry_brands: Sequence[str] = DRY_BRANDS
    coefficient: float = 0.5
    horizon: int = 56
    divisor: int = 56
    later_back: int = 2


class OpenOrderBranches:
    """Intermediate results of the decision job, built lazily and once.

    The flagged order lines feed four branches (cut orders, restock, later
    order, merge).  With ``persist=True`` they are kept (memory, spilling to
    disk) the first time they are computed, so the line source and its joins
    run once per job; a lost executor's blocks are recomputed from lineage.
    With ``checkpoint=True`` they are instead written once to the shared
    checkpoint folder (``spark.checkpoint.dir``) and read back by every branch,
    which cuts the lineage: a late executor loss re-reads them rather than
    re-running the joins.  ``release()`` drops persisted blocks after the write.

    ``by_order=True``: the lines are dealt by order and none lacks its order.  Whole lines are then not
    dealt again: lookups by other columns are keyed by order first (``keyed_by_order``), and a checkpoint holds
    the lines' price flags, from which with the lines themselves the flagged ones follow in place.
    ``keep=True``: the price flags, and the last lines of orders that can play a part in C17, are written once.
    ``tasks``: to how many the lines are dealt by order; an alert dealt to another number would be dealt once more.
    ``checkpoint`` with ``by_order`` and ``tasks``: the columns of the lines that the alerts read (``ALERT_COLUMNS``) are written
    once, in buckets by order, so that no alert deals the lines or reads the whole ones; these are dealt for the merge alone.
    """

    def __init__(self, inp: OpenOrderInputs, prm: OpenOrderParams, persist: bool = False,
                 checkpoint: bool = False, by_order: bool = False, keep: bool = False, tasks: int | None = None):
        self.inp, self.prm, self.checkpoint, self.by_order, self.keep, self.tasks = inp, prm, checkpoint, by_order, keep, tasks
        self.persist = persist or (checkpoint and not by_order)
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def materials(self):
        return self._get("materials", lambda: op.prepare_materials(
            self.inp.materials, technology_rules(dry_brands=self.prm.dry_brands)))

    def _kept(self, df, name):
        return write_once(df, name) if self.keep else df

    def price_flags(self):
        return self._get("price", lambda: self._kept(op.price_disagreement(
            self.inp.items, self.inp.sales_orders, self.materials(), org=self.prm.org, division=self.prm.division,
            tolerance=self.prm.price_tolerance), "flags"))

    def flagged_lines(self):
        def build():
            lines, flags = self.inp.lines, self.price_flags()
            if self.checkpoint and self.by_order:
                on = {"Material": "MATERIAL_CODE", "PurchaseOrderId": "PurchaseOrderId"}
                return op.attach_flag(lines, write_once(op.keyed_by_order(self.alert_lines(), flags, on), "flags"), by_order=True)
            df = op.attach_flag(lines, flags, self.keep)
            if self.checkpoint:
                return write_once(df, "flagged")  # in columns: a fraction of a checkpoint's serialized rows
            return df.persist(StorageLevel.MEMORY_AND_DISK) if self.persist else df
        return self._get("flagged", build)

    def alert_lines(self):
        """The lines for all that is looked up by them."""
        if not (self.checkpoint and self.by_order and self.tasks):
            return self.inp.lines
        return self._get("alert lines", lambda: write_once_by(
            self.inp.lines.select(*ALERT_COLUMNS), "lines", "SalesOrderId", self.tasks))

    def shared_lines(self):
        """Lines for the restock and later-order branches: the persisted flagged
        lines when the job keeps them (one computation for all branches), else
        the plain lines (no price check needed)."""
        return self.flagged_lines() if self.persist else self.alert_lines()

    def release(self):
        if "flagged" in self._cache and self.persist and not self.checkpoint:
            self._cache["flagged"].unpersist()

    def targets(self):
        return self._get("targets", lambda: op.cut_orders(self.flagged_lines(), self.prm.as_of, self.prm.warehouses))

    def demand(self):
        """Demand of every (warehouse, material)."""
        return self._get("demand", lambda: self._project(None))

    def _project(self, pairs):
        return op.project_demand(self.inp.stock, self.inp.forecast, self.inp.calendar, self.prm.horizon, self.prm.divisor,
                                 pairs=pairs)

    def cut_lines(self):
        """Written once, as the demand's pairs and the cover both read them."""
        return self._get("cut", lambda: write_once(self.targets(), "cut"))

    def asked(self):
        """Cut lines with their donors."""
        return self._get("asked", lambda: op.expand_donors(self.cut_lines(), self.inp.donor_pairs))

    def covered(self):
        return self._get("covered", lambda: op.donor_cover(
            self.asked(), self._project(op.asked_pairs(self.asked())), self.prm.coefficient))

    def feasible(self):
        """The covered rows are written once, as the division reads them for its counts and for its rows; ``by_order``: in
        buckets by order, all of whose work is then in place."""
        def build():
            if not self.by_order:
                return op.whole_order_feasible(write_once(self.covered(), "covered"))
            buckets = tasks_for(self.inp.donor_pairs.sparkSession, planned_bytes(self.cut_lines()), CUT_BYTES)
            return op.whole_order_feasible(write_once_by(self.covered(), "covered", "SalesOrderId", buckets), by_order=True)
        return self._get("feasible", build)

    def donor_alert(self):
        return self._get("donor", lambda: op.best_donor(self.feasible()))

    def first_date(self):
        return self._get("first_date", lambda: op.period_start(self.inp.calendar, self.prm.as_of))

    def arrivals(self):
        return self._get("arrivals", lambda: op.arrivals(
            self.inp.transport, self.materials(), self.inp.transit, self.first_date(), self.prm.transport_division))

    def stock_alert(self):
        return self._get("restock", lambda: op.restock_asof(self.shared_lines(), self.arrivals(), self.prm.as_of, tasks=self.tasks))

    def quota_alert(self):
        return self._get("quota", lambda: op.quota_exceeded(self.inp.quotas, self.prm.as_of))

    def later_alert(self):
        return self._get("later", lambda: op.quota_in_later_order(
            self.shared_lines(), self.prm.as_of, back=self.prm.later_back,
            keep=lambda last: write_once(last.where("asks or holds"), "last") if self.keep or "alert lines" in self._cache else last))

    def decisions(self, with_donor: bool = False, report: JobReport | None = None):
        lines, quota, mats = self.alert_lines(), self.quota_alert(), self.materials()
        if self.by_order:
            quota = op.keyed_by_order(lines.where(op.may_ask_quota(lines)), quota,
                                      {"Material": "Alert4_Material", "Customer": "Alert4_Customer"})
            mats = op.keyed_by_order(lines, mats, {"Material": "MATERIAL"})
        return op.merge_decisions(
            op.discontinued_alert(self.flagged_lines()), self.stock_alert(), self.later_alert(), quota,
            mats, source_columns=self.inp.lines.columns,
            donor_alert=self.donor_alert() if with_donor else None, report=report,
            by_order=self.by_order)


def open_order_decisions(inp: OpenOrderInputs, prm: OpenOrderParams) -> DataFrame:
    """Entry 1: one typed row per open order line with its decision (lazy)."""
    return op.typed_output(OpenOrderBranches(inp, prm).decisions())


@dataclass
class DimensionInputs:
    address: DataFrame
    address_type: DataFrame
    shipments: DataFrame
    attr_history: DataFrame
    units: DataFrame
    material_text: DataFrame
    uom_text: DataFrame
    brand_text: DataFrame
    segment_text: DataFrame
    classes: DataFrame
    class_values: DataFrame


def material_dimension_job(inp: DimensionInputs, prefixes=("PLANT", "SHIPPING_POINT"), created_from="2019-12-29",
                           issued_from="2020-01-01", audit: bool = True, history: bool = False,
                           report: JobReport | None = None) -> DataFrame:
    """Entry 2: the material dimension."""
    sites = op.active_sites(inp.address, inp.address_type, prefixes)
    shipped = op.shipped_materials(inp.shipments, sites, created_from, issued_from)
    return op.material_dimension(inp.attr_history, shipped, inp.units, inp.material_text, inp.uom_text,
                                 inp.brand_text, inp.segment_text, inp.classes, inp.class_values, audit=audit, history=history,
                                 report=report)


def run_open_order_decisions(inp: OpenOrderInputs, prm: OpenOrderParams, target_path: str,
                             checkpoint: bool | None = None, partition: tuple[str, object] | None = None,
                             report: JobReport | None = None, by_order: bool = False, tasks: int | None = None) -> JobReport:
    """Entry 1 with its write; ``by_order``, ``tasks``: see ``OpenOrderBranches``; ``partition``: only that (column, value) partition of the target is replaced.

    When ``spark.checkpoint.dir`` is set (or ``checkpoint=True``) the shared
    order lines are checkpointed there once, cutting the lineage for all four
    branches.  Otherwise each branch recomputes only the columns it needs from
    the sources: caching the wide lines in memory was measured slower (sf0.1,
    25 s without vs 30 s with an eagerly filled cache).

    The result replaces the old one after its checks: an alert or lookup that repeats a key and so multiplied
    lines raises, and the old rows stay.  Returns the counts of rows and of values that didn't convert.
    """
    spark = apply_job_conf(inp.lines.sparkSession)
    if checkpoint is None:
        checkpoint = bool(spark.conf.get("spark.checkpoint.dir", None)
                          or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    report = report or JobReport()
    br = OpenOrderBranches(inp, prm, persist=checkpoint and not by_order, checkpoint=checkpoint, by_order=by_order,
                           tasks=tasks)
    try:
        result = op.typed_output(br.decisions(report=report), report=report)
        if partition is None:
            write_overwrite(result, target_path, report.verify)
        else:
            write_partition(result, target_path, *partition, check=report.verify)
    finally:
        br.release()
    return report


def run_material_dimension(inp: DimensionInputs, target_path: str, files: int | None = None, **kw) -> JobReport:
    """Entry 2 with its write in ``files`` files; by default in as many as its last stage has tasks.

    The result replaces the old one after its checks, as in ``run_open_order_decisions``.
    """
    apply_job_conf(inp.address.sparkSession)
    report = JobReport()
    result = material_dimension_job(inp, report=report, **kw)
    if files is None:
        write_overwrite(result, target_path, report.verify)
    else:
        write_bounded(result, target_path, files, check=report.verify)
    return report


# -- from dataset paths ---------------------------------------------------------

@dataclass
class OpenOrderPaths:
    """Folders of the decision job's datasets; ``transit`` is CSV, the rest Parquet."""
    lines: str
    sales_orders: str
    items: str
    materials: str
    calendar: str
    stock: str
    forecast: str
    transport: str
    transit: str
    quotas: str


@dataclass
class DimensionPaths:
    address: str
    address_type: str
    shipments: str
    attr_history: str
    units: str
    material_text: str
    uom_text: str
    brand_text: str
    segment_text: str
    classes: str
    class_values: str


CUT_BYTES = 4 << 20  # bytes of the cut lines' files for each bucket of the covered rows
ORDER_BYTES = 16 << 20  # bytes of the line files for each task of the work by order
FILE_BYTES = 128 << 20  # input bytes for each file of a bounded result

# Columns whose type the contracts name.
OPEN_ORDER_TYPES = {
    "lines": {"FactPlanBillingDate": "date", "OrderProcessingDate": "date", "OrderCreationDate": "date"},
    "materials": {"START_DATE": "date"},
    "calendar": {"OriginalDate": "date"},
    "stock": {"DAY": "date"},
    "forecast": {"F_STARTDATE": "date", "F_ENDDATE": "date"},
    "transport": {"Delivery_ActualGI__DTTM": "date"},
    "quotas": {"ForecastVersionStartDate": "date", "ForecastVersionEndDate": "date"},
}
DIMENSION_TYPES = {"shipments": {"WADAT_IST": "date"}, "attr_history": {"LAEDA": "date", "LOAD_DATE": "date"}}


def read_open_order_inputs(spark: SparkSession, paths: OpenOrderPaths, donor_pairs: Sequence[tuple],
                           warehouse_type: str = "string", partition: tuple[str, object] | None = None,
                           report: JobReport | None = None) -> OpenOrderInputs:
    """The decision job's inputs from their folders, with the contracts' types checked.

    ``partition``: the quotas of that (column, value) partition only (S9).  The forecast is read
    by the name of its format (S2).
    """
    read = {"materials": read_history, "stock": read_history, "quotas": read_delta, "forecast": read_format}
    tables = {f.name: read.get(f.name, read_snapshot)(spark, getattr(paths, f.name))
              for f in fields(paths) if f.name != "transit"}
    if partition is not None:
        tables["quotas"] = read_partition(spark, paths.quotas, *partition).drop(partition[0])
    for name, types in OPEN_ORDER_TYPES.items():
        assert_types(tables[name], types, name)
    transit = read_csv(spark, paths.transit,
                       f"from2 {warehouse_type}, to4 {warehouse_type}, Tech string, TransitQIdays string")
    pairs = inline_relation(spark, donor_pairs, f"SourcePlant {warehouse_type}, DonorPlant {warehouse_type}")
    return OpenOrderInputs(**tables, transit=transit, donor_pairs=pairs)


def open_order_job(spark: SparkSession, paths: OpenOrderPaths, prm: OpenOrderParams, donor_pairs: Sequence[tuple],
                   target_path: str, warehouse_type: str = "string", partition: tuple[str, object] | None = None,
                   report: JobReport | None = None) -> DataFrame:
    """Entry 1 from paths to a written result, which is returned as read back.

    With ``partition`` (column, value) the job reads that partition of the quotas and replaces that
    partition of the target, as the original addresses them; the other partitions of both stay untouched.
    Raises if a contract's type differs, if the routes have more than one row a key, or if an alert
    or lookup has and multiplied order lines (counted as the result is written; the old result then stays).
    """
    apply_job_conf(spark)
    inp = read_open_order_inputs(spark, paths, donor_pairs, warehouse_type, partition)
    assert_unique(inp.transit, ["from2", "to4", "Tech"], "transit")
    lines = inp.lines
    by_order = lines.where(F.col("SalesOrderId").isNull()).limit(1).count() == 0  # the files' statistics answer it
    tasks = None
    if by_order:
        size = _bytes(spark, paths.lines)
        inp, tasks = replace(inp, lines=dealt_by(lines, "SalesOrderId", size, ORDER_BYTES)), tasks_for(spark, size, ORDER_BYTES)
    run_open_order_decisions(inp, prm, target_path, partition=partition, report=report, by_order=by_order, tasks=tasks)
    return read_snapshot(spark, target_path) if partition is None else read_partition(spark, target_path, *partition)


def _bytes(spark: SparkSession, path: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def files_for(spark: SparkSession, paths: DimensionPaths, file_bytes: int = FILE_BYTES) -> int:
    """A number of files that grows with the job: one for each ``file_bytes`` of its inputs, from which the
    result's size follows (at most a row for each version of a material)."""
    total = sum(_bytes(spark, getattr(paths, f.name)) for f in fields(paths))
    return max(1, -(-total // file_bytes))


def material_dimension_job_from(spark: SparkSession, paths: DimensionPaths, target_path: str,
                                files: int | None = None, **kw) -> DataFrame:
    """Entry 2 from paths to a written result, which is returned as read back.

    ``files`` bounds the result's files (see ``files_for``); by default nothing does.
    Raises if a contract's type differs, or if a lookup has more than one row a key and multiplied
    materials (counted as the result is written; the old result then stays).
    """
    apply_job_conf(spark)
    read = {"address": read_delta, "address_type": read_delta, "attr_history": read_history, "units": read_history}
    inp = DimensionInputs(**{f.name: read.get(f.name, read_snapshot)(spark, getattr(paths, f.name)) for f in fields(paths)})
    for name, types in DIMENSION_TYPES.items():
        assert_types(getattr(inp, name), types, name)
    run_material_dimension(inp, target_path, files, **kw)
    return read_snapshot(spark, target_path)
