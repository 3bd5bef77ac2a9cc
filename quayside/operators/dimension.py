"""Material dimension.

All lookups join on the material number; the attribute relation is
partitioned on it by its deduplication window, so the chain of joins and
the final lag/lead window reuse that partitioning where the other side is
shuffled on the same key, and small text tables are broadcast by the planner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.units import grams_to_kg, kg_to_grams, length_cm
from ..sources.sinks import write_once
from .joins import broadcast_if_small
from .latest import latest_per_key
from .temporal import validity_interval


def change_log_order():
    """Change-log version order: stamp, then load stamp, latest first."""
    return [F.col("STAMP").desc(), F.col("__PIPELINE_UNIX_TS__").desc()]


def active_sites(address: DataFrame, address_type: DataFrame,
                 prefixes: Sequence[str] = ("PLANT", "SHIPPING_POINT")) -> DataFrame:
    """Latest address joined to its latest address type.

    Both change logs are cut to their latest version per ``ID`` first; only
    then are deleted versions and other prefixes dropped (a key whose latest
    version is deleted vanishes).
    """
    types = latest_per_key(address_type, ["ID"], change_log_order(),
                           keep=F.col("PREFIX").isin(*prefixes) & F.col("REMOVEDATE").isNull())
    addr = latest_per_key(address, ["ID"], change_log_order(), tie_break=["ADDRESSTYPEID", "SAPID", "REMOVEDATE"],
                          keep=F.col("REMOVEDATE").isNull())
    t = types.select(F.col("ID").alias("__type_id"), "PREFIX")
    return (addr.join(t, addr["ADDRESSTYPEID"] == t["__type_id"])
            .select("ID", "ADDRESSTYPEID", "SAPID", "PREFIX"))


def shipped_materials(shipments: DataFrame, sites: DataFrame, created_from: str = "2019-12-29",
                      issued_from: str = "2020-01-01", created_format: str = "yyyy.MM.dd") -> DataFrame:
    """Every material on any document that has an item issued from an active site.

    Items are those created on/after ``created_from`` (text dates parsed with
    ``try_to_date``: bad text is NULL and dropped).  The original finds the
    documents with an inner join, joins back and de-duplicates; that is a semi
    join followed by a distinct, written so here.  One plant can issue a large
    share of all items, so the site list is broadcast (after a size check)
    instead of shuffling the items on the plant.  The list is written once, so that
    the check and the join read it, and neither runs the change logs again.
    """
    items = shipments.where(F.try_to_date(F.col("ERDAT"), created_format) >= F.lit(created_from).cast("date"))
    site_ids = broadcast_if_small(write_once(sites.select(F.col("SAPID").alias("WERKS")).distinct(), "sites"))
    docs = (items.where(F.col("WADAT_IST") >= F.lit(issued_from).cast("date"))
            .join(site_ids, "WERKS", "left_semi")
            .select("VBELN"))
    return items.join(docs, "VBELN", "left_semi").select("MATNR").distinct()


def unit_pivot(units: DataFrame, codes: Sequence[str] = ("ST", "SB"),
               value_cols: Sequence[str] = ("UMREN", "GEWEI", "ZZNTGEW")) -> DataFrame:
    """Latest row per (material, unit code) as one column group per code.

    One aggregation on the material: for each code, ``max_by`` of the value
    columns ordered by (LOAD_DATE, values) among that code's rows — the latest
    load wins, equal loads fall back to the values, so the pick is total.
    Partial aggregation runs before the shuffle.
    """
    vals = F.struct(*[F.col(v) for v in value_cols])
    aggs = []
    for code in codes:
        ordering = F.when(F.col("MEINH") == code, F.struct(F.col("LOAD_DATE"), *[F.col(v) for v in value_cols]))
        aggs.append(F.max_by(vals, ordering).alias(f"__{code}"))
    piv = units.where(F.col("MEINH").isin(*codes)).groupBy("MATNR").agg(*aggs)
    return piv.select("MATNR", *[F.col(f"__{code}.{v}").alias(f"{code}_{v}") for code in codes for v in value_cols])


def normalize_units(df: DataFrame, dims: Sequence[str] = ("LAENG", "BREIT", "HOEHE"), unit_col: str = "MEABM"
                    ) -> DataFrame:
    """Add ``<dim>_cm`` for each length column."""
    return df.select("*", *[length_cm(d, unit_col).alias(f"{d}_cm") for d in dims])


def latest_attributes(attr_history: DataFrame) -> DataFrame:
    """L1i: latest load per material, ties broken by the change date."""
    return latest_per_key(attr_history, ["MATNR_PK"],
                          [F.col("LOAD_DATE").desc(), F.col("DI_SEQUENCE_NUMBER").desc()],
                          tie_break=[F.col("LAEDA").desc()])


def coded_text_lookup(classes: DataFrame, class_values: DataFrame) -> DataFrame:
    """Material class code joined to its text."""
    return (classes.join(class_values, class_values["ATWRT_PK"] == classes["UDCTECH001"])
            .select("MATNR_PK", "UDCTECH001", "TEXT"))


def material_dimension(attr_history: DataFrame, shipped: DataFrame, units: DataFrame, material_text: DataFrame,
                       uom_text: DataFrame, brand_text: DataFrame, segment_text: DataFrame, classes: DataFrame,
                       class_values: DataFrame, language: str = "EN", first: str = "2000-01-01",
                       last: str = "9999-12-31", audit: bool = True, history: bool = False, report=None) -> DataFrame:
    """One row per shipped material with texts, units, weights, volume, validity.

    The attribute history is cut to its latest load per material before the
    validity intervals are taken, so every interval is ``first`` .. ``last``;
    ``history=True`` keeps every load, with an interval each (Q14).  Intervals
    come from the loads alone, so a lookup that fans out repeats them.
    Weights in grams become kilograms, piece weights
    in kilograms become grams, the volume is the product of the lengths in cm.
    ``audit`` adds the load time (``current_timestamp``: one value a run).  A ``report``
    (``plans.checks.JobReport``) counts the rows after each lookup and the unit values that don't convert.
    """
    step = report.step if report is not None else lambda name, df, lookup=None, keys=(): df
    loads = normalize_units(attr_history if history else latest_attributes(attr_history))
    a = validity_interval(loads, ["MATNR_PK"], "LAEDA", ["LOAD_DATE", "DI_SEQUENCE_NUMBER"], first, last,
                          "__from", "__to").alias("a")
    s = shipped.select(F.col("MATNR").alias("__ship_mat")).alias("s")
    uom = uom_text.select(F.col("CHRCOD").alias("__uom_code"), F.col("VTEXT").alias("__uom_text"))
    u = unit_pivot(units).withColumnRenamed("MATNR", "__unit_mat")
    txt = material_text.where(F.col("SPRAS") == language).select(F.col("MATNR").alias("__txt_mat"), "TXTMD")
    brand = brand_text.select(F.col("CHRCOD_PK").alias("__brand_code"), F.col("VTEXT").alias("__brand_text"))
    cls = coded_text_lookup(classes, class_values).select(F.col("MATNR_PK").alias("__cls_mat"), "UDCTECH001", "TEXT")
    seg = segment_text.select(F.col("CHRCOD_PK").alias("__seg_code"), F.col("VTEXT").alias("__seg_text"))
    j = step("shipped materials", a.join(s, F.col("a.MATNR_PK") == F.col("s.__ship_mat")))
    for name, lookup, keys, on in (
            ("uom_text", uom, ["__uom_code"], F.col("__uom_code") == F.col("a.ZZCLF20")),
            ("units", u, ["__unit_mat"], F.col("__unit_mat") == F.col("a.MATNR_PK")),
            ("material_text", txt, ["__txt_mat"], F.col("__txt_mat") == F.col("a.MATNR_PK")),
            ("brand_text", brand, ["__brand_code"], F.col("__brand_code") == F.col("a.ZZCLF03")),
            ("classes", cls, ["__cls_mat"], F.col("__cls_mat") == F.col("a.MATNR_PK")),
            ("segment_text", seg, ["__seg_code"], F.col("__seg_code") == F.col("a.ZZCLF02"))):
        j = step(name, j.join(lookup, on, "left"), lookup, keys)
    pieces, show_boxes = (F.col(f"{unit}_UMREN").try_cast("int") for unit in ("ST", "SB"))
    if report is not None:
        j = report.casts(j, {"Material_PC2Case": (F.col("ST_UMREN"), pieces), "Material_ShowBox__UOM": (F.col("SB_UMREN"), show_boxes)})
    cols = [
        F.col("a.MATNR_PK").alias("Material_Code__PK"),
        F.col("a.ZZREPMATNR").alias("Material_ZREP"),
        F.col("__uom_text").alias("Material_UnitOfMeasure"),
        F.col("a.MEINS").alias("Material_BaseUnitOfMeasure"),
        pieces.alias("Material_PC2Case"),
        F.col("TXTMD").alias("Material_Description"),
        F.col("__brand_text").alias("Brand_Name"),
        F.col("TEXT").alias("Technology_Name"),
        F.col("__seg_text").alias("Segment_Name"),
        grams_to_kg(F.col("a.NTGEW"), F.col("a.GEWEI")).cast("float").alias("Material_NetWeight__UOM"),
        grams_to_kg(F.col("a.BRGEW"), F.col("a.GEWEI")).cast("float").alias("Material_GrossWeight__UOM"),
        (F.col("a.LAENG_cm") * F.col("a.BREIT_cm") * F.col("a.HOEHE_cm")).alias("Material_Volume__UOM"),
        F.col("a.MTART").alias("Material_Type"),
        F.col("a.SPART").alias("BusinessSegment_Code"),
        F.col("a.__from").alias("Material_StartDate__PK"),
        F.col("a.__to").alias("Material_EndDate"),
        show_boxes.alias("Material_ShowBox__UOM"),
        kg_to_grams(F.col("ST_ZZNTGEW"), F.col("ST_GEWEI")).cast("double").alias("Material_PieceNetWeight__UOM"),
        F.col("a.ZZCLF03").alias("Brand_Code"),
        F.col("UDCTECH001").alias("Tech_Code"),
    ]
    if audit:
        cols.append(F.current_timestamp().alias("_Update_DTTM"))
    return j.select(*cols)
