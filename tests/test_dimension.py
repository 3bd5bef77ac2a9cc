"""Material dimension operators."""

import datetime as dt

import pytest

from quayside.operators import (active_sites, coded_text_lookup, material_dimension, normalize_units,
                                shipped_materials, unit_pivot, validity_interval)
from tests.conftest import rows

D = dt.date
LOG_DDL = "ID bigint, STAMP timestamp, `__PIPELINE_UNIX_TS__` bigint, REMOVEDATE date, PREFIX string"
ADDR_DDL = "ID bigint, STAMP timestamp, `__PIPELINE_UNIX_TS__` bigint, REMOVEDATE date, ADDRESSTYPEID bigint, SAPID string"
T = dt.datetime


def test_active_sites_latest_then_filter(spark):
    types = spark.createDataFrame([
        (1, T(2020, 1, 1), 1, None, "PLANT"),
        (2, T(2020, 1, 1), 1, None, "PLANT"), (2, T(2020, 2, 1), 2, D(2020, 2, 1), "PLANT"),   # latest deleted
        (3, T(2020, 1, 1), 1, None, "OFFICE"),
        (4, T(2020, 1, 1), 1, None, "OFFICE"), (4, T(2020, 1, 1), 2, None, "SHIPPING_POINT"),  # load stamp decides
    ], LOG_DDL)
    addr = spark.createDataFrame([
        (10, T(2020, 1, 1), 1, None, 1, "S10"), (11, T(2020, 1, 1), 1, None, 2, "S11"),
        (12, T(2020, 1, 1), 1, None, 3, "S12"), (13, T(2020, 1, 1), 1, None, 4, "S13"),
        (14, T(2020, 1, 1), 1, None, 9, "S14"),
        (15, T(2020, 1, 1), 1, None, 1, "S15"), (15, T(2020, 3, 1), 2, D(2020, 3, 1), 1, "S15"),
    ], ADDR_DDL)
    assert rows(active_sites(addr, types), "SAPID", "PREFIX") == [("S10", "PLANT"), ("S13", "SHIPPING_POINT")]


def test_shipped_materials_semi_join_by_document(spark):
    sites = spark.createDataFrame([("W1",)], "SAPID string")
    ships = spark.createDataFrame([
        (1, "a", "W1", "2020.01.05", D(2020, 1, 6)), (1, "b", "W2", "2020.01.05", None),    # b rides on doc 1
        (2, "c", "W2", "2020.01.05", D(2020, 1, 6)),                                       # no active site
        (3, "d", "W1", "2020.01.05", D(2019, 12, 31)),                                     # issued too early
        (4, "e", "W1", "bad", D(2020, 1, 6)),                                              # unparsable date
        (5, "f", "W1", "2019.12.28", D(2020, 1, 6)),                                       # created too early
        (6, "a", "W1", "2020.02.01", D(2020, 2, 2)),
    ], "VBELN bigint, MATNR string, WERKS string, ERDAT string, WADAT_IST date")
    assert rows(shipped_materials(ships, sites)) == [("a",), ("b",)]


def test_unit_pivot_latest_per_code(spark):
    u = spark.createDataFrame([
        ("m", "ST", D(2020, 1, 1), "6", "G", 1.0), ("m", "ST", D(2020, 2, 1), "12", "KG", 2.0),
        ("m", "SB", D(2020, 1, 1), "3", "G", 0.5), ("m", "PAL", D(2021, 1, 1), "99", "G", 9.0),
        ("n", "SB", D(2020, 1, 1), "4", "G", 0.1), ("n", "SB", D(2020, 1, 1), "5", "G", 0.1),   # tie -> larger
    ], "MATNR string, MEINH string, LOAD_DATE date, UMREN string, GEWEI string, ZZNTGEW double")
    got = {r["MATNR"]: (r["ST_UMREN"], r["ST_GEWEI"], r["SB_UMREN"]) for r in unit_pivot(u).collect()}
    assert got == {"m": ("12", "KG", "3"), "n": (None, None, "5")}


def test_normalize_units(spark):
    df = spark.createDataFrame([(u, 10.0) for u in ("MM", "M", "IN", "CM", None)], "MEABM string, LAENG double")
    got = {r["MEABM"]: r["LAENG_cm"] for r in normalize_units(df, dims=["LAENG"]).collect()}
    assert got == {"MM": 1.0, "M": 1000.0, "IN": 25.4, "CM": 10.0, None: 10.0}


def test_validity_interval_with_equal_dates(spark):
    df = spark.createDataFrame([("k", D(2020, 1, 1), 1), ("k", D(2020, 3, 1), 2), ("k", D(2020, 3, 1), 3),
                                ("j", D(2021, 1, 1), 1)], "key string, d date, tb int")
    got = rows(validity_interval(df, ["key"], "d", tie_break=["tb"]), "key", "tb", "StartDate", "EndDate")
    assert got == [("j", 1, D(2000, 1, 1), D(9999, 12, 31)), ("k", 1, D(2000, 1, 1), D(2020, 2, 29)),
                   ("k", 2, D(2020, 3, 1), D(2020, 2, 29)), ("k", 3, D(2020, 3, 1), D(9999, 12, 31))]


def test_validity_interval_without_dates(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", None, 2), ("k", D(2020, 3, 1), 3), ("j", None, 1)],
                               "key string, d date, tb int")
    got = rows(validity_interval(df, ["key"], "d", tie_break=["tb"]), "key", "tb", "StartDate", "EndDate")
    assert got == [("j", 1, D(2000, 1, 1), D(9999, 12, 31)), ("k", 1, D(2000, 1, 1), D(9999, 12, 31)),
                   ("k", 2, D(2000, 1, 1), D(2020, 2, 29)), ("k", 3, D(2000, 1, 1), D(9999, 12, 31))]
    with pytest.raises(ValueError):
        validity_interval(df, ["key"], "d", tie_break=[])


def test_coded_text_and_dimension_weights(spark):
    classes = spark.createDataFrame([("m", "T1"), ("n", "T9")], "MATNR_PK string, UDCTECH001 string")
    values = spark.createDataFrame([("T1", "Tech one")], "ATWRT_PK string, TEXT string")
    assert rows(coded_text_lookup(classes, values)) == [("m", "T1", "Tech one")]
    attr = spark.createDataFrame([
        ("m", D(2020, 1, 1), 1, D(2019, 5, 1), "Z", "ST", "FERT", "05", "S1", "B1", "U1", "MM", 100.0, 50.0, 10.0,
         "G", 500.0, 600.0),
        ("m", D(2021, 1, 1), 2, D(2020, 5, 1), "Z", "ST", "FERT", "05", "S1", "B1", "U1", "MM", 100.0, 50.0, 10.0,
         "G", 500.0, 600.0),
    ], "MATNR_PK string, LOAD_DATE date, DI_SEQUENCE_NUMBER int, LAEDA date, ZZREPMATNR string, MEINS string, "
       "MTART string, SPART string, ZZCLF02 string, ZZCLF03 string, ZZCLF20 string, MEABM string, LAENG double, "
       "BREIT double, HOEHE double, GEWEI string, NTGEW double, BRGEW double")
    units = spark.createDataFrame([("m", "ST", D(2020, 1, 1), "12", "KG", 0.25)],
                                  "MATNR string, MEINH string, LOAD_DATE date, UMREN string, GEWEI string, ZZNTGEW double")
    txt = spark.createDataFrame([("m", "EN", "desc"), ("m", "DE", "beschr")], "MATNR string, SPRAS string, TXTMD string")
    lk = spark.createDataFrame([("U1", "unit")], "CHRCOD string, VTEXT string")
    br = spark.createDataFrame([("B1", "brand")], "CHRCOD_PK string, VTEXT string")
    sg = spark.createDataFrame([("S1", "seg")], "CHRCOD_PK string, VTEXT string")
    shipped = spark.createDataFrame([("m",)], "MATNR string")
    r = material_dimension(attr, shipped, units, txt, lk, br, sg, classes, values, audit=False).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["Material_Description"], r["Brand_Name"], r["Segment_Name"], r["Technology_Name"]) == (
        "desc", "brand", "seg", "Tech one")
    assert (r["Material_NetWeight__UOM"], r["Material_PieceNetWeight__UOM"], r["Material_PC2Case"]) == (0.5, 250.0, 12)
    assert abs(r["Material_Volume__UOM"] - 10.0 * 5.0 * 1.0) < 1e-9
    assert (r["Material_StartDate__PK"], r["Material_EndDate"]) == (D(2000, 1, 1), D(9999, 12, 31))
