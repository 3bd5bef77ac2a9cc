"""DuckDB oracle SQL for every registered query.

Written directly from the semantics of the original jobs (windows, range
joins, correlated subqueries as SQL expresses them), not from the Spark
plans: e.g. the demand projection joins every calendar day, the as-of join
is a correlated ``MIN``, order-level shares are group-and-join.  The test
tables are pre-registered views; the binding of ``plans/binding.py`` is
re-stated here as CTEs.
"""

from __future__ import annotations

from ..functions import texts
from . import params as P


def s(text: str) -> str:
    """A Python string as a DuckDB string expression (newlines via chr(10))."""
    parts = [("'" + p.replace("'", "''") + "'") for p in text.split("\n")]
    return " || chr(10) || ".join(parts) if len(parts) > 1 else parts[0]


def exact(x: str, over: str = "") -> str:
    """The sum of doubles through their shortest decimals, so that the order of rows does not matter."""
    return f"CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 15))) {over} AS DOUBLE)"


AS_OF = f"DATE '{P.AS_OF}'"
WH = ", ".join(str(w) for w in P.WAREHOUSES)
PAIRS = ", ".join(f"({a}, {b})" for a, b in P.DONOR_PAIRS)
DRY = ", ".join(f"'{x}'" for x in P.DRY_BRANDS)
PREFIXES = ", ".join(f"'{x}'" for x in P.SITE_PREFIXES)


def fiscal(d: str) -> dict[str, str]:
    """Rule-based fiscal labels of a DATE expression: 13 x 28-day periods, 7-day weeks."""
    doy0 = f"(dayofyear({d}) - 1)"
    p = f"LEAST(CAST(FLOOR({doy0} / 28.0) AS INTEGER) + 1, 13)"
    w = f"(CAST(FLOOR(({doy0} - ({p} - 1) * 28) / 7.0) AS INTEGER) + 1)"
    y = f"CAST(year({d}) AS INTEGER)"
    return {
        "year": y, "period": p, "week": w,
        "week_full": f"(CAST({y} AS VARCHAR) || ' P' || CAST({p} AS VARCHAR) || ' W' || CAST({w} AS VARCHAR))",
        "week_key": f"(CAST({y} AS VARCHAR) || 'P' || lpad(CAST({p} AS VARCHAR), 2, '0') || 'W' || CAST({w} AS VARCHAR))",
    }


PLANNED = "CAST(l.l_shipdate AS DATE)"
FP = fiscal(PLANNED)
FNEXT = fiscal(f"({PLANNED} + 7)")
CONFIRMED = "ROUND(l.l_quantity * (1 - 10 * l.l_discount), 2)"

CTES: dict[str, tuple[list[str], str]] = {
    "sr": ([], """SELECT s.s_suppkey, s.s_nationkey, s.s_name, n.n_regionkey, n.n_name
               FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    "lr": (["sr"], "SELECT l.*, sr.s_nationkey, sr.s_name, sr.n_regionkey, sr.n_name FROM lineitem l JOIN sr ON l.l_suppkey = sr.s_suppkey"),
    "ol": (["lr"], f"""
        SELECT l.l_orderkey AS SalesOrderId, l.l_linenumber AS PositionNumber, l.l_orderkey AS PurchaseOrderId,
               CAST(l.l_partkey AS VARCHAR) AS Material, o.o_custkey AS Customer, c.c_nationkey AS SoldTo,
               l.n_regionkey AS MarsDc, {PLANNED} AS FactPlanBillingDate,
               CAST(o.o_orderdate AS DATE) AS OrderProcessingDate, CAST(o.o_orderdate AS DATE) AS OrderCreationDate,
               {PLANNED} AS RequestedDeliveryDate,
               l.l_quantity AS CsOrdered, {CONFIRMED} AS CsConfirmed,
               {CONFIRMED} / NULLIF(l.l_quantity, 0) AS CsPreSl,
               l.l_quantity - {CONFIRMED} AS CsPreUnderdeliver,
               ROUND(10 * l.l_discount, 2) AS SlicePallet, l.l_quantity - {CONFIRMED} AS SliceCase,
               l.l_discount >= 0.05 AS SliceFlag,
               l.l_quantity - {CONFIRMED} AS CUT_QTY_PALLET, l.l_quantity AS AGREED_ORDEREDQTY_PALLET,
               CASE WHEN o.o_orderpriority = '1-URGENT' THEN TRUE WHEN o.o_orderpriority = '2-HIGH' THEN FALSE END AS Allocation,
               CASE WHEN l.l_returnflag = 'R' THEN 0.0 ELSE l.l_tax * 100 END AS AllocationAvailable,
               CASE WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'O' THEN 'Yes' ELSE 'No' END AS Discontinue,
               {FP['week_full']} AS MarsWeekFullName, {FP['period']} AS MarsWeekRollingNum,
               CAST(dayofyear({PLANNED}) AS INTEGER) AS MarsDay,
               CAST(o.o_custkey AS VARCHAR) || '-' || CAST(l.l_partkey AS VARCHAR) AS CustomerProductId,
               o.o_orderstatus AS Division, l.s_name AS CustomerDc, CAST(l.s_nationkey AS VARCHAR) AS CustomerDcCode,
               l.n_name AS Region, CASE WHEN l.l_linestatus = 'F' THEN 'Dry' END AS Technology,
               l.l_extendedprice AS LsvOrdered, l.l_extendedprice * (1 - 10 * l.l_discount) AS LsvConfirmed,
               {CONFIRMED} / NULLIF(l.l_quantity, 0) AS LsvPreSl,
               l.l_extendedprice - l.l_extendedprice * (1 - 10 * l.l_discount) AS LsvPreUnderdeliver,
               12 * l.l_quantity AS UnitsOrdered, 12 * {CONFIRMED} AS UnitsConfirmed,
               {CONFIRMED} / NULLIF(l.l_quantity, 0) AS UnitsPreSl,
               12 * l.l_quantity - 12 * {CONFIRMED} AS UnitsPreUnderdeliver,
               'Z' || CAST(l.l_partkey AS VARCHAR) AS Zrep, 'Material ' || CAST(l.l_partkey AS VARCHAR) AS MaterialDescription,
               o.o_orderstatus AS Status, l.l_linestatus = 'F' AS Delivery, l.l_discount > 0 AS Slices,
               l.l_tax * l.l_quantity AS TMSWeighted, 1 - l.l_tax AS PerformanceClient,
               1 - l.l_discount AS PerformanceCountry, l.l_tax + l.l_discount AS PerformanceClientPlant,
               1 - 10 * l.l_discount AS CaseFillClient, l.l_discount AS CaseFillCountry,
               l.l_tax AS SFAClient, l.l_returnflag || l.l_linestatus AS CurrentStatus
        FROM lr l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey"""),
    "soh": ([], """
        SELECT l.l_orderkey AS SALESORDERID, l.l_linenumber AS POSITION_NUMBER,
               CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'DELETED'
                    WHEN l.l_returnflag = 'R' THEN 'GOOD' WHEN l.l_returnflag = 'A' THEN 'LATE' END AS REJECTIONREASON_TYPE,
               CASE o.o_orderstatus WHEN 'O' THEN 'ZOR' WHEN 'F' THEN 'ZIC1' ELSE 'ZRE' END AS SALESORDERTYPE,
               l.l_linestatus = 'F' AS GISTATUS
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "soh_open": (["soh"], """
        SELECT * FROM soh
        WHERE (REJECTIONREASON_TYPE NOT IN ('GOOD', 'DELETED') OR REJECTIONREASON_TYPE IS NULL)
          AND SALESORDERTYPE IN ('ZIC1', 'ZOR') AND NOT GISTATUS"""),
    "items": ([], f"""
        SELECT l.l_orderkey AS VBELN, l.l_linenumber AS POSNR, '000' || CAST(l.l_partkey AS VARCHAR) AS MATNR,
               {P.SALES_ORG} AS VKORG, CASE WHEN p.p_type = 'PROMO' THEN 9 ELSE {P.DIVISION_CODE} END AS SPART,
               l.l_orderkey AS BSTNK, l.l_quantity AS KWMENG, 1.0 AS UMVKZ,
               CASE WHEN l.l_tax = 0 THEN 0.0 ELSE 1.0 END AS UMVKN,
               CASE WHEN l.l_returnflag = 'R' THEN -l.l_extendedprice ELSE l.l_extendedprice END AS KZWI3,
               p.p_retailprice AS NETPR
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""),
    "mat_src": ([], """
        SELECT CAST(p_partkey AS VARCHAR) AS MATERIAL, CAST(p_partkey AS VARCHAR) AS MATNR,
               CASE WHEN v = 0 THEN DATE '1990-01-01' ELSE DATE '1995-01-01' END AS START_DATE,
               CASE WHEN v = 1 THEN DATE '1995-02-01' END AS VMSTD, DATE '1990-01-01' + v AS "0CREATEDON",
               CASE WHEN p_type = 'SMALL' THEN '2' WHEN p_type = 'LARGE' THEN NULL ELSE '1' END AS UOM_PC2Case,
               p_brand AS Brand,
               CASE p_type WHEN 'ECONOMY' THEN 'Dry' WHEN 'SMALL' THEN 'Care & Treats' WHEN 'LARGE' THEN 'Pouch'
                           WHEN 'PROMO' THEN NULL ELSE p_type END AS Technology
        FROM (SELECT p_partkey, CAST(v AS INTEGER) AS v, CASE WHEN v = 1 THEN p_type ELSE 'SMALL' END AS p_type,
                     CASE WHEN v = 1 THEN p_brand ELSE 'old' END AS p_brand
              FROM part, (VALUES (0), (1), (2)) n(v) WHERE v < 2 OR p_size % 3 = 0)"""),
    "mat": (["mat_src"], f"""
        SELECT MATERIAL, MATNR, Brand, Technology, TRY_CAST(UOM_PC2Case AS INTEGER) AS UOM_PC2Case,
               CASE WHEN Brand IN ({DRY}) THEN 'DRY' WHEN Technology = 'Dry' THEN 'DRY'
                    WHEN Technology = 'Care & Treats' THEN 'DRY' WHEN Technology = 'Pouch' THEN 'WET'
                    WHEN Technology IS NULL THEN NULL ELSE 'Others' END AS Tech
        FROM mat_src
        QUALIFY row_number() OVER (PARTITION BY MATERIAL ORDER BY START_DATE DESC NULLS LAST, VMSTD DESC NULLS LAST,
                                   "0CREATEDON" DESC NULLS LAST, MATNR) = 1"""),
    "pf": (["items", "soh_open", "mat"], f"""
        SELECT MATERIAL_CODE, BSTNK AS PurchaseOrderId, MAX(CASE WHEN diff > {P.PRICE_TOLERANCE} THEN 1 ELSE 0 END)
                 AS FlagPriceDisagreement, {s(texts.PRICE_ALERT)} AS AlertPriceDisagreement
        FROM (SELECT i.MATERIAL_CODE, i.BSTNK,
                     ROUND(ABS(ABS(i.KZWI3) / NULLIF(ABS(i.KWMENG * i.UMVKZ / NULLIF(i.UMVKN, 0)), 0)
                               / NULLIF(COALESCE(m.UOM_PC2Case, 1), 0) - ABS(i.NETPR)), 4) AS diff
              FROM (SELECT *, regexp_replace(MATNR, '^0*', '') AS MATERIAL_CODE FROM items
                    WHERE VKORG = {P.SALES_ORG} AND SPART = {P.DIVISION_CODE}) i
              JOIN soh_open so ON so.SALESORDERID = i.VBELN AND so.POSITION_NUMBER = i.POSNR
              LEFT JOIN mat m ON i.MATERIAL_CODE = m.MATERIAL) x
        GROUP BY MATERIAL_CODE, BSTNK
        HAVING MAX(CASE WHEN diff > {P.PRICE_TOLERANCE} THEN 1 ELSE 0 END) = 1"""),
    "flagged": (["ol", "pf"], """
        SELECT ol.*, pf.FlagPriceDisagreement, pf.AlertPriceDisagreement
        FROM ol LEFT JOIN pf ON ol.Material = pf.MATERIAL_CODE AND ol.PurchaseOrderId = pf.PurchaseOrderId"""),
    "cal": ([], f"""
        SELECT d AS OriginalDate, {fiscal('d')['year']} AS MarsYear, {fiscal('d')['period']} AS MarsPeriod,
               'P' || CAST({fiscal('d')['period']} AS VARCHAR) AS MarsPeriodName,
               CAST({fiscal('d')['year']} AS VARCHAR) || ' P' || CAST({fiscal('d')['period']} AS VARCHAR) AS MarsPeriodFullName,
               'W' || CAST({fiscal('d')['week']} AS VARCHAR) AS MarsWeekName,
               {fiscal('d')['week_key']} AS week_key
        FROM (SELECT CAST(unnest(generate_series(CAST(mn AS TIMESTAMP), CAST(mx AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT MIN(CAST(l_shipdate AS DATE)) AS mn,
                           MAX(CAST(l_shipdate AS DATE)) + {P.CALENDAR_MARGIN_DAYS} AS mx FROM lineitem))"""),
    "ps": (["cal"], f"""
        SELECT MIN(OriginalDate) AS FirstDateCurrentPeriod FROM cal
        WHERE MarsPeriodFullName IN (SELECT MarsPeriodFullName FROM cal WHERE OriginalDate = {AS_OF})"""),
    "targets": (["flagged"], f"""
        SELECT f.SalesOrderId, f.MarsDc, f.FactPlanBillingDate, f.CsOrdered, f.CsConfirmed, f.Material, f.Customer,
               f.MarsWeekFullName
        FROM flagged f
        JOIN (SELECT SalesOrderId, AVG(CASE WHEN CsPreSl < 1 THEN 0 ELSE 1 END) AS svc,
                     COALESCE({exact("CASE WHEN (Allocation IS NULL OR AllocationAvailable = 0) AND FlagPriceDisagreement IS NULL THEN CUT_QTY_PALLET END")}
                              / NULLIF({exact("AGREED_ORDEREDQTY_PALLET")}, 0), 0) AS share
              FROM flagged GROUP BY SalesOrderId) a ON a.SalesOrderId = f.SalesOrderId
        WHERE a.svc < 1 AND f.MarsDc IN ({WH}) AND f.OrderProcessingDate <= {AS_OF} + 5 AND a.share >= 0.3"""),
    "st": (["lr"], f"""
        SELECT l.n_regionkey AS WAREHOUSE, CAST(l.l_partkey AS VARCHAR) AS MATERIAL_CODE, {PLANNED} AS DAY,
               CAST(1 + l.l_linenumber AS DOUBLE) AS TMS, 2 * l.l_quantity AS FREE_STOCK
        FROM lr l"""),
    "ls": (["st"], """
        SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY WAREHOUSE, MATERIAL_CODE
                                                   ORDER BY DAY DESC, FREE_STOCK DESC, TMS DESC) = 1"""),
    "fc": (["lr"], f"""
        SELECT l.n_regionkey AS PLANT, CAST(l.l_partkey AS VARCHAR) AS MATERIAL_CODE, {FNEXT['week_key']} AS MARS_WEEK,
               {PLANNED} - 91 AS F_STARTDATE, {PLANNED} + 28 AS F_ENDDATE, l.l_quantity AS FORECAST_CASES
        FROM lr l"""),
    "demand": (["ls", "cal", "fc"], """
        SELECT WAREHOUSE, MATERIAL_CODE, DAY, TMS, FREE_STOCK, SUM(fcd) AS total, SUM(fcd) / 56 AS per_day
        FROM (SELECT d.WAREHOUSE, d.MATERIAL_CODE, d.DAY, d.TMS, d.FREE_STOCK, d.OriginalDate,
                     COALESCE(SUM(f.FORECAST_CASES / 7), 0) AS fcd
              FROM (SELECT ls.*, c.OriginalDate, c.week_key FROM ls
                    JOIN cal c ON c.OriginalDate BETWEEN ls.DAY AND ls.DAY + 56) d
              LEFT JOIN fc f ON d.WAREHOUSE = f.PLANT AND d.MATERIAL_CODE = f.MATERIAL_CODE
                            AND d.week_key = f.MARS_WEEK AND d.DAY BETWEEN f.F_STARTDATE AND f.F_ENDDATE - 1
              GROUP BY 1, 2, 3, 4, 5, 6) x
        GROUP BY 1, 2, 3, 4, 5"""),
    "pairs": ([], f"SELECT * FROM (VALUES {PAIRS}) p(SourcePlant, DonorPlant)"),
    "cov": (["targets", "pairs", "demand"], """
        SELECT e.*, d.TMS, d.FREE_STOCK, d.per_day,
               CASE WHEN ((d.FREE_STOCK - e.CsOrdered) / NULLIF(d.per_day, 0)) / NULLIF(d.TMS, 0) >= 0.5
                    THEN 1 ELSE 0 END AS AlertForGRD
        FROM (SELECT t.*, p.DonorPlant FROM targets t LEFT JOIN pairs p ON t.MarsDc = p.SourcePlant) e
        LEFT JOIN demand d ON d.WAREHOUSE = e.DonorPlant AND d.MATERIAL_CODE = e.Material"""),
    "feas": (["cov"], f"""
        SELECT c5.*, {exact("CsConfirmed", "OVER (PARTITION BY SalesOrderId)")}
                     / NULLIF({exact("CsOrdered", "OVER (PARTITION BY SalesOrderId)")}, 0) AS CsPreSlSalesOrder
        FROM (SELECT c3.*, COUNT(c3.Material) OVER (PARTITION BY c3.SalesOrderId, c3.DonorPlant) AS cd, u.cu
              FROM (SELECT * FROM (SELECT c1.*, COUNT(Material) OVER (PARTITION BY SalesOrderId) AS cnt,
                                          SUM(anyA) OVER (PARTITION BY SalesOrderId) AS sm
                                   FROM (SELECT cov.*, MAX(AlertForGRD) OVER (PARTITION BY SalesOrderId, Material) AS anyA
                                         FROM cov) c1) c2
                    WHERE sm = cnt AND AlertForGRD = 1) c3
              JOIN (SELECT SalesOrderId, COUNT(DISTINCT Material) AS cu
                    FROM (SELECT * FROM (SELECT c1.*, COUNT(Material) OVER (PARTITION BY SalesOrderId) AS cnt,
                                                SUM(anyA) OVER (PARTITION BY SalesOrderId) AS sm
                                         FROM (SELECT cov.*, MAX(AlertForGRD) OVER (PARTITION BY SalesOrderId, Material) AS anyA
                                               FROM cov) c1) c2
                          WHERE sm = cnt AND AlertForGRD = 1) c3b
                    GROUP BY SalesOrderId) u ON u.SalesOrderId = c3.SalesOrderId) c5
        WHERE cd = cu"""),
    "bd": (["feas"], f"""
        SELECT SalesOrderId,
               {s(texts.DONOR_PARTS[0])} || donors || {s(texts.DONOR_PARTS[1])}
               || CAST(CAST(ROUND((1 - CsPreSlSalesOrder) * 100, 0) AS INTEGER) AS VARCHAR) || {s(texts.DONOR_PARTS[2])}
               AS Alert, 6 AS AlertPriority
        FROM (SELECT SalesOrderId, CsPreSlSalesOrder,
                     string_agg(CAST(DonorPlant AS VARCHAR), {s(texts.DONOR_SEPARATOR)} ORDER BY CAST(DonorPlant AS VARCHAR))
                       AS donors
              FROM (SELECT * FROM (SELECT SalesOrderId, CsPreSlSalesOrder, MarsDc, DonorPlant, COUNT(*) AS n
                                   FROM (SELECT * FROM feas QUALIFY row_number() OVER (
                                             PARTITION BY SalesOrderId, Material
                                             ORDER BY FREE_STOCK DESC NULLS LAST, DonorPlant ASC, MarsDc ASC) = 1)
                                   GROUP BY 1, 2, 3, 4)
                    QUALIFY dense_rank() OVER (PARTITION BY SalesOrderId ORDER BY n DESC) = 1)
              GROUP BY 1, 2)"""),
    "tr": (["lr"], f"""
        SELECT CASE WHEN l.l_returnflag = 'R' THEN 'Other' ELSE '{P.TRANSPORT_DIVISION}' END AS Division,
               {PLANNED} AS Delivery_ActualGI__DTTM, CAST(l.l_partkey AS VARCHAR) AS GRD,
               l.s_nationkey AS Delivery_LocationFrom__FK, l.n_regionkey AS Delivery_LocationTo__FK,
               l.l_quantity AS GoodsIssue_Qty__CS
        FROM lr l"""),
    "transit": ([], """
        SELECT n.n_nationkey AS from2, n.n_regionkey AS to4, t.Tech,
               CAST(1 + n.n_nationkey % 7 + CASE WHEN t.Tech = 'WET' THEN 2 ELSE 0 END AS VARCHAR) AS TransitQIdays
        FROM nation n, (VALUES ('DRY'), ('WET')) t(Tech)"""),
    "arr": (["tr", "ps", "mat", "transit"], f"""
        SELECT sh.Delivery_ActualGI__DTTM, sh.GRD, sh.Delivery_LocationFrom__FK, sh.Delivery_LocationTo__FK,
               sh.Delivery_ActualGI__DTTM + CAST(t.TransitQIdays AS INTEGER) AS TransitDate
        FROM (SELECT DISTINCT Delivery_ActualGI__DTTM, GRD, Delivery_LocationFrom__FK, Delivery_LocationTo__FK
              FROM tr WHERE Division = '{P.TRANSPORT_DIVISION}'
                AND Delivery_ActualGI__DTTM >= (SELECT FirstDateCurrentPeriod FROM ps)) sh
        JOIN mat m ON sh.GRD = m.MATNR
        JOIN transit t ON sh.Delivery_LocationFrom__FK = t.from2 AND sh.Delivery_LocationTo__FK = t.to4
                      AND m.Tech = t.Tech"""),
    "sa": (["ol", "arr"], f"""
        SELECT SalesOrderId, Material, FactPlanBillingDate, PositionNumber, MarsDc,
               CASE WHEN TransitDate IS NOT NULL
                    THEN {s(texts.RESTOCK_FOUND[0])} || CAST(TransitDate AS VARCHAR) || {s(texts.RESTOCK_FOUND[1])}
                    ELSE {s(texts.RESTOCK_NOT_FOUND)} END AS Alert,
               5 AS AlertPriority
        FROM (SELECT c.*, (SELECT MIN(a.TransitDate) FROM arr a
                           WHERE a.GRD = c.Material AND a.Delivery_LocationTo__FK = c.MarsDc
                             AND a.TransitDate > c.FactPlanBillingDate) AS TransitDate
              FROM (SELECT SalesOrderId, PositionNumber, Material, MarsDc, FactPlanBillingDate FROM ol
                    WHERE CsPreSl < 1 AND Discontinue = 'No' AND SlicePallet >= 0.1
                      AND OrderProcessingDate <= {AS_OF} + 3) c) j
        QUALIFY row_number() OVER (PARTITION BY SalesOrderId, PositionNumber
                                   ORDER BY TransitDate ASC NULLS FIRST, Material, MarsDc, FactPlanBillingDate) = 1"""),
    "quotas": ([], """
        SELECT Material, Customer, ForecastVersionStartDate,
               COALESCE(LEAD(ForecastVersionStartDate) OVER (PARTITION BY Material, Customer
                                                             ORDER BY ForecastVersionStartDate),
                        DATE '9999-12-31') AS ForecastVersionEndDate,
               CAST(qty AS BIGINT) - 30 AS RemainingUnconfirmedQuota, 'lines: ' || CAST(n AS VARCHAR) AS Summary
        FROM (SELECT CAST(l.l_partkey AS VARCHAR) AS Material, o.o_custkey AS Customer,
                     CAST(o.o_orderdate AS DATE) AS ForecastVersionStartDate, SUM(l.l_quantity) AS qty, COUNT(*) AS n
              FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2, 3)"""),
    "qa": (["quotas"], f"""
        SELECT RemainingUnconfirmedQuota, Material AS Alert4_Material, Customer AS Alert4_Customer, Summary,
               {s(texts.QUOTA_PARTS[0])} || CAST(RemainingUnconfirmedQuota AS VARCHAR) || {s(texts.QUOTA_PARTS[1])}
               || {s(texts.QUOTA_PARTS[2])} || Summary || {s(texts.QUOTA_PARTS[3])} AS Alert,
               4 AS AlertPriority
        FROM quotas
        WHERE ForecastVersionStartDate <= {AS_OF} AND ForecastVersionEndDate > {AS_OF}
          AND RemainingUnconfirmedQuota > 0"""),
    "lastline": (["ol"], """
        SELECT * FROM ol QUALIFY row_number() OVER (PARTITION BY SalesOrderId, Material, SoldTo
                                                   ORDER BY FactPlanBillingDate DESC NULLS LAST, PositionNumber ASC,
                                                            CsConfirmed DESC) = 1"""),
    "lo": (["lastline"], f"""
        SELECT a.SalesOrderId AS A_SalesOrderId, a.Material AS A_Material, a.SoldTo AS A_SoldTo,
               {s(texts.LATER_ORDER_HEADER)} || {s(texts.LATER_ORDER_SEPARATOR)}
               || string_agg(CAST(t.SalesOrderId AS VARCHAR) || ' (' || CAST(CAST(TRUNC(t.CsConfirmed) AS INTEGER) AS VARCHAR)
                             || ' cases)', {s(texts.LATER_ORDER_SEPARATOR)}
                             ORDER BY CAST(t.SalesOrderId AS VARCHAR) || ' (' || CAST(CAST(TRUNC(t.CsConfirmed) AS INTEGER) AS VARCHAR)
                             || ' cases)')
               || {s(texts.LATER_ORDER_SEPARATOR)} || {s(texts.LATER_ORDER_TRAILER)} AS Alert,
               3 AS AlertPriority
        FROM (SELECT * FROM lastline WHERE Allocation = TRUE AND CsConfirmed = 0
                                       AND OrderProcessingDate >= {AS_OF} - {P.LATER_BACK}) a
        JOIN (SELECT * FROM lastline WHERE FactPlanBillingDate > {AS_OF} + 4 AND CsConfirmed > 0) t
          ON a.SoldTo = t.SoldTo AND a.Material = t.Material AND a.SalesOrderId <> t.SalesOrderId
         AND a.OrderCreationDate >= t.OrderCreationDate AND a.FactPlanBillingDate + 1 < t.FactPlanBillingDate
        GROUP BY 1, 2, 3"""),
    "dec": (["flagged", "sa", "lo", "qa", "mat"], f"""
        SELECT f.*, COALESCE(f.FlagPriceDisagreement, 0) AS FlagFinal,
               COALESCE(f.FlagPriceDisagreement, CASE WHEN f.Discontinue = 'Yes' THEN 2 END, lo.AlertPriority,
                        qa.AlertPriority, sa.AlertPriority, 0) AS Decision,
               COALESCE(f.AlertPriceDisagreement, '')
               || CASE WHEN f.Discontinue = 'Yes' THEN {s(texts.DISCONTINUED_ALERT)} ELSE '' END
               || COALESCE(lo.Alert, '') || COALESCE(qa.Alert, '') || COALESCE(sa.Alert, '') AS DecisionDescription,
               m.Brand
        FROM flagged f
        LEFT JOIN sa ON f.Material = sa.Material AND f.PositionNumber = sa.PositionNumber AND f.MarsDc = sa.MarsDc
                    AND f.SalesOrderId = sa.SalesOrderId
        LEFT JOIN lo ON f.SalesOrderId = lo.A_SalesOrderId AND f.Material = lo.A_Material AND f.SoldTo = lo.A_SoldTo
        LEFT JOIN qa ON f.Allocation = TRUE AND f.AllocationAvailable = 0 AND f.Material = qa.Alert4_Material
                    AND f.Customer = qa.Alert4_Customer
        LEFT JOIN mat m ON f.Material = m.MATERIAL"""),
    # -- material dimension --
    "addr_type": ([], """
        SELECT user_id AS ID, ts AS STAMP, event_id AS PIPE,
               CASE WHEN event_type = 'error' THEN CAST(ts AS DATE) END AS REMOVEDATE, event_type AS PREFIX
        FROM events"""),
    "addr": ([], """
        SELECT user_id AS ID, ts AS STAMP, event_id AS PIPE,
               CASE WHEN event_type = 'error' THEN CAST(ts AS DATE) END AS REMOVEDATE,
               TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) AS ADDRESSTYPEID,
               CAST(user_id AS VARCHAR) AS SAPID
        FROM events"""),
    "sites": (["addr", "addr_type"], f"""
        SELECT a.ID, a.ADDRESSTYPEID, a.SAPID, t.PREFIX
        FROM (SELECT * FROM addr QUALIFY row_number() OVER (PARTITION BY ID ORDER BY STAMP DESC, PIPE DESC) = 1) a
        JOIN (SELECT * FROM addr_type QUALIFY row_number() OVER (PARTITION BY ID ORDER BY STAMP DESC, PIPE DESC) = 1) t
          ON a.ADDRESSTYPEID = t.ID
        WHERE a.REMOVEDATE IS NULL AND t.REMOVEDATE IS NULL AND t.PREFIX IN ({PREFIXES})"""),
    "ship": ([], """
        SELECT l.l_orderkey AS VBELN, CAST(l.l_partkey AS VARCHAR) AS MATNR, CAST(l.l_suppkey AS VARCHAR) AS WERKS,
               strftime(o.o_orderdate, '%Y.%m.%d') AS ERDAT, CAST(l.l_shipdate AS DATE) AS WADAT_IST
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "shipped": (["ship", "sites"], f"""
        SELECT DISTINCT i.MATNR
        FROM (SELECT * FROM ship WHERE CAST(try_strptime(ERDAT, '%Y.%m.%d') AS DATE) >= DATE '{P.CREATED_FROM}') i
        JOIN (SELECT DISTINCT x.VBELN
              FROM (SELECT * FROM ship WHERE CAST(try_strptime(ERDAT, '%Y.%m.%d') AS DATE) >= DATE '{P.CREATED_FROM}') x
              JOIN sites ON sites.SAPID = x.WERKS
              WHERE x.WADAT_IST >= DATE '{P.ISSUED_FROM}') dd ON i.VBELN = dd.VBELN"""),
    "units": ([], """
        SELECT CAST(l_partkey AS VARCHAR) AS MATNR,
               CASE l_returnflag WHEN 'A' THEN 'ST' WHEN 'R' THEN 'SB' ELSE 'PAL' END AS MEINH,
               CAST(l_shipdate AS DATE) AS LOAD_DATE, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS UMREN,
               CASE WHEN l_linestatus = 'F' THEN 'KG' ELSE 'G' END AS GEWEI, l_tax * 100 AS ZZNTGEW
        FROM lineitem"""),
    "up": (["units"], """
        SELECT MATNR,
               MAX(CASE WHEN MEINH = 'ST' THEN UMREN END) AS ST_UMREN,
               MAX(CASE WHEN MEINH = 'ST' THEN GEWEI END) AS ST_GEWEI,
               MAX(CASE WHEN MEINH = 'ST' THEN ZZNTGEW END) AS ST_ZZNTGEW,
               MAX(CASE WHEN MEINH = 'SB' THEN UMREN END) AS SB_UMREN,
               MAX(CASE WHEN MEINH = 'SB' THEN GEWEI END) AS SB_GEWEI,
               MAX(CASE WHEN MEINH = 'SB' THEN ZZNTGEW END) AS SB_ZZNTGEW
        FROM (SELECT * FROM units WHERE MEINH IN ('ST', 'SB')
              QUALIFY row_number() OVER (PARTITION BY MATNR, MEINH
                                         ORDER BY LOAD_DATE DESC NULLS LAST, UMREN DESC NULLS LAST,
                                                  GEWEI DESC NULLS LAST, ZZNTGEW DESC NULLS LAST) = 1)
        GROUP BY MATNR"""),
    "ah": ([], """
        SELECT CAST(p.p_partkey AS VARCHAR) AS MATNR_PK, make_date(g.y, 12, 31) AS LOAD_DATE, g.DI_SEQUENCE_NUMBER,
               g.LAEDA, 'Z' || CAST(p.p_partkey AS VARCHAR) AS ZZREPMATNR, split_part(p.p_name, ' ', 2) AS MEINS,
               p.p_type AS MTART, CAST(p.p_size AS VARCHAR) AS SPART, p.p_type AS ZZCLF02, p.p_brand AS ZZCLF03,
               split_part(p.p_name, ' ', 1) AS ZZCLF20,
               CASE p.p_type WHEN 'ECONOMY' THEN 'MM' WHEN 'LARGE' THEN 'M' WHEN 'SMALL' THEN 'IN'
                             WHEN 'MEDIUM' THEN 'CM' END AS MEABM,
               CAST(p.p_size AS DOUBLE) AS LAENG, p.p_retailprice / 100 AS BREIT,
               CAST(length(p.p_name) AS DOUBLE) AS HOEHE,
               CASE WHEN p.p_size > 25 THEN 'KG' ELSE 'G' END AS GEWEI, p.p_retailprice AS NTGEW,
               p.p_retailprice + p.p_size AS BRGEW
        FROM (SELECT l_partkey, year(l_shipdate) AS y, MIN(CAST(l_shipdate AS DATE)) AS LAEDA,
                     COUNT(*) AS DI_SEQUENCE_NUMBER
              FROM lineitem GROUP BY 1, 2) g
        JOIN part p ON g.l_partkey = p.p_partkey"""),
    "an_all": (["ah"], """
        SELECT *,
               CASE MEABM WHEN 'MM' THEN LAENG / 10 WHEN 'M' THEN LAENG * 100 WHEN 'IN' THEN LAENG * 2.54 ELSE LAENG END AS LAENG_cm,
               CASE MEABM WHEN 'MM' THEN BREIT / 10 WHEN 'M' THEN BREIT * 100 WHEN 'IN' THEN BREIT * 2.54 ELSE BREIT END AS BREIT_cm,
               CASE MEABM WHEN 'MM' THEN HOEHE / 10 WHEN 'M' THEN HOEHE * 100 WHEN 'IN' THEN HOEHE * 2.54 ELSE HOEHE END AS HOEHE_cm
        FROM ah"""),
    "an": (["an_all"], """
        SELECT * FROM an_all
        QUALIFY row_number() OVER (PARTITION BY MATNR_PK ORDER BY LOAD_DATE DESC NULLS LAST,
                                   DI_SEQUENCE_NUMBER DESC NULLS LAST, LAEDA DESC NULLS LAST) = 1"""),
    "mclass": ([], """
        SELECT CAST(p_partkey AS VARCHAR) AS MATNR_PK,
               CASE WHEN p_size <= 10 THEN 'T1' WHEN p_size <= 30 THEN 'T2' ELSE 'T3' END AS UDCTECH001
        FROM part"""),
    "cvals": ([], """
        SELECT DISTINCT CASE WHEN p_size <= 10 THEN 'T1' WHEN p_size <= 30 THEN 'T2' ELSE 'T3' END AS ATWRT_PK,
               'Technology ' || CASE WHEN p_size <= 10 THEN 'T1' WHEN p_size <= 30 THEN 'T2' ELSE 'T3' END AS TEXT
        FROM part WHERE p_size <= 30"""),
    "ctext": (["mclass", "cvals"], """
        SELECT c.MATNR_PK, c.UDCTECH001, v.TEXT FROM mclass c JOIN cvals v ON v.ATWRT_PK = c.UDCTECH001"""),
}

# later orders as seen from an earlier run date, at which many lines lie ahead
CTES["lo_early"] = (CTES["lo"][0], CTES["lo"][1].replace(AS_OF, f"DATE '{P.LATER_AS_OF}'"))


def with_ctes(final: str, *needs: str) -> str:
    """Prefix ``final`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + final


LINE_KEY = "SalesOrderId, PositionNumber, Material, MarsDc, FactPlanBillingDate"


def _typed_output_sql(partition: str | None = None) -> str:
    """With ``partition``, an expression over the quotas: those of the run's partition only, which the result names."""
    from ..operators.merge import OUTPUT_CONTRACT, TYPED_NULL_COLUMNS
    duck = {"string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER", "double": "DOUBLE", "date": "DATE"}
    cols = []
    for name, typ, _w in OUTPUT_CONTRACT:
        if name == "Promo":
            e = "0"
        elif name in TYPED_NULL_COLUMNS:
            e = "NULL"
        elif name == "Subbrand":
            e = "concat_ws(' ', Brand, Technology)"
        elif name == "FlagPriceDisagreement":
            e = "FlagFinal"
        else:
            e = name
        cols.append(f"CAST({e} AS {duck[typ]}) AS {name}")
    if partition is None:
        return with_ctes("SELECT " + ", ".join(cols) + " FROM dec", "dec")
    name, value = P.PARTITION
    whole = with_ctes("SELECT " + ", ".join(cols) + f", {s(value)} AS {name} FROM dec", "dec")
    return whole.replace("FROM quotas\n        WHERE ", f"FROM quotas\n        WHERE {partition} = {s(value)} AND ")


DIMENSION = """
        SELECT a.MATNR_PK AS Material_Code__PK, a.ZZREPMATNR AS Material_ZREP, uo.VTEXT AS Material_UnitOfMeasure,
               a.MEINS AS Material_BaseUnitOfMeasure, TRY_CAST(up.ST_UMREN AS INTEGER) AS Material_PC2Case,
               mt.TXTMD AS Material_Description, bt.VTEXT AS Brand_Name, ct.TEXT AS Technology_Name,
               sg.VTEXT AS Segment_Name,
               CAST(CASE WHEN a.GEWEI = 'G' THEN a.NTGEW / 1000 ELSE a.NTGEW END AS FLOAT) AS Material_NetWeight__UOM,
               CAST(CASE WHEN a.GEWEI = 'G' THEN a.BRGEW / 1000 ELSE a.BRGEW END AS FLOAT) AS Material_GrossWeight__UOM,
               a.LAENG_cm * a.BREIT_cm * a.HOEHE_cm AS Material_Volume__UOM,
               a.MTART AS Material_Type, a.SPART AS BusinessSegment_Code,
               CASE WHEN LAG(a.LAEDA) OVER w IS NULL THEN DATE '2000-01-01' ELSE a.LAEDA END AS Material_StartDate__PK,
               CASE WHEN LEAD(a.LAEDA) OVER w IS NULL THEN DATE '9999-12-31' ELSE LEAD(a.LAEDA) OVER w - 1 END
                 AS Material_EndDate,
               TRY_CAST(up.SB_UMREN AS INTEGER) AS Material_ShowBox__UOM,
               CAST(CASE WHEN up.ST_GEWEI = 'KG' THEN up.ST_ZZNTGEW * 1000 ELSE up.ST_ZZNTGEW END AS DOUBLE)
                 AS Material_PieceNetWeight__UOM,
               a.ZZCLF03 AS Brand_Code, ct.UDCTECH001 AS Tech_Code
        FROM {loads} a
        JOIN shipped sm ON sm.MATNR = a.MATNR_PK
        LEFT JOIN (SELECT DISTINCT split_part(p_name, ' ', 1) AS CHRCOD, upper(split_part(p_name, ' ', 1)) AS VTEXT
                   FROM part) uo ON uo.CHRCOD = a.ZZCLF20
        LEFT JOIN up ON up.MATNR = a.MATNR_PK
        LEFT JOIN (SELECT CAST(p_partkey AS VARCHAR) AS MATNR, p_name AS TXTMD FROM part WHERE p_size <= 45) mt
               ON mt.MATNR = a.MATNR_PK
        LEFT JOIN (SELECT DISTINCT p_brand AS CHRCOD_PK, upper(p_brand) AS VTEXT FROM part) bt ON bt.CHRCOD_PK = a.ZZCLF03
        LEFT JOIN ctext ct ON ct.MATNR_PK = a.MATNR_PK
        LEFT JOIN (SELECT DISTINCT p_type AS CHRCOD_PK, lower(p_type) AS VTEXT FROM part) sg ON sg.CHRCOD_PK = a.ZZCLF02
        WINDOW w AS (PARTITION BY a.MATNR_PK ORDER BY a.LAEDA NULLS FIRST, a.LOAD_DATE NULLS FIRST, a.DI_SEQUENCE_NUMBER NULLS FIRST)"""

SQL: dict[str, str] = {
    "latest_event": """
        SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""",
    "price_flag": with_ctes("SELECT MATERIAL_CODE, PurchaseOrderId, FlagPriceDisagreement, AlertPriceDisagreement FROM pf",
                            "pf"),
    "null_keeping_filter": with_ctes("SELECT * FROM soh_open", "soh_open"),
    "fiscal_week": with_ctes("""SELECT OriginalDate, MarsYear, MarsPeriodName, MarsWeekName,
                                       week_key AS MARS_WEEK_FOR_DEMAND FROM cal""", "cal"),
    "period_keys": with_ctes(f"""
        SELECT OriginalDate, MarsYear, MarsPeriod,
               CASE WHEN MarsPeriod < 10 THEN CAST(MarsYear AS VARCHAR) || '0' || CAST(MarsPeriod AS VARCHAR)
                    ELSE CAST(MarsYear AS VARCHAR) || CAST(MarsPeriod AS VARCHAR) END AS CurrentPeriodYear,
               CASE WHEN MarsPeriod < 10 THEN CAST(MarsYear AS VARCHAR) || '00' || CAST(MarsPeriod AS VARCHAR)
                    ELSE CAST(MarsYear AS VARCHAR) || '0' || CAST(MarsPeriod AS VARCHAR) END AS CurrentPeriodYearWithZeros
        FROM cal WHERE OriginalDate = {AS_OF}""", "cal"),
    "period_start": with_ctes("SELECT FirstDateCurrentPeriod FROM ps", "ps"),
    "classify": with_ctes("SELECT MATERIAL, Brand, Technology, UOM_PC2Case, Tech FROM mat", "mat"),
    "normalize_units": with_ctes("SELECT MATNR_PK, LOAD_DATE, MEABM, LAENG_cm, BREIT_cm, HOEHE_cm FROM an", "an"),
    "strip_zeros": with_ctes("SELECT VBELN, POSNR, MATNR, regexp_replace(MATNR, '^0*', '') AS MATERIAL_CODE FROM items",
                             "items"),
    "cut_orders": with_ctes("SELECT * FROM targets", "targets"),
    "windowed_distinct": with_ctes(f"""
        SELECT {LINE_KEY}, CAST(g.cu AS INTEGER) AS CountUniqueMaterials, g.cl AS CountLines
        FROM ol JOIN (SELECT SalesOrderId AS sid, COUNT(DISTINCT Material) AS cu, COUNT(Material) AS cl
                      FROM ol GROUP BY 1) g ON g.sid = ol.SalesOrderId""", "ol"),
    "rank_ties": with_ctes("""
        SELECT SalesOrderId, MarsDc, n_lines
        FROM (SELECT SalesOrderId, MarsDc, COUNT(*) AS n_lines,
                     MAX(COUNT(*)) OVER (PARTITION BY SalesOrderId) AS mx
              FROM ol GROUP BY 1, 2)
        WHERE n_lines = mx""", "ol"),
    "project_demand": with_ctes("""
        SELECT WAREHOUSE, MATERIAL_CODE, DAY, TMS, FREE_STOCK, ROUND(total, 6) AS DEMAND_TOTAL,
               ROUND(per_day, 6) AS FORECAST_CASES_8_WEEK_BY_PER_DAY FROM demand""", "demand"),
    "valid_at": with_ctes("SELECT * FROM qa", "qa"),
    "arrivals": with_ctes("SELECT * FROM arr", "arr"),
    "restock_asof": with_ctes("SELECT * FROM sa", "sa"),
    "later_order": with_ctes("SELECT * FROM lo_early", "lo_early"),
    "donor_cover": with_ctes("""
        SELECT SalesOrderId, Material, MarsDc, FactPlanBillingDate, CsOrdered, DonorPlant, TMS, FREE_STOCK,
               ROUND(per_day, 6) AS DAILY_DEMAND, AlertForGRD FROM cov""", "cov"),
    "feasible_orders": with_ctes("""
        SELECT SalesOrderId, Material, FactPlanBillingDate, CsOrdered, DonorPlant,
               CAST(cd AS BIGINT) AS CountMaterialsInDonorPlant, CAST(cu AS INTEGER) AS CountUniqueMaterialsInSalesorder,
               ROUND(CsPreSlSalesOrder, 6) AS CsPreSlSalesOrder FROM feas""", "feas"),
    "best_donor": with_ctes("SELECT * FROM bd", "bd"),
    "attach_flag": with_ctes(f"""
        SELECT {LINE_KEY}, PurchaseOrderId, FlagPriceDisagreement, AlertPriceDisagreement FROM flagged""", "flagged"),
    "discontinued": with_ctes(f"""
        SELECT {LINE_KEY}, Discontinue, CASE WHEN Discontinue = 'Yes' THEN 2 END AS DiscontinueAlertPriority,
               CASE WHEN Discontinue = 'Yes' THEN {s(texts.DISCONTINUED_ALERT)} ELSE '' END AS DiscontinueAlert
        FROM ol""", "ol"),
    "guarded_left_join": with_ctes(f"""
        SELECT ol.SalesOrderId, ol.PositionNumber, ol.Material, ol.MarsDc, ol.FactPlanBillingDate, ol.Allocation,
               ol.AllocationAvailable, qa.Alert AS QuotaAlert
        FROM ol LEFT JOIN qa ON ol.Material = qa.Alert4_Material AND ol.Customer = qa.Alert4_Customer
                            AND ol.Allocation = TRUE AND ol.AllocationAvailable = 0""", "ol", "qa"),
    "decisions": with_ctes(f"""
        SELECT {LINE_KEY}, Customer, FlagFinal AS FlagPriceDisagreement, Decision, DecisionDescription, Brand
        FROM dec""", "dec"),
    "decisions_with_donor": with_ctes(f"""
        SELECT {", ".join("dec." + c.strip() for c in LINE_KEY.split(","))}, dec.Decision, dec.DecisionDescription,
               bd.Alert AS DonorAlert, bd.AlertPriority AS DonorAlertPriority
        FROM dec LEFT JOIN bd ON dec.SalesOrderId = bd.SalesOrderId""", "dec", "bd"),
    "typed_output": _typed_output_sql(),
    "decisions_from_files": _typed_output_sql(),
    "decisions_for_partition": _typed_output_sql("CASE WHEN Customer % 2 = 0 THEN 'even' ELSE 'odd' END"),
    "dimension_from_files": with_ctes(DIMENSION.format(loads="an"), "an", "shipped", "up", "ctext"),
    "active_sites": with_ctes("SELECT * FROM sites", "sites"),
    "shipped_materials": with_ctes("SELECT MATNR FROM shipped", "shipped"),
    "unit_pivot": with_ctes("SELECT * FROM up", "up"),
    "validity_interval": """
        SELECT o_custkey, o_orderkey, odate,
               CASE WHEN LAG(odate) OVER w IS NULL THEN DATE '2000-01-01' ELSE odate END AS StartDate,
               CASE WHEN LEAD(odate) OVER w IS NULL THEN DATE '9999-12-31' ELSE LEAD(odate) OVER w - 1 END AS EndDate
        FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS odate FROM orders)
        WINDOW w AS (PARTITION BY o_custkey ORDER BY odate, o_orderkey)""",
    "coded_text": with_ctes("SELECT * FROM ctext", "ctext"),
    "material_dimension": with_ctes(DIMENSION.format(loads="an"), "an", "shipped", "up", "ctext"),
    "material_dimension_history": with_ctes(DIMENSION.format(loads="an_all"), "an_all", "shipped", "up", "ctext"),
}
