"""Run parameters used when the jobs run on the driver's test tables.

The original jobs hard-code values for their own data (a run date of
"today", three named warehouses, a 2-kopeck price tolerance, dates in
2019/2020).  The test tables are TPC-H-like (dates 1995-2001, warehouses are
the 5 region keys, prices unrelated to list prices), so the registered queries
pass these values instead; every operator keeps the original values as its
defaults.
"""

AS_OF = "2000-12-31"                      # run date (replaces current_date())
WAREHOUSES = [0, 1, 2]                    # warehouses whose orders are checked for donors
DONOR_PAIRS = [(w, (w + k) % 5) for w in range(5) for k in (1, 2)]   # (source, donor)
PRICE_TOLERANCE = 1000.0                  # |expected - price| above this is flagged
SALES_ORG = 100                           # item filter: sales organisation
DIVISION_CODE = 2                         # item filter: division
PARTITION = ("partition_group", "even")   # the partition of the quotas and of the result: customers with even numbers
DRY_BRANDS = ("Brand#1",)                 # brands classified DRY whatever their technology
TRANSPORT_DIVISION = "Division 2"
SITE_PREFIXES = ("view", "click")         # address-type prefixes counted as sites
CREATED_FROM = "1999-12-29"               # shipment items created on/after
ISSUED_FROM = "2000-01-01"                # goods issue on/after
LATER_AS_OF = "1997-06-30"                # run date of the later-order query
LATER_BACK = 1500                         # days that a quota may be looked for in later orders
CALENDAR_MARGIN_DAYS = 60                 # calendar runs this far past the last ship date
