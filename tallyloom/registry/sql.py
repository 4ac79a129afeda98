"""Building blocks of the check SQL (DuckDB): the model views, written independently of the Spark plans."""

from __future__ import annotations

from tallyloom.functions.lookups import US_STATES


def money(x: str) -> str:
    return f"round({x}, 2)::DECIMAL(18,2)"


def whole(x: str) -> str:
    """``|x|`` in units of the eighth digit, exactly."""
    return f"(abs({x})::DECIMAL(28,8) * 100000000)::HUGEINT"


def rounded(n: str, d: str, digits: int, scale: int = 1) -> str:
    """``n / d * scale`` rounded half away from zero, in whole numbers; NULL where ``d`` is 0."""
    steps = f"((2 * {scale * 10**digits} * {whole(n)} + {whole(d)}) // nullif(2 * {whole(d)}, 0))"
    unit = f"0.{'0' * (digits - 1)}1::DECIMAL({digits + 1},{digits})"
    return f"(sign({n})::INT * sign({d})::INT * {steps}::DECIMAL(28,0) * {unit})::DECIMAL(28,{digits})"


def ratio(n: str, d: str, digits: int, scale: int = 1) -> str:
    return f"CASE WHEN ({d}) > 0 THEN {rounded(n, d, digits, scale)} ELSE 0 END"


def pct(n: str, d: str, digits: int = 1) -> str:
    return ratio(n, d, digits, 100)


def bands(x: str, edges, default: str) -> str:
    whens = " ".join(f"WHEN {x} >= {edge} THEN '{label}'" for edge, label in edges)
    return f"CASE {whens} ELSE '{default}' END"


def sql(ctes: str, body: str, d: str = "", i: str = "") -> str:
    """``WITH`` views and body, the named columns cast to DOUBLE (``d``) or BIGINT (``i``); comma-separated."""
    casts = [f'"{c.strip()}"::DOUBLE AS "{c.strip()}"' for c in d.split(",") if c.strip()]
    casts += [f'"{c.strip()}"::BIGINT AS "{c.strip()}"' for c in i.split(",") if c.strip()]
    replace = f" REPLACE ({', '.join(casts)})" if casts else ""
    return f"WITH {ctes + ', ' if ctes else ''}result_rows AS ({body}) SELECT *{replace} FROM result_rows"


STATE_LIST = "[" + ", ".join(f"'{s}'" for s in US_STATES) + ", 'ZZ', NULL]"
STATE_PAIRS = "state_names(code, name) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in US_STATES.items()) + ")"
LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

# --- sales ------------------------------------------------------------------------------------

TX = f"""tx AS (
  SELECT {LINE_ID} AS "TransactionID", l_orderkey AS "OrderID", o_custkey AS "CustomerID",
    l_partkey AS "ProductID", l_suppkey AS "SalesRepID", o_orderdate::DATE AS "TransactionDate",
    l_quantity::INT AS "Quantity",
    {money("(l_extendedprice / l_quantity)::DECIMAL(18,6)")} AS "UnitPrice",
    l_discount::DECIMAL(4,2) AS "Discount",
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Wire Transfer'
         WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'Credit Card' ELSE 'PayPal' END AS "PaymentMethod",
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS "ReturnFlag"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FEATURES = f"""gross AS (
  SELECT *, {money('"Quantity" * "UnitPrice"')} AS "GrossRevenue" FROM tx),
net AS (
  SELECT *, {money('"GrossRevenue" * (1 - "Discount")')} AS "NetRevenue" FROM gross),
features AS (
  SELECT *, "GrossRevenue" - "NetRevenue" AS "DiscountAmount",
    'Q' || quarter("TransactionDate") AS "Quarter", year("TransactionDate") AS "Year",
    strftime("TransactionDate", '%B') AS "Month"
  FROM net)"""

STAGING = f"""{TX}, {FEATURES},
staging AS (
  SELECT * EXCLUDE ("Discount", "ReturnFlag"), "Discount" AS "DiscountRate" FROM features WHERE "ReturnFlag" = 'N')"""

CUSTOMERS = f"""customers AS (
  SELECT c_custkey AS "CustomerID", c_name AS "CustomerName", c_mktsegment AS "Segment", r_name AS "Region",
    n_name AS "Country", ({STATE_LIST})[c_custkey % 53 + 1] AS "State", 'City ' || (c_custkey % 100) AS "City",
    c_acctbal::DECIMAL(18,2) * 10 AS "CreditLimit",
    DATE '1995-01-01' - (c_custkey % 2000)::INT AS "AccountOpenDate",
    CASE WHEN c_custkey % 2 = 0 THEN 'Credit Card' ELSE 'PayPal' END AS "PreferredPayment"
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

PRODUCTS = f"""products AS (
  SELECT p_partkey AS "ProductID", p_name AS "ProductName", p_type AS "Category", 'Size ' || p_size AS "SubCategory",
    p_brand AS "Brand", {money("p_retailprice::DECIMAL(18,2) * 0.60::DECIMAL(3,2)")} AS "CostPrice",
    p_retailprice::DECIMAL(18,2) AS "MSRP", p_size % 3 * 12 + 12 AS "WarrantyMonths"
  FROM part)"""

REPS = """reps AS (
  SELECT s_suppkey AS "SalesRepID", s_name AS "RepName", n_name AS "Territory",
    ((s_suppkey % 3 + 7)::INT * 0.01::DECIMAL(3,2))::DECIMAL(6,4) AS "CommissionRate",
    s_suppkey % 7 * 3000000 + 10000000 AS "YTDQuota"
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

TARGETS = """targets AS (
  SELECT r_name AS "Region", y AS "Year", 'Q' || q AS "Quarter",
    12000000 + r_regionkey * 1000000 + q * 250000 + (y - 1995) * 100000 AS "RevenueTarget",
    7000 + q * 100 AS "UnitTarget", 0.85::DECIMAL(4,2) AS "RetentionTarget"
  FROM region, range(1995, 2002) AS years(y), range(1, 5) AS quarters(q))"""

DEAL_EDGES = ((60000, "Platinum"), (30000, "Gold"), (10000, "Silver"))
COMMISSION_EDGES = ((5000, "High Commission"), (2000, "Mid Commission"))
CUSTOMER_EDGES = ((1500000, "VIP"), (1000000, "High Value"), (500000, "Growth"))

STAR = f"""{STAGING}, {CUSTOMERS}, {PRODUCTS}, {REPS}, {TARGETS},
star AS (
  SELECT staging.*, customers.* EXCLUDE ("CustomerID"), products.* EXCLUDE ("ProductID"),
    reps.* EXCLUDE ("SalesRepID"), "RevenueTarget", "UnitTarget", "RetentionTarget"
  FROM staging
  LEFT JOIN customers ON staging."CustomerID" = customers."CustomerID"
  LEFT JOIN products ON staging."ProductID" = products."ProductID"
  LEFT JOIN reps ON staging."SalesRepID" = reps."SalesRepID"
  LEFT JOIN targets ON customers."Region" = targets."Region" AND staging."Year" = targets."Year"
    AND staging."Quarter" = targets."Quarter")"""

ENRICHED = f"""{STAR},
margins AS (
  SELECT *, {money('"CostPrice" * "Quantity"')} AS "COGS",
    {money('"NetRevenue" - "CostPrice" * "Quantity"')} AS "GrossMargin" FROM star),
tiers AS (
  SELECT *, {pct('"GrossRevenue" - "COGS"', '"GrossRevenue"')} AS "MarginPct",
    {bands('"NetRevenue"', DEAL_EDGES, "Bronze")} AS "DealTier",
    {bands('"DiscountRate"', ((0.15, "Heavy Discount"), (0.05, "Standard Discount")), "No Discount")} AS "DiscountTier",
    {bands('"CreditLimit"', ((80000, "Strategic"), (30000, "Major"), (12000, "Standard")), "Starter")} AS "AccountTier",
    CASE WHEN "PaymentMethod" = 'Wire Transfer' AND "NetRevenue" >= 1000 THEN 'Low Risk'
         WHEN "PaymentMethod" = 'Credit Card' THEN 'Medium Risk' ELSE 'PayPal Risk' END AS "PaymentRisk",
    {ratio('"NetRevenue"', '"Quantity"', 2)} AS "RevenuePerUnit",
    {pct('"NetRevenue" * 90', '"RevenueTarget"')} AS "PctDailyTarget",
    date_diff('day', "AccountOpenDate", "TransactionDate") AS "AccountAgeDays"
  FROM margins),
factors AS (
  SELECT *, CASE "DealTier" WHEN 'Platinum' THEN 1.50 WHEN 'Gold' THEN 1.25 WHEN 'Silver' THEN 1.00 ELSE 0.75 END
      ::DECIMAL(4,2) AS "TierMultiplier", 1::DECIMAL(4,2) AS "ReturnMultiplier",
    {money('"NetRevenue" * "CommissionRate"')} AS "BaseCommission"
  FROM tiers),
paid AS (
  SELECT *, {money('"BaseCommission" * "TierMultiplier" * "ReturnMultiplier"')} AS "FinalCommission" FROM factors),
enriched AS (
  SELECT *, {bands('"FinalCommission"', COMMISSION_EDGES, "Standard Commission")} AS "CommissionBand" FROM paid)"""

KPI = f"""{ENRICHED},
kpi_sums AS (
  SELECT "CustomerID", "CustomerName", "Segment", "Region", "AccountTier", count(*) AS "TotalOrders",
    sum("NetRevenue") AS "TotalRevenue", sum("GrossRevenue") AS "TotalGross", sum("GrossMargin") AS "TotalMargin",
    sum("COGS") AS "TotalCOGS", sum("Quantity") AS "TotalUnits", max("NetRevenue") AS "MaxOrderValue",
    sum("FinalCommission") AS "TotalCommission", min("TransactionDate") AS "FirstOrderDate",
    max("TransactionDate") AS "LastOrderDate"
  FROM enriched GROUP BY ALL),
kpi AS (
  SELECT *, {ratio('"TotalRevenue"', '"TotalOrders"', 2)} AS "AvgOrderValue",
    {pct('"TotalMargin"', '"TotalGross"')} AS "MarginPct",
    {bands('"TotalRevenue"', CUSTOMER_EDGES, "Emerging")} AS "CustomerValueBand"
  FROM kpi_sums)"""

PERFORMANCE = f"""{ENRICHED},
performance AS (
  SELECT "ProductID", "ProductName", "Category", "SubCategory", "Brand", "MSRP", "CostPrice", "WarrantyMonths",
    count(*) AS "TotalOrders", sum("Quantity") AS "TotalUnitsSold", sum("NetRevenue") AS "TotalRevenue",
    sum("GrossMargin") AS "TotalMargin", sum("DiscountAmount") AS "TotalDiscount",
    count(DISTINCT "CustomerID") AS "UniqueCustomers", {ratio('sum("NetRevenue")', "count(*)", 2)} AS "AvgSalePrice"
  FROM enriched GROUP BY 1, 2, 3, 4, 5, 6, 7, 8)"""

REP_EDGES = ((100, "Overachiever"), (80, "On Track"), (60, "At Risk"))


def rep_report(by_region: bool) -> str:
    region = ', "Region"' if by_region else ""
    keys = f'"SalesRepID", "RepName", "Territory", "CommissionRate", "YTDQuota"{region}'
    same = 'r."SalesRepID" = m."SalesRepID"' + (' AND r."Region" = m."Region"' if by_region else "")
    return f"""{ENRICHED},
rep_sums AS (
  SELECT {keys}, count(*) AS "TotalDeals", sum("NetRevenue") AS "TotalRevenue", sum("GrossMargin") AS "TotalMargin",
    sum("FinalCommission") AS "TotalCommission", sum("Quantity") AS "TotalUnitsSold",
    count(DISTINCT "CustomerID") AS "UniqueAccounts", max("NetRevenue") AS "LargestDeal"
  FROM enriched GROUP BY ALL),
tier_counts AS (
  SELECT "SalesRepID"{region}, "DealTier", count(*) AS n FROM enriched GROUP BY ALL),
tier_mode AS (
  SELECT * FROM tier_counts
  QUALIFY row_number() OVER (PARTITION BY "SalesRepID"{region} ORDER BY n DESC, "DealTier") = 1),
rep_pct AS (
  SELECT r.*, m."DealTier" AS "MostCommonTier", {pct('"TotalRevenue"', '"YTDQuota"')} AS "QuotaAttainmentPct",
    {ratio('"TotalRevenue"', '"TotalDeals"', 2)} AS "AvgDealSize"
  FROM rep_sums r JOIN tier_mode m ON {same}),
rep_report AS (
  SELECT *, {bands('"QuotaAttainmentPct"', REP_EDGES, "Underperforming")} AS "PerformanceBand" FROM rep_pct)"""


DASHBOARD = f"""{ENRICHED},
region_sums AS (
  SELECT "Region", "Year", "Quarter", "RevenueTarget", "UnitTarget", count(*) AS "TotalTransactions",
    sum("NetRevenue") AS "ActualRevenue", sum("GrossMargin") AS "ActualMargin", sum("Quantity") AS "ActualUnits",
    sum("FinalCommission") AS "TotalCommission", count(DISTINCT "CustomerID") AS "ActiveAccounts"
  FROM enriched GROUP BY ALL),
region_pct AS (
  SELECT *, {ratio('"ActualRevenue"', '"TotalTransactions"', 2)} AS "AvgTransactionValue",
    {pct('"ActualRevenue"', '"RevenueTarget"')} AS "RevenueAttainmentPct",
    "ActualRevenue" - "RevenueTarget" AS "RevenueGap", {pct('"ActualMargin"', '"ActualRevenue"')} AS "MarginPct"
  FROM region_sums),
dashboard AS (
  SELECT *, {bands('"RevenueAttainmentPct"', ((100, "Target Met"), (80, "Close to Target")), "Off Track")}
    AS "TargetStatus" FROM region_pct)"""

# --- retail -----------------------------------------------------------------------------------

RAW = f"""raw AS (
  SELECT {LINE_ID} AS transactionid, o_orderkey + 4000000000000000 AS creditcardnumber,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Visa' WHEN '2-HIGH' THEN 'MasterCard' WHEN '3-MEDIUM' THEN 'Discover'
      WHEN '4-NOT SPECIFIED' THEN 'American Express' ELSE 'Cash' END AS creditcardtype,
    o_custkey AS customerid, o_orderdate::DATE AS transactiondate, l_orderkey % 26 AS locationid,
    l_partkey AS productid, l_extendedprice::DECIMAL(18,2) AS purchaseprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PREPARED = f"""{RAW},
prepared AS (
  SELECT transactionid AS "Transaction ID", creditcardnumber AS "Credit Card Number",
    creditcardtype AS "Credit Card Type", customerid AS "Customer ID", transactiondate AS "Transaction Date",
    locationid AS "Location ID", productid AS "Product ID", purchaseprice AS "Purchase Price" FROM raw)"""

TIMED = f"""{PREPARED},
timed AS (
  SELECT *, date_trunc('month', "Transaction Date")::DATE AS "Month", month("Transaction Date") AS "Month Num",
    year("Transaction Date") AS "Year" FROM prepared)"""

UNITS = """units AS (
  SELECT p_partkey AS productid, split_part(p_brand, '#', 2)::INT AS brandid, p_type AS containertype,
    p_partkey % 26 AS locationid, DATE '1994-01-01' + (p_partkey % 365)::INT AS purchasedate FROM part)"""

BRANDS = """numbered_brands AS (
  SELECT p_brand, split_part(p_brand, '#', 2)::INT AS b, min(p_retailprice) AS low FROM part GROUP BY ALL),
brands AS (
  SELECT b AS brandid, p_brand AS brandname, 'Brew City ' || (b % 7) AS city, STATES[b % 51 + 1] AS state,
    '  The  ' || p_brand || chr(9) || 'soda ' || chr(10) || ' café ' AS description,
    CASE WHEN b % 3 = 0 THEN NULL WHEN b % 3 = 1 THEN '  ' ELSE 'http://brand' || b || '.example.com' END AS website,
    CASE WHEN b % 4 = 0 THEN NULL ELSE 'http://brand' || b || '.example.com' END AS facebookpage,
    CASE WHEN b % 5 = 0 THEN '' ELSE 'http://brand' || b || '.example.com' END AS twitter,
    low::DECIMAL(18,2) AS currentretailprice FROM numbered_brands)""".replace("STATES", f"({STATE_LIST})")


def filled(c: str) -> str:
    return f"CASE WHEN trim(coalesce({c}, '')) = '' THEN 'http://www.google.com/search?q=' || brandname ELSE {c} END"


BRANDS_FILLED = f"""{BRANDS},
brands_filled AS (
  SELECT brandid, brandname, city, state, description, currentretailprice, {filled("website")} AS website,
    {filled("facebookpage")} AS facebookpage, {filled("twitter")} AS twitter FROM brands)"""

REVIEWS = """reviews AS (
  SELECT event_id AS reviewkey, user_id AS customerid, event_id % 25 + 1 AS brandid,
    event_id // 25 % 5 + 1 AS starrating, ts::DATE AS reviewdate,
    CASE WHEN event_type <> 'error' THEN props END AS review FROM events)"""

PEOPLE = f"""people AS (
  SELECT c_custkey AS customerid, split_part(c_name, '#', 1) AS firstname, split_part(c_name, '#', 2) AS lastname,
    ({STATE_LIST})[c_custkey % 53 + 1] AS state, lpad((c_custkey % 99999)::VARCHAR, 5, '0') AS zipcode,
    CASE WHEN c_custkey % 10 = 0 THEN '13/45/2020'
         ELSE strftime(DATE '1994-01-01' + (c_custkey % 900)::INT, '%m/%d/%Y') END AS firstpurchasedate
  FROM customer)"""

GEO = """geo AS (
  SELECT n_nationkey + 1 AS locationid, (n_nationkey * 37 % 120 - 60 + 0.25)::DOUBLE AS latitude,
    (n_nationkey * 61 % 340 - 170 + 0.5)::DOUBLE AS longitude, 'Store ' || n_name AS locationname FROM nation
  UNION ALL SELECT 0, 0, 0, 'LOST'),
geo_text AS (
  SELECT *, 'POINT(' || longitude::DECIMAL(9,2) || ' ' || latitude::DECIMAL(9,2) || ')' AS location FROM geo)"""

PLACED = """placed AS (
  SELECT c_custkey AS original_customerid, c_nationkey + 1 AS homestore,
    c_nationkey * 37 % 120 - 60 + 0.25::DOUBLE + (c_custkey % 41 - 20) * 0.01::DOUBLE AS lat,
    c_nationkey * 61 % 340 - 170 + 0.5::DOUBLE + (c_custkey % 37 - 18) * 0.01::DOUBLE AS lon FROM customer)"""


def miles(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a, b = f"sin((radians({lat2}) - radians({lat1})) / 2)", f"sin((radians({lon2}) - radians({lon1})) / 2)"
    h = f"{a} * {a} + cos(radians({lat1})) * cos(radians({lat2})) * {b} * {b}"
    return f"(2 * 3958.7613 * asin(sqrt(least({h}, 1.0))))"


def compass(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    turn = f"(radians({lon2}) - radians({lon1}))"
    east = f"sin({turn}) * cos(radians({lat2}))"
    north = (
        f"cos(radians({lat1})) * sin(radians({lat2})) - sin(radians({lat1})) * cos(radians({lat2})) * cos({turn})"
    )
    sector = f"(floor((degrees(atan2({east}, {north})) + 382.5) / 45)::BIGINT % 8 + 1)"
    return (
        f"CASE WHEN {lat1} = {lat2} AND {lon1} = {lon2} THEN NULL "
        f"ELSE ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][{sector}] END"
    )


PAIRS = f"""{GEO}, {PLACED},
pairs AS (
  SELECT original_customerid, homestore, lat, lon, locationid AS storeid,
    {miles("latitude", "longitude", "lat", "lon")} AS miles,
    {compass("latitude", "longitude", "lat", "lon")} AS direction
  FROM placed, geo WHERE locationid <> 0)"""
