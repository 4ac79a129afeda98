"""Queries of the retail pipelines: transactions, dimensions, market, reviews, engagement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators import aggs
from tallyloom.plans import retail
from tallyloom.registry import query
from tallyloom.registry.sql import (
    BRANDS, BRANDS_FILLED, GEO, PEOPLE, PREPARED, RAW, REVIEWS, TIMED, UNITS, ratio, rounded, sql,
)
from tallyloom.sources import model

# The test tables' transaction key is text; the other types are those of the till export.
TYPES = {
    "Credit Card Number": "bigint",
    "Customer ID": "bigint",
    "Location ID": "int",
    "Purchase Price": "decimal(18,2)",
    "Product ID": "bigint",
    "Transaction Date": "date",
    "Transaction ID": "string",
}


def prepared(spark: SparkSession, d: str) -> DataFrame:
    return retail.prepare_transactions(model.retail_transactions(spark, d), TYPES)


def timed(spark: SparkSession, d: str) -> DataFrame:
    return retail.time_features(prepared(spark, d))


def stocked(spark: SparkSession, d: str) -> DataFrame:
    """Transactions with the brand key of what was sold."""
    return retail.with_product(timed(spark, d), model.stock_units(spark, d))


# --- transactions ----------------------------------------------------------------------------

query("prepare_transactions", sql(PREPARED, "SELECT * FROM prepared", d="Purchase Price"))(prepared)


@query(
    "transaction_time_features",
    sql(TIMED, 'SELECT "Transaction ID", "Transaction Date", "Month", "Month Num", "Year" FROM timed'),
)
def transaction_time_features(spark, d):
    return timed(spark, d).select("Transaction ID", "Transaction Date", "Month", "Month Num", "Year")


LAG = """date_diff('day', lag("Transaction Date") OVER (PARTITION BY "Customer ID"
  ORDER BY "Transaction Date", "Transaction ID"), "Transaction Date")"""


@query(
    "days_since_last_purchase",
    sql(
        PREPARED,
        f"""SELECT "Transaction ID", "Customer ID", "Transaction Date", coalesce({LAG}, 0) AS "Days Since Last Purchase"
FROM prepared""",
    ),
)
def days_since_last_purchase(spark, d):
    tx = prepared(spark, d).select("Transaction ID", "Customer ID", "Transaction Date")
    return retail.days_since_purchase(tx, joined=True)


@query(
    "geo_enriched_transactions",
    sql(
        f"{PREPARED}, {GEO}",
        """SELECT "Transaction ID", "Location ID", locationname, latitude AS geo_latitude, longitude AS geo_longitude,
  location AS geo_location_text
FROM prepared LEFT JOIN geo_text ON "Location ID" = locationid AND locationid <> 0""",
    ),
)
def geo_enriched_transactions(spark, d):
    stores = retail.location_dim(model.locations(spark, d), model.geolocation(spark, d))
    return retail.with_location(prepared(spark, d).select("Transaction ID", "Location ID"), stores)


@query(
    "time_on_shelf",
    sql(
        f"{PREPARED}, {UNITS}",
        """SELECT "Transaction ID", date_diff('day', purchasedate, "Transaction Date") AS "Time on Shelf"
FROM prepared JOIN units ON "Product ID" = productid""",
    ),
)
def time_on_shelf(spark, d):
    tx = retail.with_product(prepared(spark, d), model.stock_units(spark, d))
    return retail.time_on_shelf(tx).select("Transaction ID", "Time on Shelf")


@query(
    "retail_enriched",
    sql(
        f"{TIMED}, {UNITS}, {GEO}, lagged AS (SELECT *, coalesce({LAG}, 0) AS \"Days Since Last Purchase\" FROM timed)",
        """SELECT t.*, brandid, containertype, u.locationid AS stock_locationid, purchasedate, locationname,
  latitude AS geo_latitude, longitude AS geo_longitude, location AS geo_location_text,
  date_diff('day', purchasedate, "Transaction Date") AS "Time on Shelf"
FROM lagged t JOIN units u ON "Product ID" = productid
LEFT JOIN geo_text g ON "Location ID" = g.locationid AND g.locationid <> 0""",
        d="Purchase Price",
    ),
)
def retail_enriched(spark, d):
    return retail.enriched_transactions(
        model.retail_transactions(spark, d),
        model.stock_units(spark, d),
        model.locations(spark, d),
        model.geolocation(spark, d),
        TYPES,
        joined=True,
    )


@query(
    "card_revenue_profit",
    sql(
        RAW,
        """SELECT creditcardtype, sum(purchaseprice) AS "Revenue", sum(purchaseprice - 1) AS "Sum_Profit" FROM raw GROUP BY 1""",
        d="Revenue, Sum_Profit",
    ),
)
def card_revenue_profit(spark, d):
    return retail.card_revenue_profit(model.retail_transactions(spark, d))


@query(
    "transpose_metrics",
    sql(
        RAW,
        """SELECT creditcardtype, 'Revenue' AS "Name", sum(purchaseprice) AS "Value" FROM raw GROUP BY 1
UNION ALL SELECT creditcardtype, 'Sum_Profit', sum(purchaseprice - 1) FROM raw GROUP BY 1""",
        d="Value",
    ),
)
def transpose_metrics(spark, d):
    wide = retail.card_revenue_profit(model.retail_transactions(spark, d))
    return aggs.transpose(wide, ["creditcardtype"], ["Revenue", "Sum_Profit"])


@query(
    "daily_transaction_summary",
    sql(
        PREPARED,
        """SELECT "Transaction Date" AS transaction_date, count(*) AS transaction_count,
  sum("Purchase Price") AS total_purchase_price FROM prepared GROUP BY 1""",
        d="total_purchase_price",
    ),
)
def daily_transaction_summary(spark, d):
    return retail.daily_summary(prepared(spark, d))


@query(
    "sales_by_day_location",
    sql(
        f"{PREPARED}, {UNITS}, {GEO}",
        f"""SELECT "Transaction Date", locationname, containertype, "Product ID", sum("Purchase Price") AS "Sales",
  {ratio('sum("Purchase Price")', "count(*)", 2)} AS "Average Sale", count(DISTINCT "Transaction ID") AS "Transaction Count"
FROM prepared JOIN units ON "Product ID" = productid
LEFT JOIN geo g ON "Location ID" = g.locationid AND g.locationid <> 0 GROUP BY 1, 2, 3, 4""",
        d="Sales, Average Sale",
    ),
)
def sales_by_day_location(spark, d):
    stores = retail.location_dim(model.locations(spark, d), model.geolocation(spark, d))
    tx = retail.with_product(prepared(spark, d), model.stock_units(spark, d))
    return retail.sales_by_day_location(retail.with_location(tx, stores))


# --- dimensions ------------------------------------------------------------------------------

# Dimensions from inputs that repeat their keys: one row per sale, order or customer, the first one stays.

@query(
    "dim_customer",
    sql(
        PEOPLE,
        """SELECT o_custkey AS customerid, firstname, lastname, state, min(o_orderkey) AS orderkey FROM orders JOIN people
ON o_custkey = customerid GROUP BY ALL""",
    ),
)
def dim_customer(spark, d):
    orders = model.table(spark, d, "orders").select(F.col("o_custkey").alias("customerid"), F.col("o_orderkey").alias("orderkey"))
    people = model.retail_customers(spark, d).select("customerid", "firstname", "lastname", "state")
    return retail.dim_first(orders.join(people, "customerid"), "customerid", ["orderkey"])


@query(
    "dim_product",
    sql(
        f"{RAW}, {UNITS}",
        """SELECT units.*, first_sale FROM units JOIN
(SELECT productid AS sold, min(transactionid) AS first_sale FROM raw GROUP BY 1) ON productid = sold""",
    ),
)
def dim_product(spark, d):
    sales = model.retail_transactions(spark, d).select("productid", F.col("transactionid").alias("first_sale"))
    return retail.dim_first(sales.join(model.stock_units(spark, d), "productid"), "productid", ["first_sale"])


@query(
    "dim_location",
    sql(
        GEO,
        """SELECT locationid, latitude, longitude, location, min(c_custkey) AS customerid FROM geo_text
JOIN customer ON c_nationkey = locationid GROUP BY ALL""",
    ),
)
def dim_location(spark, d):
    people = model.table(spark, d, "customer").select(F.col("c_nationkey").alias("locationid"), F.col("c_custkey").alias("customerid"))
    return retail.dim_first(model.geolocation(spark, d).join(people, "locationid"), "locationid", ["customerid"])


@query(
    "dim_card_type",
    sql(
        RAW,
        """SELECT creditcard_type, row_number() OVER (ORDER BY creditcard_type) AS creditcard_type_id
FROM (SELECT DISTINCT creditcardtype AS creditcard_type FROM raw)""",
    ),
)
def dim_card_type(spark, d):
    return retail.dim_card_type(model.retail_transactions(spark, d))


@query(
    "dim_date",
    sql(
        PREPARED,
        """SELECT date_key, year(date_key) AS cal_year, month(date_key) AS cal_month, day(date_key) AS cal_day,
  strftime(date_key, '%A') AS day_name FROM (SELECT DISTINCT "Transaction Date" AS date_key FROM prepared)""",
    ),
)
def dim_date(spark, d):
    return retail.dim_date(prepared(spark, d))


# --- market ----------------------------------------------------------------------------------

MONTHLY = f"""{TIMED}, monthly AS (
  SELECT "Month", sum("Purchase Price") AS "Sales", count(DISTINCT "Customer ID") AS "Customers" FROM timed GROUP BY 1)"""
MONTHLY_SQL = sql(MONTHLY, "SELECT * FROM monthly", d="Sales")

query("monthly_sales", MONTHLY_SQL)(lambda spark, d: retail.monthly_sales(timed(spark, d)))
query("sort_monthly", MONTHLY_SQL)(lambda spark, d: retail.monthly_sales(timed(spark, d)).orderBy("Month"))


@query(
    "monthly_running_total",
    sql(MONTHLY, 'SELECT *, sum("Sales") OVER (ORDER BY "Month") AS "RunTot_Sales" FROM monthly', d="Sales, RunTot_Sales"),
)
def monthly_running_total(spark, d):
    return retail.monthly_running_total(timed(spark, d))


BRAND_REVENUE = f"""{TIMED}, {UNITS}, {BRANDS}, brand_revenue AS (
  SELECT brandname AS "Brand", sum("Purchase Price") AS "Revenue"
  FROM timed JOIN units ON "Product ID" = productid JOIN brands ON units.brandid = brands.brandid
  WHERE "Year" = (SELECT max("Year") FROM timed) GROUP BY 1)"""


@query("brand_revenue_latest_year", sql(BRAND_REVENUE, "SELECT * FROM brand_revenue", d="Revenue"))
def brand_revenue_latest_year(spark, d):
    return retail.brand_revenue(stocked(spark, d), model.brands(spark, d))


@query(
    "brand_revenue_share",
    sql(
        BRAND_REVENUE + """, shares AS (
  SELECT *, sum("Revenue") OVER () AS "Total Revenue",
    "Revenue"::DOUBLE / (sum("Revenue") OVER ())::DOUBLE AS "Share of Revenue" FROM brand_revenue)""",
        """SELECT "Brand", "Revenue", "Total Revenue", round("Share of Revenue"::DECIMAL(28,10), 8) AS "Share of Revenue",
  """ + rounded('"Revenue"', '"Total Revenue"', 1, 100) + """::VARCHAR || '%' AS "Share of Revenue Label" FROM shares""",
        d="Revenue, Total Revenue, Share of Revenue",
    ),
)
def brand_revenue_share(spark, d):
    out = retail.brand_revenue_share(stocked(spark, d), model.brands(spark, d))
    return out.withColumn("Share of Revenue", F.round(F.col("Share of Revenue").cast("decimal(28,10)"), 8))


YTD = f"""{TIMED}, last_month AS (
  SELECT "Year" AS y, max("Month Num") AS m FROM timed WHERE "Year" = (SELECT max("Year") FROM timed) GROUP BY 1),
ytd AS (
  SELECT "Year", y AS "Max_Year", count(DISTINCT "Customer ID") AS "Customers", sum("Purchase Price") AS "Revenue"
  FROM timed, last_month WHERE "Month Num" <= m GROUP BY 1, 2)"""


@query("yearly_ytd", sql(YTD, "SELECT * FROM ytd", d="Revenue"))
def yearly_ytd(spark, d):
    return retail.yearly_ytd(timed(spark, d))


def _yoy(name: str, measure: str, column: str) -> None:
    change = rounded(f'"{measure}" - before', "before", 1, 100)
    text = sql(
        YTD + f""", lagged AS (SELECT *, lag("{measure}") OVER (ORDER BY "Year") AS before FROM ytd)""",
        f"""SELECT * EXCLUDE (before), {change}::VARCHAR || '%' AS "{column}" FROM lagged""",
        d="Revenue",
    )
    query(name, text)(lambda spark, d: retail.yoy_change(timed(spark, d), measure, column))


_yoy("yoy_customer_change", "Customers", "YOY Customer Change")
_yoy("yoy_revenue_change", "Revenue", "YOY Revenue Change")


# --- reviews ---------------------------------------------------------------------------------

@query("silver_reviews", sql(REVIEWS, "SELECT * FROM reviews"))
def silver_reviews(spark, d):
    return retail.typed_reviews(model.reviews(spark, d))


@query(
    "silver_brand",
    sql(
        BRANDS_FILLED,
        r"""SELECT * REPLACE (brandid::BIGINT AS brandid, currentretailprice::DOUBLE AS currentretailprice,
  trim(regexp_replace(regexp_replace(description, '[^ -~]', '', 'g'), '\s+', ' ', 'g')) AS description) FROM brands_filled""",
    ),
)
def silver_brand(spark, d):
    return retail.typed_brands(model.brands(spark, d))


@query("silver_customers", sql(PEOPLE, "SELECT * REPLACE (zipcode::BIGINT AS zipcode) FROM people"))
def silver_customers(spark, d):
    return retail.typed_customers(model.retail_customers(spark, d))


@query(
    "enriched_reviews",
    sql(
        f"{REVIEWS}, {BRANDS_FILLED}, {PEOPLE}",
        r"""SELECT row_number() OVER (ORDER BY reviewdate, reviewkey) AS "Review ID", r.*, coalesce(length(review), 1) AS "Length",
  brandname, website, trim(regexp_replace(regexp_replace(description, '[^ -~]', '', 'g'), '\s+', ' ', 'g')) AS description,
  firstname || ' ' || lastname AS fullname, try_strptime(firstpurchasedate, '%m/%d/%Y')::DATE AS cust_firstpurchasedate,
  strftime(reviewdate, '%Y') AS "Year", strftime(reviewdate, '%m') AS "Month", strftime(reviewdate, '%d') AS "Day"
FROM reviews r LEFT JOIN brands_filled b ON r.brandid = b.brandid LEFT JOIN people p ON r.customerid = p.customerid""",
    ),
)
def enriched_reviews(spark, d):
    return retail.enriched_reviews(model.reviews(spark, d), model.brands(spark, d), model.retail_customers(spark, d))


NAMED = f"""{REVIEWS}, {BRANDS}, named AS (
  SELECT r.*, brandname, coalesce(length(review), 1) AS w FROM reviews r LEFT JOIN brands b ON r.brandid = b.brandid)"""


@query(
    "weighted_average",
    sql(
        NAMED,
        """SELECT brandname, round((sum(starrating * w)::DOUBLE / sum(w)::DOUBLE)::DECIMAL(28,8), 6) AS "Weighted Average"
FROM named GROUP BY 1""",
        d="Weighted Average",
    ),
)
def weighted_average(spark, d):
    out = retail.weighted_rating(model.reviews(spark, d), model.brands(spark, d))
    return out.withColumn("Weighted Average", F.round(F.col("Weighted Average").cast("decimal(28,8)"), 6))


def _crossed(method: str):
    return lambda spark, d: retail.rating_cross_tab(model.reviews(spark, d), model.brands(spark, d), method)


_COUNTS = [f"count(*) FILTER (WHERE starrating = {i})" for i in range(1, 6)]
query(
    "rating_cross_tab",
    sql(
        NAMED,
        "SELECT brandname, " + ", ".join(f'{c} AS "Rating_{i}"' for i, c in enumerate(_COUNTS, 1)) + " FROM named GROUP BY 1",
    ),
)(_crossed("count"))


@query(
    "rating_cross_tab_pct",
    sql(
        NAMED,
        "SELECT brandname, "
        + ", ".join(f'{ratio(c, "count(*)", 4, 100)} AS "Rating_{i}"' for i, c in enumerate(_COUNTS, 1))
        + " FROM named GROUP BY 1",
        d=", ".join(f"Rating_{i}" for i in range(1, 6)),
    ),
)
def rating_cross_tab_pct(spark, d):
    out = _crossed("percent")(spark, d)
    return out.withColumns({c: F.round(F.col(c).cast("decimal(28,6)"), 4) for c in out.columns[1:]})


# --- engagement ------------------------------------------------------------------------------

@query(
    "review_engagement_rate",
    """WITH n AS (SELECT (SELECT count(DISTINCT user_id) FROM events JOIN customer ON user_id = c_custkey) AS a,
  (SELECT count(*) FROM customer) AS b)
SELECT a AS "Customers with Reviews", b AS "Total Customers",
  "left"(regexp_replace(((a * 1000000 // b)::DECIMAL(28,0) * 0.0001::DECIMAL(5,4))::VARCHAR, '\\.?0+$', ''), 4) || '%' AS "% of Customers with Reviews" FROM n""",
)
def review_engagement_rate(spark, d):
    return retail.review_engagement(model.retail_customers(spark, d), model.reviews(spark, d))
