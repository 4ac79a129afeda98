"""The driver's star-schema tables, seen as the sales and the retail model.

Every function takes ``(spark, sf_dir)`` and plans a scan with plain column expressions. What the
tables lack (quotas, targets, coordinates) is a formula of their keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions import formulas as fx
from tallyloom.functions.lookups import US_STATES
from tallyloom.operators.joins import join_on

# Payment method and card type stand in for the five order priorities.
PAYMENT = {
    "1-URGENT": "Wire Transfer",
    "2-HIGH": "Wire Transfer",
    "3-MEDIUM": "Credit Card",
    "4-NOT SPECIFIED": "Credit Card",
}
CARD = {
    "1-URGENT": "Visa",
    "2-HIGH": "MasterCard",
    "3-MEDIUM": "Discover",
    "4-NOT SPECIFIED": "American Express",
}
STATE_CODES = list(US_STATES)


# Declared, so that opening a table reads no file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec6(c):
    return c.cast("decimal(18,6)")


def _lines(spark: SparkSession, sf_dir: str, dims: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Lines with their order. Both grow with the business, so they meet by shuffle at any size."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    for key, dim in (dims or {}).items():
        if key in ORDER_DIMS:
            orders = join_on(orders, dim, {ORDER_DIMS[key]: key}, "left")
        else:
            lines = join_on(lines, dim, {LINE_DIMS[key]: key}, "left")
    return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))


# --- sales model -----------------------------------------------------------------------------

# The columns that hold the keys of the dimensions.
ORDER_DIMS = {"CustomerID": "o_custkey"}
LINE_DIMS = {"ProductID": "l_partkey", "SalesRepID": "l_suppkey"}
LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def sales_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_transaction_id(sales_lines(spark, sf_dir))


def with_transaction_id(lines: DataFrame) -> DataFrame:
    """``TransactionID``, made of the keys of ``sales_lines``, in front of the other columns in place of the line number."""
    key = F.concat_ws("-", "OrderID", "LineNumber", "ProductID", "SalesRepID").alias("TransactionID")
    return lines.select(key, *[F.col(f"`{c}`") for c in lines.columns if c != "LineNumber"])


def sales_lines(spark: SparkSession, sf_dir: str, dims: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The sales transactions with a line number in place of the longer id, for joins that shuffle them.

    ``dims``, by their keys, are joined in that order before lines and orders meet: an order has several lines, and lines
    alone are narrower than with their order. Their columns come last.
    """
    added = [c for key, dim in (dims or {}).items() for c in dim.columns if c != key]
    return _lines(spark, sf_dir, dims).select(
        F.col("l_linenumber").alias("LineNumber"),
        F.col("l_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_suppkey").alias("SalesRepID"),
        F.to_date("o_orderdate").alias("TransactionDate"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        fx.money(_dec6(F.col("l_extendedprice") / F.col("l_quantity"))).alias("UnitPrice"),
        F.col("l_discount").cast("decimal(4,2)").alias("Discount"),
        fx.value_map("o_orderpriority", PAYMENT, "PayPal").alias("PaymentMethod"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("ReturnFlag"),
        *[F.col(f"`{c}`") for c in added],
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("CustomerName"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("r_name").alias("Region"),
        F.col("n_name").alias("Country"),
        state_code("c_custkey").alias("State"),
        F.concat(F.lit("City "), (F.col("c_custkey") % 100).cast("string")).alias("City"),
        fx.money(F.col("c_acctbal").cast(fx.MONEY) * 10).alias("CreditLimit"),
        F.date_sub(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int")).alias("AccountOpenDate"),
        F.when(F.col("c_custkey") % 2 == 0, "Credit Card").otherwise("PayPal").alias("PreferredPayment"),
    )


def state_code(key: str):
    """A state abbreviation; every 52nd key has the unknown code ZZ and every 53rd none."""
    slot = (F.col(key) % 53).cast("int") + 1
    return F.try_element_at(F.split(F.lit(",".join([*STATE_CODES, "ZZ"])), ","), slot)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast(fx.MONEY)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
        F.concat(F.lit("Size "), F.col("p_size").cast("string")).alias("SubCategory"),
        F.col("p_brand").alias("Brand"),
        fx.money(price * F.lit("0.60").cast("decimal(3,2)")).alias("CostPrice"),
        price.alias("MSRP"),
        (F.col("p_size") % 3 * 12 + 12).alias("WarrantyMonths"),
    )


def sales_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    cents = F.lit("0.01").cast("decimal(3,2)")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("SalesRepID"),
        F.col("s_name").alias("RepName"),
        F.col("n_name").alias("Territory"),
        ((F.col("s_suppkey") % 3 + 7).cast("int") * cents).cast("decimal(6,4)").alias("CommissionRate"),
        (F.col("s_suppkey") % 7 * 3000000 + 10000000).alias("YTDQuota"),
    )


def regional_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = F.array(*[F.lit(y) for y in range(1995, 2002)])
    quarters = F.array(*[F.lit(q) for q in range(1, 5)])
    grid = table(spark, sf_dir, "region").select("*", F.explode(years).alias("Year"))
    grid = grid.select("*", F.explode(quarters).alias("q"))
    return grid.select(
        F.col("r_name").alias("Region"),
        "Year",
        F.concat(F.lit("Q"), F.col("q").cast("string")).alias("Quarter"),
        (12000000 + F.col("r_regionkey") * 1000000 + F.col("q") * 250000 + (F.col("Year") - 1995) * 100000).alias(
            "RevenueTarget"
        ),
        (7000 + F.col("q") * 100).alias("UnitTarget"),
        F.lit("0.85").cast("decimal(4,2)").alias("RetentionTarget"),
    )


# --- retail model ----------------------------------------------------------------------------

def retail_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw till transactions; location 0 is the lost store."""
    return _lines(spark, sf_dir).select(
        F.concat_ws("-", *LINE_KEY).alias("transactionid"),
        (F.col("o_orderkey") + F.lit(4000000000000000)).alias("creditcardnumber"),
        fx.value_map("o_orderpriority", CARD, "Cash").alias("creditcardtype"),
        F.col("o_custkey").alias("customerid"),
        F.to_date("o_orderdate").alias("transactiondate"),
        (F.col("l_orderkey") % 26).alias("locationid"),
        F.col("l_partkey").alias("productid"),
        F.col("l_extendedprice").cast(fx.MONEY).alias("purchaseprice"),
    )


def stock_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("productid"),
        F.substring_index("p_brand", "#", -1).cast("int").alias("brandid"),
        F.col("p_type").alias("containertype"),
        (F.col("p_partkey") % 26).alias("locationid"),
        F.date_add(F.lit("1994-01-01").cast("date"), (F.col("p_partkey") % 365).cast("int")).alias("purchasedate"),
    )


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per brand seen in the stock; some links are missing, some blank."""
    name = F.col("p_brand")
    number = F.substring_index(name, "#", -1).cast("int")
    seen = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min("p_retailprice").alias("low"))
    link = F.concat(F.lit("http://brand"), number.cast("string"), F.lit(".example.com"))
    return seen.select(
        number.alias("brandid"),
        name.alias("brandname"),
        F.concat(F.lit("Brew City "), (number % 7).cast("string")).alias("city"),
        F.element_at(F.split(F.lit(",".join(STATE_CODES)), ","), number % 51 + 1).alias("state"),
        F.concat(F.lit("  The  "), name, F.lit("\tsoda \n café ")).alias("description"),
        F.when(number % 3 == 0, F.lit(None)).when(number % 3 == 1, F.lit("  ")).otherwise(link).alias("website"),
        F.when(number % 4 == 0, F.lit(None)).otherwise(link).alias("facebookpage"),
        F.when(number % 5 == 0, F.lit("")).otherwise(link).alias("twitter"),
        F.col("low").cast(fx.MONEY).alias("currentretailprice"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per event; ``reviewkey`` breaks ties in every order."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("reviewkey"),
        F.col("user_id").alias("customerid"),
        (F.col("event_id") % 25 + 1).cast("int").alias("brandid"),
        (F.floor(F.col("event_id") / 25) % 5 + 1).cast("int").alias("starrating"),
        F.to_date("ts").alias("reviewdate"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("review"),
    )


def retail_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    first_buy = F.date_add(F.lit("1994-01-01").cast("date"), (key % 900).cast("int"))
    return table(spark, sf_dir, "customer").select(
        key.alias("customerid"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("firstname"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("lastname"),
        state_code("c_custkey").alias("state"),
        F.lpad((key % 99999).cast("string"), 5, "0").alias("zipcode"),
        F.when(key % 10 == 0, F.lit("13/45/2020"))
        .otherwise(F.date_format(first_buy, "MM/dd/yyyy"))
        .alias("firstpurchasedate"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store coordinates, one store per nation, plus the lost store 0 at (0, 0)."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    stores = nation.select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("locationid"),
        (F.col("n_nationkey") * 37 % 120 - 60 + F.lit(0.25)).alias("latitude"),
        (F.col("n_nationkey") * 61 % 340 - 170 + F.lit(0.5)).alias("longitude"),
    )
    lost = region.filter("r_regionkey = 0").select(
        F.lit(0).cast("bigint").alias("locationid"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude")
    )
    wkt = F.concat(
        F.lit("POINT("), _coordinate("longitude"), F.lit(" "), _coordinate("latitude"), F.lit(")")
    )
    return stores.unionByName(lost).withColumn("location", wkt)


def _coordinate(name: str):
    return F.col(name).cast("decimal(9,2)").cast("string")


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    stores = nation.select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("locationid"),
        F.concat(F.lit("Store "), F.col("n_name")).alias("locationname"),
    )
    lost = region.filter("r_regionkey = 0").select(
        F.lit(0).cast("bigint").alias("locationid"), F.lit("LOST").alias("locationname")
    )
    return stores.unionByName(lost)


def geocoded_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers placed around the store of their nation, up to some twenty miles away."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("original_customerid"),
        (nation + 1).cast("bigint").alias("homestore"),
        (nation * 37 % 120 - 60 + F.lit(0.25) + (key % 41 - 20) * F.lit(0.01)).alias("lat"),
        (nation * 61 % 340 - 170 + F.lit(0.5) + (key % 37 - 18) * F.lit(0.01)).alias("lon"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real stores for distance work; the lost one is left out."""
    geo = geolocation(spark, sf_dir).filter("locationid != 0")
    return geo.select(
        F.col("locationid").alias("storeid"),
        F.col("latitude").alias("store_lat"),
        F.col("longitude").alias("store_lon"),
    )


def weekly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per week (from Monday), as the stand-in for weekly search interest."""
    week = F.to_date(F.date_trunc("week", "o_orderdate"))
    return table(spark, sf_dir, "orders").groupBy(week.alias("Week")).agg(
        F.count(F.lit(1)).cast("int").alias("interest")
    )
