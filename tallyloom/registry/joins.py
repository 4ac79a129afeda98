"""Queries of the join operators and the small join flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import aggs, joins, rows
from tallyloom.plans import retail
from tallyloom.registry import query
from tallyloom.registry.rows import STATE_VALUES
from tallyloom.registry.sql import BRANDS_FILLED, PEOPLE, PREPARED, REVIEWS, UNITS, sql
from tallyloom.sources import model

# Two whole tables whose ids overlap in part, so both sides have rows without a partner.
DOCS = "docs AS (SELECT page_id AS doc_id, url FROM pages)"


def _sides(spark, d):
    docs = model.table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), "url")
    return docs, model.table(spark, d, "labels")


def _join(name: str, how: str, keyword: str) -> None:
    text = sql(
        DOCS,
        f"""SELECT coalesce(docs.doc_id, labels.doc_id) AS doc_id, url, quality, toxic
FROM docs {keyword} JOIN labels ON docs.doc_id = labels.doc_id""",
    )
    query(name, text)(lambda spark, d: joins.join_dfs(*_sides(spark, d), "doc_id", how))


_join("join_inner", "inner", "INNER")
_join("join_left", "left", "LEFT")
_join("join_right", "right", "RIGHT")
_join("join_full", "full", "FULL")


@query("join_semi", sql(DOCS, "SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)"))
def join_semi(spark, d):
    return joins.join_dfs(*_sides(spark, d), "doc_id", "semi")


@query("join_anti", sql(DOCS, "SELECT * FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM labels)"))
def join_anti(spark, d):
    return joins.join_dfs(*_sides(spark, d), "doc_id", "anti")


@query("join_stream_left", sql(DOCS, "SELECT * FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM labels)"))
def join_stream_left(spark, d):
    return joins.join_streams(*_sides(spark, d), "doc_id")[1]


@query("join_stream_right", sql(DOCS, "SELECT * FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM docs)"))
def join_stream_right(spark, d):
    return joins.join_streams(*_sides(spark, d), "doc_id")[2]


@query(
    "union_by_name",
    """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def union_by_name(spark, d):
    customers = model.table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = model.table(spark, d, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    return joins.union_by_name(customers, suppliers)


@query(
    "join_product",
    sql(
        f"{PREPARED}, {UNITS}",
        """SELECT "Transaction ID", "Product ID", brandid, containertype, purchasedate
FROM prepared JOIN units ON "Product ID" = productid""",
    ),
)
def join_product(spark, d):
    tx = retail.prepare_transactions(model.retail_transactions(spark, d), {})
    tx = tx.select("Transaction ID", "Product ID")
    wanted = ["brandid", "containertype", "purchasedate"]
    return joins.join_on(tx, model.stock_units(spark, d), {"Product ID": "productid"}, "inner", wanted)


@query(
    "brand_transactions",
    sql(
        f"{PREPARED}, {UNITS}, {BRANDS_FILLED}",
        """SELECT "Transaction ID", u.brandid, brandname, b.city AS brand_city, b.state AS brand_state, website,
  facebookpage, twitter
FROM prepared JOIN units u ON "Product ID" = productid JOIN brands_filled b ON u.brandid = b.brandid""",
    ),
)
def brand_transactions(spark, d):
    tx = retail.prepare_transactions(model.retail_transactions(spark, d), {})
    tx = retail.with_product(tx, model.stock_units(spark, d)).select("Transaction ID", "brandid")
    return retail.join_brand(tx, model.brands(spark, d))


@query(
    "reviews_with_brand",
    sql(
        f"{REVIEWS}, {BRANDS_FILLED}",
        """SELECT r.*, brandname, description, website FROM reviews r LEFT JOIN brands_filled b ON r.brandid = b.brandid""",
    ),
)
def reviews_with_brand(spark, d):
    return retail.reviews_with_brand(model.reviews(spark, d), model.brands(spark, d))


@query(
    "reviews_customers_joined",
    sql(
        f"{REVIEWS}, {PEOPLE}",
        """SELECT r.customerid, r.reviewkey AS rev_reviewkey, r.starrating AS rev_starrating, p.firstname AS cust_firstname,
  p.lastname AS cust_lastname, c_mktsegment AS seg_segment
FROM reviews r JOIN people p ON r.customerid = p.customerid JOIN customer ON c_custkey = r.customerid""",
    ),
)
def reviews_customers_joined(spark, d):
    """Three inputs that must all match, columns prefixed by their input."""
    segments = model.table(spark, d, "customer").select(F.col("c_custkey").alias("customerid"), F.col("c_mktsegment").alias("segment"))
    tables = {
        "rev_": model.reviews(spark, d).select("customerid", "reviewkey", "starrating"),
        "cust_": model.retail_customers(spark, d).select("customerid", "firstname", "lastname"),
        "seg_": segments,
    }
    return joins.join_multiple(tables, "customerid")


@query(
    "customer_review_join",
    sql(
        f"{REVIEWS}, {PEOPLE}, {STATE_VALUES}",
        """SELECT p.customerid, p.firstname, coalesce(name, p.state) AS state, r.reviewkey, r.brandid, r.starrating,
  r.reviewdate, r.review
FROM people p LEFT JOIN reviews r ON p.customerid = r.customerid LEFT JOIN names ON p.state = code""",
    ),
)
def customer_review_join(spark, d):
    from tallyloom.functions.lookups import US_STATES

    customers = model.retail_customers(spark, d).select("customerid", "firstname", "state")
    return joins.customer_review_join(customers, model.reviews(spark, d), US_STATES)


# --- small flows -----------------------------------------------------------------------------

@query("flow_simple", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 30")
def flow_simple(spark, d):
    df = model.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return rows.filter_rows(df, "c_acctbal > 30")


ORDERS_SQL = """customers AS (
  SELECT c_custkey AS customer_id, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _countries(spark, d):
    people = model.table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
    nations = model.table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return joins.join_on(people, nations, {"c_nationkey": "n_nationkey"}).select("customer_id", "country")


@query(
    "flow_medium",
    sql(
        ORDERS_SQL,
        """SELECT country, sum(o_totalprice::DECIMAL(18,2)) AS total_amount
FROM orders JOIN customers ON o_custkey = customer_id WHERE o_totalprice > 100 GROUP BY 1""",
        d="total_amount",
    ),
)
def flow_medium(spark, d):
    orders = model.table(spark, d, "orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"))
    df = joins.join_dfs(orders, _countries(spark, d), "customer_id")
    df = rows.filter_rows(rows.cast_cols(df, {"amount": "decimal(18,2)"}), "amount > 100")
    return aggs.summarize(df, "country", {"total_amount": ("amount", "sum")})


@query(
    "flow_complex",
    sql(
        ORDERS_SQL,
        """SELECT country, sum(l_extendedprice::DECIMAL(18,2) * 0.9) AS total_discounted_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customers ON o_custkey = customer_id
JOIN part ON l_partkey = p_partkey GROUP BY 1""",
        d="total_discounted_amount",
    ),
)
def flow_complex(spark, d):
    lines = model.retail_transactions(spark, d).select(
        F.col("customerid").alias("customer_id"), F.col("productid").alias("product_id"), F.col("purchaseprice").alias("amount")
    )
    products = model.products(spark, d).select(F.col("ProductID").alias("product_id"))
    df = joins.join_dfs(lines, _countries(spark, d), "customer_id")
    df = joins.join_dfs(df, products, "product_id")
    df = rows.add_column(df, "discounted_amount", "amount * 0.9")
    return aggs.summarize(df, "country", {"total_discounted_amount": ("discounted_amount", "sum")})
