"""Queries of the row operators: filters, projections, casts, cleaning, imputation, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import formulas as fx
from tallyloom.functions.lookups import CARD_FEES, US_STATES
from tallyloom.operators import aggs, joins, rows, windows
from tallyloom.plans import retail
from tallyloom.registry import query
from tallyloom.registry.sql import BRANDS_FILLED, PEOPLE, PREPARED, RAW, REVIEWS, money, sql
from tallyloom.sources import files, model


# --- filters and projections -----------------------------------------------------------------

@query(
    "filter_rows",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 1000 AND c_mktsegment <> 'BUILDING'",
)
def filter_rows(spark, d):
    df = model.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return rows.filter_rows(df, "c_acctbal > 1000 and c_mktsegment <> 'BUILDING'")


@query("filter_not_null", sql(REVIEWS, "SELECT * FROM reviews WHERE review IS NOT NULL"))
def filter_not_null(spark, d):
    return rows.filter_rows(model.reviews(spark, d), F.col("review").isNotNull())


@query(
    "standardise_columns",
    """SELECT o_orderdate::DATE AS "OrderDate", o_orderkey AS "OrderID", o_custkey AS "CustomerID", o_orderstatus,
  o_totalprice FROM orders""",
)
def standardise_columns(spark, d):
    """Reorder, rename, drop the priority and pass the columns not named through."""
    orders = model.table(spark, d, "orders").drop("o_orderpriority")
    orders = orders.withColumn("o_orderdate", F.to_date("o_orderdate"))
    names = {"o_orderdate": "OrderDate", "o_orderkey": "OrderID", "o_custkey": "CustomerID"}
    return rows.select_cols(orders, list(names), names, keep_rest=True)


@query(
    "cast_cols",
    """SELECT l_orderkey, l_linenumber::VARCHAR AS l_linenumber, l_quantity::BIGINT AS l_quantity,
  l_shipdate::DATE AS l_shipdate, try_cast(l_returnflag AS BIGINT) AS l_returnflag FROM lineitem""",
)
def cast_cols(spark, d):
    df = model.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag"
    )
    df = rows.cast_cols(df, {"l_linenumber": "string", "l_quantity": "bigint", "l_shipdate": "date"})
    return rows.cast_cols(df, {"l_returnflag": "bigint"}, strict=False)


@query(
    "discounted_amount",
    "SELECT o_orderkey, (o_totalprice::DECIMAL(18,2) * 0.9)::DOUBLE AS discounted_amount FROM orders",
)
def discounted_amount(spark, d):
    df = rows.cast_cols(model.table(spark, d, "orders"), {"o_totalprice": "decimal(18,2)"})
    return rows.add_column(df, "discounted_amount", "o_totalprice * 0.9").select("o_orderkey", "discounted_amount")


@query("backfill_urls", sql(BRANDS_FILLED, "SELECT brandid, brandname, website, facebookpage, twitter FROM brands_filled"))
def backfill_urls(spark, d):
    brands = rows.backfill_urls(model.brands(spark, d))
    return brands.select("brandid", "brandname", "website", "facebookpage", "twitter")


@query(
    "sanitize_columns",
    sql(
        PREPARED,
        """SELECT "Transaction ID" AS "Transaction_ID", "Credit Card Type" AS "Credit_Card_Type",
  "Purchase Price" AS "Purchase_Price" FROM prepared""",
        d="Purchase_Price",
    ),
)
def sanitize_columns(spark, d):
    from tallyloom.operators.sinks import sanitize_columns as clean

    types = {"Transaction Date": "date"}
    df = retail.prepare_transactions(model.retail_transactions(spark, d), types)
    return clean(df.select("Transaction ID", "Credit Card Type", "Purchase Price"))


@query(
    "infer_types_profile",
    """WITH t AS (SELECT max(l_linenumber) AS n, max(l_orderkey) AS k FROM lineitem),
w(v, n) AS (SELECT 'line', n FROM t UNION ALL SELECT 'order', k FROM t)
SELECT v AS "ColumnName", CASE WHEN n < 128 THEN 'tinyint' WHEN n < 32768 THEN 'smallint'
  WHEN n < 2147483648 THEN 'int' ELSE 'bigint' END AS "DataType" FROM w
UNION ALL VALUES ('card', 'bigint'), ('price', 'double'), ('shipped', 'date'), ('flag', 'string'), ('nothing', 'string')""",
)
def infer_types_profile(spark, d):
    """The narrowest types of columns that arrive as text."""
    text = model.table(spark, d, "lineitem").select(
        F.col("l_linenumber").cast("string").alias("line"),
        F.col("l_orderkey").cast("string").alias("order"),
        (F.col("l_orderkey") + F.lit(4000000000000000)).cast("string").alias("card"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.to_date("l_shipdate").cast("string").alias("shipped"),
        F.col("l_returnflag").alias("flag"),
        F.lit(None).cast("string").alias("nothing"),
    )
    return rows.infer_types_profile(text)


@query("drop_nulls", sql(REVIEWS, "SELECT reviewkey, customerid, review FROM reviews WHERE review IS NOT NULL"))
def drop_nulls(spark, d):
    return rows.drop_nulls(model.reviews(spark, d).select("reviewkey", "customerid", "review"), ["review"])


# --- distinct and unique ---------------------------------------------------------------------

@query("distinct_card_types", sql(RAW, "SELECT DISTINCT creditcardtype FROM raw"))
def distinct_card_types(spark, d):
    return aggs.distinct_keys(model.retail_transactions(spark, d), "creditcardtype")


@query(
    "distinct_rows",
    "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",
)
def distinct_rows(spark, d):
    return rows.drop_duplicates(model.table(spark, d, "orders").select("o_custkey", "o_orderstatus"))


@query(
    "unique_customers",
    sql(
        REVIEWS,
        """SELECT * FROM reviews
QUALIFY row_number() OVER (PARTITION BY customerid ORDER BY reviewdate, reviewkey) = 1""",
    ),
)
def unique_customers(spark, d):
    return rows.unique_by(model.reviews(spark, d), ["customerid"], ["reviewdate", "reviewkey"])[0]


@query(
    "duplicate_orders",
    """SELECT o_custkey, o_orderdate::DATE AS orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) > 1""",
)
def duplicate_orders(spark, d):
    """Orders of a customer on a day after the first one of that day."""
    orders = model.table(spark, d, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("orderdate"), "o_orderkey", "o_totalprice"
    )
    return rows.unique_by(orders, ["o_custkey", "orderdate"], ["o_orderkey"])[1]


# --- imputation ------------------------------------------------------------------------------

GAPPY = """gappy AS (
  SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal::DECIMAL(18,2) END AS v, c_nationkey FROM customer)"""


def _gappy(spark, d):
    """Customer balances, the negative ones taken as unknown."""
    v = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(18,2)")).alias("v")
    return model.table(spark, d, "customer").select("c_custkey", v)


def _imputed(strategy: str, fill: str, **options) -> None:
    text = sql(
        GAPPY,
        f"SELECT c_custkey, {money(f'coalesce(v, ({fill})::DECIMAL(28,6))')} AS v, v IS NULL AS imputed FROM gappy",
        d="v",
    )

    def run(spark, d):
        df = rows.impute(_gappy(spark, d), "v", strategy, indicator="imputed", **options)
        return df.withColumn("v", fx.money(F.col("v").cast("decimal(28,6)")))

    query(f"impute_{strategy}", text)(run)


_imputed("constant", "0", value=0)
_imputed("mean", "SELECT avg(v) FROM gappy")
_imputed(
    "median",
    """SELECT avg(v) FROM (SELECT v, row_number() OVER (ORDER BY v) AS r, count(*) OVER () AS n FROM gappy WHERE v IS NOT NULL)
  WHERE r IN ((n + 1) // 2, (n + 2) // 2)""",
)
_imputed("mode", "SELECT v FROM gappy WHERE v IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1")


# --- text ------------------------------------------------------------------------------------

@query(
    "cleanse_text",
    r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents",
)
def cleanse_text(spark, d):
    return rows.cleanse_text(model.table(spark, d, "documents").select("doc_id", "text"), "text")


@query("strip_non_printable", "SELECT doc_id, regexp_replace(text, '[^ -~]', '', 'g') AS text FROM documents")
def strip_non_printable(spark, d):
    return model.table(spark, d, "documents").select("doc_id", fx.strip_non_printable("text").alias("text"))


@query("review_length", sql(REVIEWS, 'SELECT reviewkey, coalesce(length(review), 1) AS "Length" FROM reviews'))
def review_length(spark, d):
    return model.reviews(spark, d).select("reviewkey", fx.text_length("review").alias("Length"))


@query("full_name", sql(PEOPLE, "SELECT customerid, firstname || ' ' || lastname AS fullname FROM people"))
def full_name(spark, d):
    return model.retail_customers(spark, d).select("customerid", fx.full_name("firstname", "lastname").alias("fullname"))


@query(
    "split_to_columns",
    sql(
        REVIEWS,
        """SELECT reviewkey, split_part(reviewdate::VARCHAR, '-', 1) AS "Year", split_part(reviewdate::VARCHAR, '-', 2) AS "Month",
  split_part(reviewdate::VARCHAR, '-', 3) AS "Day" FROM reviews""",
    ),
)
def split_to_columns(spark, d):
    text = F.col("reviewdate").cast("string")
    parts = [fx.split_part(text, "-", 3, i).alias(name) for i, name in enumerate(("Year", "Month", "Day"), 1)]
    return model.reviews(spark, d).select("reviewkey", *parts)


@query(
    "parse_date",
    sql(
        PEOPLE,
        """SELECT customerid, firstpurchasedate, try_strptime(firstpurchasedate, '%m/%d/%Y')::DATE AS first_purchase
FROM people""",
    ),
)
def parse_date(spark, d):
    return model.retail_customers(spark, d).select(
        "customerid", "firstpurchasedate", fx.parse_date("firstpurchasedate").alias("first_purchase")
    )


@query(
    "as_of_date",
    """SELECT n_nationkey, n_name, DATE '2024-06-30' AS "As_Of_Date", '06-30-2024' AS "As_Of_Text" FROM nation""",
)
def as_of_date(spark, d):
    nations = model.table(spark, d, "nation").select("n_nationkey", "n_name")
    return nations.withColumns(
        {"As_Of_Date": fx.as_of_date("2024-06-30"), "As_Of_Text": fx.as_of_date("2024-06-30", text=True)}
    )


# --- lookups ---------------------------------------------------------------------------------

@query(
    "card_fee_lookup",
    sql(
        RAW + ", fees(card, fee) AS (VALUES "
        + ", ".join(f"('{k}', {v}::DECIMAL(4,3))" for k, v in CARD_FEES.items()) + ")",
        """SELECT creditcardtype, count(*) AS transactions, sum(purchaseprice * fee) AS fees
FROM raw LEFT JOIN fees ON creditcardtype = card GROUP BY 1""",
        d="fees",
    ),
)
def card_fee_lookup(spark, d):
    """Card fees per card type, from the inline fee table; a type without a fee keeps NULL."""
    fees = [(card, str(fee)) for card, fee in CARD_FEES.items()]
    fees = files.inline_table(spark, fees, "creditcardtype string, fee string")
    fees = rows.cast_cols(fees, {"fee": "decimal(4,3)"})
    tx = joins.join_dim(model.retail_transactions(spark, d), fees, "creditcardtype")
    tx = tx.withColumn("due", F.col("purchaseprice") * F.col("fee"))
    return aggs.summarize(tx, "creditcardtype", {"transactions": ("*", "count"), "fees": ("due", "sum")})


STATE_VALUES = "names(code, name) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in US_STATES.items()) + ")"


@query(
    "state_lookup",
    sql(
        f"{PEOPLE}, {STATE_VALUES}",
        "SELECT state, name, count(*) AS customers FROM people LEFT JOIN names ON state = code GROUP BY 1, 2",
    ),
)
def state_lookup(spark, d):
    """Customers per state with the state's name from the inline list."""
    names = files.inline_table(spark, list(US_STATES.items()), "state string, name string")
    counts = model.retail_customers(spark, d).groupBy("state").agg(F.count(F.lit(1)).alias("customers"))
    return joins.join_dim(counts, names, "state")


@query(
    "state_name_lookup",
    sql(
        f"{PEOPLE}, {STATE_VALUES}",
        "SELECT customerid, coalesce(name, state) AS state FROM people LEFT JOIN names ON upper(trim(state)) = code",
    ),
)
def state_name_lookup(spark, d):
    return retail.customers_with_state_names(model.retail_customers(spark, d).select("customerid", "state"))


@query(
    "name_words_lookup",
    """WITH words AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS key FROM part UNION SELECT p_name FROM part WHERE p_size = 1),
pattern AS (SELECT '(' || string_agg(regexp_escape(key), '|' ORDER BY length(key) DESC, key) || ')' AS found FROM words WHERE key <> '')
SELECT p_partkey, regexp_replace(p_name || '/' || p_type, found, '[*]', 'gi') AS marked FROM part, pattern""",
)
def name_words_lookup(spark, d):
    """Part texts with every name word, and the whole names of parts of size 1, taken out for a mark."""
    part = model.table(spark, d, "part")
    words = part.select(F.explode(F.split("p_name", " ")).alias("key")).union(part.filter("p_size = 1").select("p_name"))
    words = words.distinct().withColumn("put", F.lit("[*]"))
    texts = part.select("p_partkey", F.concat_ws("/", "p_name", "p_type").alias("marked"))
    return joins.lookup_replace_inside(texts, "marked", words, "key", "put")


# --- order, numbers, ranges ------------------------------------------------------------------

@query(
    "record_id",
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS "RecordID", o_orderkey, o_orderdate::DATE AS orderdate
FROM orders""",
)
def record_id(spark, d):
    orders = model.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("orderdate"))
    return windows.record_id(orders, ["orderdate", "o_orderkey"])


@query(
    "select_row_ranges",
    """SELECT o_orderkey, o_orderdate::DATE AS orderdate FROM orders
QUALIFY row_number() OVER (ORDER BY o_orderdate, o_orderkey) NOT BETWEEN 11 AND 29""",
)
def select_row_ranges(spark, d):
    """Rows 1-10 and 30 onwards, in date order."""
    orders = model.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("orderdate"))
    return windows.select_ranges(orders, [(1, 10), (30, None)], ["orderdate", "o_orderkey"])


@query(
    "zip_by_position",
    """WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS p FROM customer),
b AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS p FROM supplier)
SELECT coalesce(a.p, b.p) AS "Position", c_custkey, s_suppkey FROM a FULL JOIN b ON a.p = b.p""",
)
def zip_by_position(spark, d):
    customers = model.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    suppliers = model.table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    zipped = windows.zip_by_position([(customers, ["c_acctbal", "c_custkey"]), (suppliers, ["s_acctbal", "s_suppkey"])])
    return zipped.select("Position", "c_custkey", "s_suppkey")


@query(
    "customer_running_total",
    """SELECT o_custkey, o_orderkey, (sum(o_totalprice::DECIMAL(18,2)) OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING))::DOUBLE AS running FROM orders""",
)
def customer_running_total(spark, d):
    orders = model.table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    out = windows.running_total(orders, "price", ["o_orderdate", "o_orderkey"], ["o_custkey"], "running")
    return out.select("o_custkey", "o_orderkey", "running")


@query(
    "first_review_per_brand_rating",
    sql(
        REVIEWS,
        """SELECT * FROM reviews
QUALIFY row_number() OVER (PARTITION BY brandid, starrating ORDER BY reviewdate, reviewkey) = 1""",
    ),
)
def first_review_per_brand_rating(spark, d):
    return windows.first_n(model.reviews(spark, d), ["brandid", "starrating"], 1, ["reviewdate", "reviewkey"])


# --- aggregates ------------------------------------------------------------------------------

@query(
    "summarize_basic",
    "SELECT c_mktsegment, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS total, count(c_custkey) AS customers FROM customer GROUP BY 1",
)
def summarize_basic(spark, d):
    df = rows.cast_cols(model.table(spark, d, "customer"), {"c_acctbal": "decimal(18,2)"})
    return aggs.summarize(df, "c_mktsegment", {"total": ("c_acctbal", "sum"), "customers": ("c_custkey", "count")})


@query(
    "summarize_multi",
    """SELECT o_orderstatus, o_orderpriority, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total,
  round(avg(o_totalprice::DECIMAL(18,2))::DECIMAL(28,6), 2)::DOUBLE AS mean, min(o_totalprice) AS low,
  max(o_totalprice) AS high, count(*) AS orders, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1, 2""",
)
def summarize_multi(spark, d):
    df = model.table(spark, d, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    out = aggs.summarize(
        df,
        ["o_orderstatus", "o_orderpriority"],
        {
            "total": ("price", "sum"),
            "mean": ("price", "avg"),
            "low": ("o_totalprice", "min"),
            "high": ("o_totalprice", "max"),
            "orders": ("*", "count"),
            "customers": ("o_custkey", "countDistinct"),
        },
    )
    return out.withColumn("mean", F.round("mean", 2))


@query(
    "append_scalar",
    """SELECT o_orderkey, o_totalprice, (SELECT sum(o_totalprice::DECIMAL(18,2))::DOUBLE FROM orders) AS total,
  (SELECT count(*) FROM orders) AS orders FROM orders""",
)
def append_scalar(spark, d):
    orders = model.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    totals = orders.agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"), F.count(F.lit(1)).alias("orders"))
    return joins.append_fields(orders, totals)


@query(
    "append_rows",
    """SELECT c_custkey, c_mktsegment, status, orders, revenue FROM customer, (
    SELECT o_orderstatus AS status, count(*) AS orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS revenue FROM orders GROUP BY 1)""",
)
def append_rows(spark, d):
    """Customers with the totals of every order status."""
    customers = model.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    totals = model.table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue")
    )
    return joins.append_fields(customers, totals, max_rows=16)
