"""Queries of the sales pipeline: formula blocks, staging, enrichment, the four reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions import formulas as fx
from tallyloom.operators import aggs, joins
from tallyloom.operators.sinks import write_output
from tallyloom.plans import sales
from tallyloom.registry import query
from tallyloom.registry.sql import (
    COMMISSION_EDGES, CUSTOMER_EDGES, CUSTOMERS, DASHBOARD, DEAL_EDGES, ENRICHED, FEATURES, KPI, PERFORMANCE,
    STAGING, STAR, TARGETS, TX, bands, money, rep_report, sql,
)
from tallyloom.session import fresh_path
from tallyloom.sources import model

# Line revenue of the test tables is some thirty times that of the sample the default edges fit.
RULES = sales.SalesRules(
    deal_tiers=DEAL_EDGES, commission_bands=COMMISSION_EDGES, customer_bands=CUSTOMER_EDGES
)

MONEY_IN = "UnitPrice, DiscountRate, DiscountAmount, GrossRevenue, NetRevenue"
STAR_MONEY = MONEY_IN + ", CreditLimit, CostPrice, MSRP, CommissionRate, RetentionTarget"
STAR_INTS = "Year, Quantity, WarrantyMonths, YTDQuota, RevenueTarget, UnitTarget"
FULL_MONEY = (
    STAR_MONEY + ", COGS, GrossMargin, MarginPct, RevenuePerUnit, PctDailyTarget, TierMultiplier,"
    " ReturnMultiplier, BaseCommission, FinalCommission"
)


def staging(spark: SparkSession, d: str) -> DataFrame:
    return sales.stage_valid(model.sales_transactions(spark, d))


def returned(spark: SparkSession, d: str) -> DataFrame:
    return sales.split_returns(model.sales_transactions(spark, d))[1]


DIMENSIONS = {
    "customers": model.customers,
    "products": model.products,
    "reps": model.sales_reps,
    "targets": model.regional_targets,
}


def valid(spark: SparkSession, d: str) -> DataFrame:
    return sales.valid_transactions(model.sales_lines(spark, d))


def staged(lines: DataFrame) -> DataFrame:
    """The id and formulas of staging for ``valid`` lines, with what joins have added."""
    return sales.staged(model.with_transaction_id(lines))


def star(spark: SparkSession, d: str) -> DataFrame:
    dims = {name: load(spark, d) for name, load in DIMENSIONS.items()}
    return sales.enrich_star(valid(spark, d), late=staged, **dims)


def enriched(spark: SparkSession, d: str, *needed: str) -> DataFrame:
    """The enriched transactions, with all dimensions or with the needed ones."""
    dims = {name: DIMENSIONS[name](spark, d) for name in needed or DIMENSIONS}
    return sales.enrich(valid(spark, d), rules=RULES, late=staged, **dims)


# Sales reps up to this number are sent to every executor, some 50 MB.
FEW_REPS = 500_000


def enriched_whole(spark: SparkSession, d: str) -> DataFrame:
    """The enriched transactions with all columns, so that what is shuffled stays narrow."""
    return enriched_parts(spark, d)[0]


def enriched_parts(spark: SparkSession, d: str, parts: int = 1, by_product: bool = False) -> list[DataFrame]:
    """The enriched transactions with all columns, each order in one of several parts; every part reads all files.

    The products join the lines and the customers the orders before these meet; their texts pass as a number where few
    are different. The reps are broadcast after that; where they are too many, they join the lines first of all.
    With ``by_product`` the products join last: more is shuffled, but beyond broadcast size the rows of a product come
    together, which makes a stored copy smaller and its aggregates by product small before they are shuffled.
    """
    dims = {name: load(spark, d) for name, load in DIMENSIONS.items()}
    first, spelt = {}, []
    for name, key in (("customers", "CustomerID"),) if by_product else (("products", "ProductID"), ("customers", "CustomerID")):
        first[key], back = joins.coded(dims[name], [key])
        spelt.append(back)
    reps = joins.measured(dims["reps"], FEW_REPS)
    if reps is dims["reps"]:
        first = {"SalesRepID": reps, **first}
    facts = sales.valid_transactions(model.sales_lines(spark, d, first))
    # The condition holds for lines and orders alike, so the optimizer applies it to both before they are shuffled.
    part = F.pmod(F.xxhash64("OrderID"), F.lit(parts))
    found = [facts.filter(part == k) for k in range(parts)] if parts > 1 else [facts]
    dims["reps"] = reps
    return [
        sales.enrich(one, rules=RULES, late=lambda df: staged(reduce(lambda df, back: back(df), spelt, df)), joined=tuple(first), **dims)
        for one in found
    ]


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Staged transactions with the formulas that need no dimension."""
    return sales.line_features(staging(spark, d), RULES)


def kpi(spark: SparkSession, d: str) -> DataFrame:
    return sales.customer_kpi(enriched(spark, d, "customers", "products", "reps"), RULES)


def performance(spark: SparkSession, d: str) -> DataFrame:
    return sales.product_performance(enriched(spark, d, "products"))


def reps(spark: SparkSession, d: str, by_region: bool = False) -> DataFrame:
    needed = ("customers", "products", "reps") if by_region else ("products", "reps")
    return sales.rep_commission(enriched(spark, d, *needed), by_region, RULES)


def dashboard(spark: SparkSession, d: str) -> DataFrame:
    return sales.regional_dashboard(enriched(spark, d), rules=RULES)


# --- staging and splits ----------------------------------------------------------------------

RETURNED_SQL = sql(TX, """SELECT * FROM tx WHERE "ReturnFlag" = 'Y'""", d="UnitPrice, Discount", i="Quantity")

query("staging_valid_transactions", sql(STAGING, "SELECT * FROM staging", d=MONEY_IN, i="Year, Quantity"))(staging)
query("staging_returned_orders", RETURNED_SQL)(returned)


# The split with unknown flags: one product in seven has none, and those rows are no valid sales.
FLAGS = f"""{TX}, flags AS (SELECT * REPLACE (CASE WHEN "ProductID" % 7 > 0 THEN "ReturnFlag" END AS "ReturnFlag") FROM tx)"""


def _split(spark, d):
    tx = model.sales_transactions(spark, d)
    return sales.split_returns(tx.withColumn("ReturnFlag", F.when(F.col("ProductID") % 7 > 0, F.col("ReturnFlag"))))


query("split_valid", sql(FLAGS, """SELECT * FROM flags WHERE "ReturnFlag" = 'N'""", d="UnitPrice, Discount", i="Quantity"))(
    lambda spark, d: _split(spark, d)[0]
)
query(
    "split_returned",
    sql(FLAGS, """SELECT * FROM flags WHERE "ReturnFlag" IS DISTINCT FROM 'N'""", d="UnitPrice, Discount", i="Quantity"),
)(lambda spark, d: _split(spark, d)[1])


@query("returned_orders_flagged", RETURNED_SQL)
def returned_orders_flagged(spark, d):
    """The returned orders promoted unchanged to the report layer: stored there and read again."""
    path = fresh_path(spark, "returned-orders")
    write_output(returned(spark, d), path, "parquet")
    return spark.read.parquet(path)


# --- formula blocks --------------------------------------------------------------------------

@query(
    "date_features",
    sql(STAGING, 'SELECT "TransactionID", "TransactionDate", "Quarter", "Year", "Month" FROM staging', i="Year"),
)
def date_features(spark, d):
    return staging(spark, d).select("TransactionID", "TransactionDate", "Quarter", "Year", "Month")


@query(
    "revenue_features",
    sql(
        f"{TX}, {FEATURES}",
        'SELECT "TransactionID", "GrossRevenue", "NetRevenue", "DiscountAmount" FROM features',
        d="GrossRevenue, NetRevenue, DiscountAmount",
    ),
)
def revenue_features(spark, d):
    df = sales.revenue_features(model.sales_transactions(spark, d))
    return df.select("TransactionID", "GrossRevenue", "NetRevenue", "DiscountAmount")


def _picked(name: str, cols: str, *needed: str, d: str = "", i: str = "") -> None:
    """Register some columns of the enriched table, joined to the dimensions they need."""
    names = [c.strip() for c in cols.split(",")]
    quoted = ", ".join(f'"{c}"' for c in names)
    text = sql(ENRICHED, f'SELECT "TransactionID", {quoted} FROM enriched', d=d, i=i)

    def run(spark, sf_dir):
        df = enriched(spark, sf_dir, *needed) if needed else lines(spark, sf_dir)
        return df.select("TransactionID", *names)

    query(name, text)(run)


_picked("margin_features", "COGS, GrossMargin, MarginPct", "products", d="COGS, GrossMargin, MarginPct")
_picked("deal_tier", "NetRevenue, DealTier", d="NetRevenue")
_picked("payment_risk", "PaymentMethod, PaymentRisk")
_picked(
    "target_features",
    "RevenuePerUnit, PctDailyTarget",
    "customers",
    "targets",
    d="RevenuePerUnit, PctDailyTarget",
)
_picked("account_age", "AccountOpenDate, AccountAgeDays", "customers", i="AccountAgeDays")
_picked(
    "commission",
    "TierMultiplier, ReturnMultiplier, BaseCommission, FinalCommission, CommissionBand",
    "reps",
    d="TierMultiplier, ReturnMultiplier, BaseCommission, FinalCommission",
)


@query(
    "discount_tier",
    sql(
        TX,
        'SELECT "TransactionID", "Discount", '
        + bands('"Discount"', ((0.07, "Heavy Discount"), (0.03, "Standard Discount")), "No Discount")
        + ' AS "DiscountTier" FROM tx',
        d="Discount",
    ),
)
def discount_tier(spark, d):
    tx = model.sales_transactions(spark, d)
    edges = [("0.07", "Heavy Discount"), ("0.03", "Standard Discount")]
    edges = [(F.lit(edge).cast("decimal(4,2)"), label) for edge, label in edges]
    return tx.select("TransactionID", "Discount", fx.band("Discount", edges, "No Discount").alias("DiscountTier"))


@query(
    "account_tier",
    sql(
        CUSTOMERS,
        'SELECT "CustomerID", "CreditLimit", '
        + bands('"CreditLimit"', ((80000, "Strategic"), (30000, "Major"), (12000, "Standard")), "Starter")
        + ' AS "AccountTier" FROM customers',
        d="CreditLimit",
    ),
)
def account_tier(spark, d):
    tier = fx.band("CreditLimit", RULES.account_tiers, RULES.account_tier_default).alias("AccountTier")
    return model.customers(spark, d).select("CustomerID", "CreditLimit", tier)


@query(
    "commission_with_returns",
    sql(
        f"""{TX}, {FEATURES}, rated AS (
  SELECT "TransactionID", "ReturnFlag", {money('"NetRevenue" * 0.08')} AS base,
    CASE WHEN "NetRevenue" >= 60000 THEN 1.50 WHEN "NetRevenue" >= 30000 THEN 1.25
         WHEN "NetRevenue" >= 10000 THEN 1.00 ELSE 0.75 END::DECIMAL(4,2) AS tier,
    CASE WHEN "ReturnFlag" = 'Y' THEN 0.5 ELSE 1 END::DECIMAL(4,2) AS kept FROM features)""",
        f"""SELECT "TransactionID", "ReturnFlag", kept AS "ReturnMultiplier",
  {money("base * tier * kept")} AS "FinalCommission" FROM rated""",
        d="ReturnMultiplier, FinalCommission",
    ),
)
def commission_with_returns(spark, d):
    """Claw-back on returned lines, at a flat rate over all transactions."""
    df = sales.revenue_features(model.sales_transactions(spark, d))
    df = df.withColumn("DealTier", fx.band("NetRevenue", RULES.deal_tiers, RULES.deal_tier_default))
    df = df.withColumn("CommissionRate", F.lit("0.08").cast("decimal(6,4)"))
    df = sales.commission(df, RULES, return_flag="ReturnFlag")
    return df.select("TransactionID", "ReturnFlag", "ReturnMultiplier", "FinalCommission")


# --- enrichment ------------------------------------------------------------------------------

query("star_enriched", sql(STAR, "SELECT * FROM star", d=STAR_MONEY, i=STAR_INTS))(star)
query(
    "enriched_transactions",
    sql(ENRICHED, "SELECT * FROM enriched", d=FULL_MONEY, i=STAR_INTS + ", AccountAgeDays"),
)(enriched_whole)


@query(
    "join_targets_composite",
    sql(
        f"{STAGING}, {CUSTOMERS}, {TARGETS}",
        """SELECT "TransactionID", c."Region", s."Year", s."Quarter", "RevenueTarget", "UnitTarget"
FROM staging s JOIN customers c ON s."CustomerID" = c."CustomerID"
LEFT JOIN targets t ON c."Region" = t."Region" AND s."Year" = t."Year" AND s."Quarter" = t."Quarter" """,
        i="Year, RevenueTarget, UnitTarget",
    ),
)
def join_targets_composite(spark, d):
    fact = staging(spark, d).select("TransactionID", "CustomerID", "Year", "Quarter")
    fact = joins.join_dfs(fact, model.customers(spark, d).select("CustomerID", "Region"), "CustomerID")
    keys = ["Region", "Year", "Quarter"]
    out = joins.join_dim(fact, model.regional_targets(spark, d), keys, [*keys, "RevenueTarget", "UnitTarget"])
    return out.drop("CustomerID")


# --- the four reports ------------------------------------------------------------------------

KPI_MONEY = (
    "TotalRevenue, TotalGross, TotalMargin, TotalCOGS, MaxOrderValue, TotalCommission, AvgOrderValue, MarginPct"
)
REP_MONEY = (
    "CommissionRate, TotalRevenue, TotalMargin, TotalCommission, LargestDeal, QuotaAttainmentPct, AvgDealSize"
)
REP_INTS = "YTDQuota, TotalUnitsSold"
DASH_MONEY = (
    "ActualRevenue, ActualMargin, TotalCommission, AvgTransactionValue, RevenueAttainmentPct, RevenueGap, MarginPct"
)
PROD_MONEY = "MSRP, CostPrice, TotalRevenue, TotalMargin, TotalDiscount, AvgSalePrice"

query("customer_kpi_report", sql(KPI, "SELECT * FROM kpi", d=KPI_MONEY, i="TotalUnits"))(kpi)
query(
    "product_performance",
    sql(PERFORMANCE, "SELECT * FROM performance", d=PROD_MONEY, i="WarrantyMonths, TotalUnitsSold"),
)(performance)
query("rep_commission_report", sql(rep_report(True), "SELECT * FROM rep_report", d=REP_MONEY, i=REP_INTS))(
    lambda spark, d: reps(spark, d, by_region=True)
)
query("rep_commission_total", sql(rep_report(False), "SELECT * FROM rep_report", d=REP_MONEY, i=REP_INTS))(reps)
query(
    "regional_dashboard",
    sql(DASHBOARD, "SELECT * FROM dashboard", d=DASH_MONEY, i="Year, RevenueTarget, UnitTarget, ActualUnits"),
)(dashboard)


@query(
    "rep_most_common_tier",
    sql(rep_report(False), 'SELECT "SalesRepID", "DealTier" AS "MostCommonTier" FROM tier_mode'),
)
def rep_most_common_tier(spark, d):
    return aggs.mode_by(lines(spark, d), "SalesRepID", "DealTier", "MostCommonTier")
