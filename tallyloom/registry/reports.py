"""Report queries over the staged, enriched and report tables."""

from __future__ import annotations

from tallyloom.operators import quality
from tallyloom.operators.sinks import run_reports
from tallyloom.plans import reports, sales
from tallyloom.registry import query
from tallyloom.registry.sales import RULES, dashboard, enriched, enriched_parts, kpi, lines, performance, reps, returned, staging
from tallyloom.registry.sql import (
    CUSTOMERS, DASHBOARD, ENRICHED, KPI, PERFORMANCE, STAGING, TX, money, pct, ratio, rep_report, sql,
)
from tallyloom.session import input_bytes
from tallyloom.sources import model

# The shared copy is stored in one part more for every PART_BYTES of input, up to SHARED_PARTS: each reads the input.
PART_BYTES = 128 * 2**20
SHARED_PARTS = 4


@query(
    "transaction_overview",
    sql(
        STAGING,
        """SELECT count(*) AS "TotalRows", min("TransactionDate") AS "EarliestDate", max("TransactionDate") AS "LatestDate",
  count(DISTINCT "CustomerID") AS "UniqueCustomers", count(DISTINCT "ProductID") AS "UniqueProducts",
  count(DISTINCT "SalesRepID") AS "UniqueReps" FROM staging""",
    ),
)
def transaction_overview(spark, d):
    return reports.transaction_overview(staging(spark, d))


@query(
    "report_by_quarter",
    sql(
        STAGING,
        f"""SELECT "Quarter", count(*) AS "Transactions", sum("NetRevenue") AS "TotalNetRevenue",
  {ratio('sum("NetRevenue")', "count(*)", 2)} AS "AvgNetRevenue" FROM staging GROUP BY 1""",
        d="TotalNetRevenue, AvgNetRevenue",
    ),
)
def report_by_quarter(spark, d):
    return reports.by_quarter(staging(spark, d))


@query(
    "report_by_payment",
    sql(
        STAGING,
        """SELECT "PaymentMethod", count(*) AS "Count", sum("NetRevenue") AS "TotalRevenue" FROM staging GROUP BY 1""",
        d="TotalRevenue",
    ),
)
def report_by_payment(spark, d):
    return reports.by_payment(staging(spark, d))


@query(
    "returned_summary",
    sql(
        TX,
        """SELECT count(*) AS "ReturnedOrders", sum("Quantity" * "UnitPrice") AS "GrossValueAtRisk"
FROM tx WHERE "ReturnFlag" = 'Y'""",
        d="GrossValueAtRisk",
    ),
)
def returned_summary(spark, d):
    return reports.returned_value(returned(spark, d))


@query(
    "returned_impact",
    sql(
        TX,
        f"""SELECT count(*) AS "ReturnedOrders", sum("Quantity" * "UnitPrice") AS "GrossValueAtRisk",
  {money('sum("Quantity" * "UnitPrice" * (1 - "Discount"))')} AS "NetValueAtRisk" FROM tx WHERE "ReturnFlag" = 'Y'""",
        d="GrossValueAtRisk, NetValueAtRisk",
    ),
)
def returned_impact(spark, d):
    return reports.returned_value(returned(spark, d), net=True)


@query(
    "report_deal_tier",
    sql(
        ENRICHED,
        f"""SELECT "DealTier", count(*) AS "Transactions", sum("NetRevenue") AS "TotalRevenue",
  {ratio('sum("NetRevenue")', "count(*)", 2)} AS "AvgRevenue", sum("FinalCommission") AS "TotalCommission"
FROM enriched GROUP BY 1""",
        d="TotalRevenue, AvgRevenue, TotalCommission",
    ),
)
def report_deal_tier(spark, d):
    return reports.by_deal_tier(enriched(spark, d, "reps"))


@query(
    "report_commission_band",
    sql(
        ENRICHED,
        f"""SELECT "CommissionBand", count(*) AS "Transactions", sum("FinalCommission") AS "TotalCommission",
  {ratio('sum("FinalCommission")', "count(*)", 2)} AS "AvgCommission", min("FinalCommission") AS "MinCommission",
  max("FinalCommission") AS "MaxCommission" FROM enriched GROUP BY 1""",
        d="TotalCommission, AvgCommission, MinCommission, MaxCommission",
    ),
)
def report_commission_band(spark, d):
    return reports.by_commission_band(enriched(spark, d, "reps"))


@query(
    "report_discount_tier",
    sql(
        ENRICHED,
        f"""SELECT "DiscountTier", count(*) AS "Transactions", sum("DiscountAmount") AS "TotalDiscountGiven",
  {pct('sum("DiscountRate")', "count(*)")} AS "AvgDiscountPct" FROM enriched GROUP BY 1""",
        d="TotalDiscountGiven, AvgDiscountPct",
    ),
)
def report_discount_tier(spark, d):
    return reports.by_discount_tier(lines(spark, d))


@query(
    "report_payment_risk",
    sql(
        ENRICHED,
        """SELECT "PaymentRisk", "PaymentMethod", count(*) AS "Transactions", sum("NetRevenue") AS "TotalRevenue"
FROM enriched GROUP BY 1, 2""",
        d="TotalRevenue",
    ),
)
def report_payment_risk(spark, d):
    return reports.by_payment_risk(lines(spark, d))


@query(
    "monthly_revenue_trend",
    sql(
        ENRICHED,
        """SELECT "Year", "Month", "Quarter", count(*) AS "Transactions", sum("NetRevenue") AS "TotalRevenue",
  sum("GrossMargin") AS "TotalMargin", sum("FinalCommission") AS "TotalCommission", min("TransactionDate") AS "FirstDate"
FROM enriched GROUP BY 1, 2, 3""",
        d="TotalRevenue, TotalMargin, TotalCommission",
        i="Year",
    ),
)
def monthly_revenue_trend(spark, d):
    return reports.monthly_revenue_trend(enriched(spark, d, "products", "reps"))


# --- customers -------------------------------------------------------------------------------

RANKED = [
    "CustomerID", "CustomerName", "Segment", "Region", "AccountTier", "TotalOrders", "TotalRevenue", "TotalMargin",
    "MarginPct", "AvgOrderValue", "TotalCommission", "CustomerValueBand",
]
TOP = ["CustomerID", "CustomerName", "Region", "Segment", "TotalRevenue", "TotalOrders", "CustomerValueBand"]


def _list(cols):
    return ", ".join(f'"{c}"' for c in cols)


@query(
    "customers_ranked",
    sql(KPI, f"SELECT {_list(RANKED)} FROM kpi", d="TotalRevenue, TotalMargin, MarginPct, AvgOrderValue, TotalCommission"),
)
def customers_ranked(spark, d):
    return reports.ranked(kpi(spark, d), "TotalRevenue", "CustomerID", RANKED)


@query(
    "top5_customers",
    sql(KPI, f'SELECT {_list(TOP)} FROM kpi ORDER BY "TotalRevenue" DESC, "CustomerID" LIMIT 5', d="TotalRevenue"),
)
def top5_customers(spark, d):
    return reports.ranked(kpi(spark, d), "TotalRevenue", "CustomerID", TOP, 5)


@query(
    "report_value_band",
    sql(
        KPI,
        f"""SELECT "CustomerValueBand", count(*) AS "Customers", sum("TotalRevenue") AS "TotalRevenue",
  {ratio('sum("TotalRevenue")', "count(*)", 2)} AS "AvgRevenue", sum("TotalOrders") AS "TotalOrders"
FROM kpi GROUP BY 1""",
        d="TotalRevenue, AvgRevenue",
        i="TotalOrders",
    ),
)
def report_value_band(spark, d):
    return reports.by_value_band(kpi(spark, d))


@query(
    "report_segment",
    sql(
        KPI,
        f"""SELECT "Segment", count(*) AS "Customers", sum("TotalRevenue") AS "TotalRevenue",
  {ratio('sum("MarginPct")', "count(*)", 1)} AS "AvgMarginPct",
  {ratio('sum("AvgOrderValue")', "count(*)", 2)} AS "AvgOrderValue" FROM kpi GROUP BY 1""",
        d="TotalRevenue, AvgMarginPct, AvgOrderValue",
    ),
)
def report_segment(spark, d):
    return reports.by_segment(kpi(spark, d))


# --- products --------------------------------------------------------------------------------

PRODUCT_LIST = [
    "ProductID", "ProductName", "Category", "SubCategory", "TotalOrders", "TotalUnitsSold", "TotalRevenue",
    "TotalMargin", "AvgSalePrice", "UniqueCustomers",
]


@query(
    "products_ranked",
    sql(
        PERFORMANCE,
        f"SELECT {_list(PRODUCT_LIST)} FROM performance",
        d="TotalRevenue, TotalMargin, AvgSalePrice",
        i="TotalUnitsSold",
    ),
)
def products_ranked(spark, d):
    return reports.ranked(performance(spark, d), "TotalRevenue", "ProductID", PRODUCT_LIST)


@query(
    "report_category",
    sql(
        PERFORMANCE,
        f"""SELECT "Category", count(*) AS "Products", sum("TotalUnitsSold") AS "TotalUnitsSold",
  sum("TotalRevenue") AS "TotalRevenue", sum("TotalMargin") AS "TotalMargin",
  {ratio('sum("AvgSalePrice")', "count(*)", 2)} AS "AvgSalePrice" FROM performance GROUP BY 1""",
        d="TotalRevenue, TotalMargin, AvgSalePrice",
        i="TotalUnitsSold",
    ),
)
def report_category(spark, d):
    return reports.by_category(performance(spark, d))


def _top3(name: str, measure: str) -> None:
    cols = ["ProductID", "ProductName", "Category", measure, "TotalRevenue"]
    text = sql(
        PERFORMANCE,
        f'SELECT {_list(cols)} FROM performance ORDER BY "{measure}" DESC, "ProductID" LIMIT 3',
        d="TotalRevenue",
        i=measure,
    )
    query(name, text)(lambda spark, d: reports.ranked(performance(spark, d), measure, "ProductID", cols, 3))


_top3("top3_products_units", "TotalUnitsSold")
_top3("top3_products_customers", "UniqueCustomers")

# --- reps and regions ------------------------------------------------------------------------

REP_LIST = [
    "SalesRepID", "RepName", "Territory", "CommissionRate", "TotalDeals", "TotalRevenue", "TotalCommission",
    "UniqueAccounts", "LargestDeal", "AvgDealSize", "QuotaAttainmentPct", "PerformanceBand",
]


@query(
    "reps_ranked",
    sql(
        rep_report(False),
        f"SELECT {_list(REP_LIST)} FROM rep_report",
        d="CommissionRate, TotalRevenue, TotalCommission, LargestDeal, AvgDealSize, QuotaAttainmentPct",
    ),
)
def reps_ranked(spark, d):
    return reports.ranked(reps(spark, d), "TotalCommission", "SalesRepID", REP_LIST)


@query(
    "report_performance_band",
    sql(
        rep_report(False),
        f"""SELECT "PerformanceBand", count(*) AS "Reps", sum("TotalRevenue") AS "TotalRevenue",
  {ratio('sum("QuotaAttainmentPct")', "count(*)", 1)} AS "AvgQuotaAttainmentPct",
  sum("TotalCommission") AS "TotalCommission" FROM rep_report GROUP BY 1""",
        d="TotalRevenue, AvgQuotaAttainmentPct, TotalCommission",
    ),
)
def report_performance_band(spark, d):
    return reports.by_performance_band(reps(spark, d))


@query(
    "rep_quota_gap",
    sql(
        rep_report(False),
        """SELECT "SalesRepID", "RepName", "YTDQuota", "TotalRevenue", "YTDQuota" - "TotalRevenue" AS "RevenueGap",
  "QuotaAttainmentPct", "PerformanceBand" FROM rep_report""",
        d="TotalRevenue, RevenueGap, QuotaAttainmentPct",
        i="YTDQuota",
    ),
)
def rep_quota_gap(spark, d):
    return reports.rep_quota_gap(reps(spark, d))


@query(
    "regional_totals",
    sql(
        DASHBOARD,
        f"""SELECT "Region", sum("RevenueTarget") AS "Target", sum("ActualRevenue") AS "Actual",
  sum("ActualRevenue") - sum("RevenueTarget") AS "Gap",
  {pct('sum("ActualRevenue")', 'sum("RevenueTarget")')} AS "AttainmentPct" FROM dashboard GROUP BY 1""",
        d="Actual, Gap, AttainmentPct",
        i="Target",
    ),
)
def regional_totals(spark, d):
    return reports.regional_totals(dashboard(spark, d))


@query(
    "report_target_status",
    sql(
        DASHBOARD,
        """SELECT "TargetStatus", count(*) AS "RegionQuarters", sum("ActualRevenue") AS "TotalRevenue"
FROM dashboard GROUP BY 1""",
        d="TotalRevenue",
    ),
)
def report_target_status(spark, d):
    return reports.by_target_status(dashboard(spark, d))


@query(
    "kpi_snapshot",
    sql(
        ENRICHED,
        f"""SELECT count(*) AS "TotalTransactions", sum("GrossRevenue") AS "TotalGrossRevenue",
  sum("NetRevenue") AS "TotalNetRevenue", sum("DiscountAmount") AS "TotalDiscountGiven", sum("COGS") AS "TotalCOGS",
  sum("GrossMargin") AS "TotalGrossMargin", sum("FinalCommission") AS "TotalCommissionPaid",
  {ratio('sum("MarginPct")', "count(*)", 1)} AS "AvgMarginPct",
  {ratio('sum("NetRevenue")', "count(*)", 2)} AS "AvgTransactionValue",
  count(DISTINCT "CustomerID") AS "UniqueCustomers", count(DISTINCT "ProductID") AS "UniqueProducts",
  count(DISTINCT "SalesRepID") AS "UniqueReps" FROM enriched""",
        d="TotalGrossRevenue, TotalNetRevenue, TotalDiscountGiven, TotalCOGS, TotalGrossMargin, TotalCommissionPaid, "
        "AvgMarginPct, AvgTransactionValue",
    ),
)
def kpi_snapshot(spark, d):
    return reports.kpi_snapshot(enriched(spark, d, "products", "reps"))


@query(
    "table_sizes",
    sql(
        rep_report(True),
        """SELECT 'staging_valid_transactions' AS "TableName", count(*) AS "RowCount", 16 AS "ColumnCount" FROM staging
UNION ALL SELECT 'staging_returned_orders', count(*), 11 FROM tx WHERE "ReturnFlag" = 'Y'
UNION ALL SELECT 'enriched_transactions', count(*), 54 FROM enriched
UNION ALL SELECT 'customer_kpi_report', count(DISTINCT "CustomerID"), 18 FROM enriched
UNION ALL SELECT 'product_performance', count(DISTINCT "ProductID"), 15 FROM enriched
UNION ALL SELECT 'rep_commission_report', count(*), 17 FROM rep_report
UNION ALL SELECT 'regional_dashboard', count(DISTINCT ("Region", "Year", "Quarter")), 16 FROM enriched""",
        i="ColumnCount",
    ),
)
def table_sizes(spark, d):
    """Rows and columns of all tables; the reports share one stored copy of the enriched table."""
    parts = min(SHARED_PARTS, 1 + input_bytes(spark, d) // PART_BYTES)
    derived = run_reports(
        enriched_parts(spark, d, parts, by_product=True),
        {
            "enriched_transactions": lambda df: df,
            "customer_kpi_report": lambda df: sales.customer_kpi(df, RULES),
            "product_performance": sales.product_performance,
            "rep_commission_report": lambda df: sales.rep_commission(df, True, RULES),
            "regional_dashboard": lambda df: sales.regional_dashboard(df, rules=RULES),
        },
    )
    staged = {"staging_valid_transactions": staging(spark, d), "staging_returned_orders": returned(spark, d)}
    return reports.table_sizes({**staged, **derived})


@query(
    "profile_table",
    sql(
        CUSTOMERS,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "ColumnName", '{t}' AS "DataType", count(*) AS "RowCount",
  count(*) - count("{c}") AS "NullCount", min("{c}")::VARCHAR AS "MinValue", max("{c}")::VARCHAR AS "MaxValue" FROM customers"""
            for c, t in (
                ("CustomerID", "bigint"), ("CustomerName", "string"), ("Region", "string"), ("State", "string"),
                ("CreditLimit", "decimal(18,2)"), ("AccountOpenDate", "date"), ("Segment", "string"), ("Country", "string"),
                ("City", "string"), ("PreferredPayment", "string"),
            )
        ),
    ),
)
def profile_table(spark, d):
    return quality.profile_table(model.customers(spark, d))
