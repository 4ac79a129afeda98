"""Ranked lists and distributions over the staged, enriched and report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions import formulas as fx
from tallyloom.session import shuffles_removed


def distribution(
    df: DataFrame, keys: str | Sequence[str], totals: dict[str, str], count: str = "Transactions", means: dict | None = None
) -> DataFrame:
    """Rows, sums and means per key: ``totals`` and ``means`` map output to column."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    means = means or {}
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count),
        *[F.sum(c).alias(name) for name, c in totals.items()],
        *[F.sum(c).alias(f"__{name}") for name, c in means.items()],
    )
    averages = {name: fx.mean(f"__{name}", count) for name in means}
    return out.withColumns(averages).drop(*[f"__{name}" for name in means])


def transaction_overview(staging: DataFrame) -> DataFrame:
    return staging.agg(
        F.count(F.lit(1)).alias("TotalRows"),
        F.min("TransactionDate").alias("EarliestDate"),
        F.max("TransactionDate").alias("LatestDate"),
        F.count_distinct("CustomerID").alias("UniqueCustomers"),
        F.count_distinct("ProductID").alias("UniqueProducts"),
        F.count_distinct("SalesRepID").alias("UniqueReps"),
    )


def by_quarter(staging: DataFrame) -> DataFrame:
    out = distribution(
        staging, "Quarter", {"TotalNetRevenue": "NetRevenue"}, means={"AvgNetRevenue": "NetRevenue"}
    )
    return out.orderBy("Quarter")


def by_payment(staging: DataFrame) -> DataFrame:
    out = distribution(staging, "PaymentMethod", {"TotalRevenue": "NetRevenue"}, count="Count")
    return out.orderBy(F.desc("TotalRevenue"), "PaymentMethod")


def returned_value(returned: DataFrame, net: bool = False) -> DataFrame:
    """Returned orders and the gross (and net) value they put at risk."""
    gross = F.col("Quantity") * F.col("UnitPrice")
    measures = [F.count(F.lit(1)).alias("ReturnedOrders"), fx.money(F.sum(gross)).alias("GrossValueAtRisk")]
    if net:
        measures.append(fx.money(F.sum(gross * (F.lit(1) - F.col("Discount")))).alias("NetValueAtRisk"))
    return returned.agg(*measures)


def by_deal_tier(enriched: DataFrame) -> DataFrame:
    out = distribution(
        enriched,
        "DealTier",
        {"TotalRevenue": "NetRevenue", "TotalCommission": "FinalCommission"},
        means={"AvgRevenue": "NetRevenue"},
    )
    return out.orderBy(F.desc("TotalRevenue"), "DealTier")


def by_commission_band(enriched: DataFrame) -> DataFrame:
    out = enriched.groupBy("CommissionBand").agg(
        F.count(F.lit(1)).alias("Transactions"),
        F.sum("FinalCommission").alias("TotalCommission"),
        F.min("FinalCommission").alias("MinCommission"),
        F.max("FinalCommission").alias("MaxCommission"),
    )
    out = out.withColumn("AvgCommission", fx.mean("TotalCommission", "Transactions"))
    return out.orderBy(F.desc("TotalCommission"), "CommissionBand")


def by_discount_tier(enriched: DataFrame) -> DataFrame:
    out = enriched.groupBy("DiscountTier").agg(
        F.count(F.lit(1)).alias("Transactions"),
        F.sum("DiscountAmount").alias("TotalDiscountGiven"),
        F.sum("DiscountRate").alias("__rate"),
    )
    out = out.withColumn("AvgDiscountPct", fx.percent("__rate", "Transactions")).drop("__rate")
    return out.orderBy(F.desc("TotalDiscountGiven"), "DiscountTier")


def by_payment_risk(enriched: DataFrame) -> DataFrame:
    out = distribution(enriched, ["PaymentRisk", "PaymentMethod"], {"TotalRevenue": "NetRevenue"})
    return out.orderBy("PaymentRisk", "PaymentMethod")


def monthly_revenue_trend(enriched: DataFrame) -> DataFrame:
    """Months in calendar order; the first date of a month carries that order."""
    out = enriched.groupBy("Year", "Month", "Quarter").agg(
        F.count(F.lit(1)).alias("Transactions"),
        F.sum("NetRevenue").alias("TotalRevenue"),
        F.sum("GrossMargin").alias("TotalMargin"),
        F.sum("FinalCommission").alias("TotalCommission"),
        F.min("TransactionDate").alias("FirstDate"),
    )
    return out.orderBy("Year", "FirstDate")


def ranked(df: DataFrame, by: str, tie: str, cols: Sequence[str], top: int | None = None) -> DataFrame:
    """Columns of a report from the highest value down; ``top`` keeps the first rows only."""
    out = df.orderBy(F.desc(by), tie)
    return (out.limit(top) if top else out).select(*cols)


def by_value_band(kpi: DataFrame) -> DataFrame:
    out = distribution(
        kpi,
        "CustomerValueBand",
        {"TotalRevenue": "TotalRevenue", "TotalOrders": "TotalOrders"},
        count="Customers",
        means={"AvgRevenue": "TotalRevenue"},
    )
    return out.orderBy(F.desc("TotalRevenue"), "CustomerValueBand")


def by_segment(kpi: DataFrame) -> DataFrame:
    out = kpi.groupBy("Segment").agg(
        F.count(F.lit(1)).alias("Customers"),
        F.sum("TotalRevenue").alias("TotalRevenue"),
        F.sum("MarginPct").alias("__margin"),
        F.sum("AvgOrderValue").alias("__value"),
    )
    out = out.withColumns(
        {"AvgMarginPct": fx.ratio("__margin", "Customers", 1), "AvgOrderValue": fx.mean("__value", "Customers")}
    )
    return out.drop("__margin", "__value").orderBy(F.desc("TotalRevenue"), "Segment")


def by_category(products: DataFrame) -> DataFrame:
    out = distribution(
        products,
        "Category",
        {"TotalUnitsSold": "TotalUnitsSold", "TotalRevenue": "TotalRevenue", "TotalMargin": "TotalMargin"},
        count="Products",
        means={"AvgSalePrice": "AvgSalePrice"},
    )
    return out.orderBy(F.desc("TotalRevenue"), "Category")


def by_performance_band(reps: DataFrame) -> DataFrame:
    out = reps.groupBy("PerformanceBand").agg(
        F.count(F.lit(1)).alias("Reps"),
        F.sum("TotalRevenue").alias("TotalRevenue"),
        F.sum("QuotaAttainmentPct").alias("__pct"),
        F.sum("TotalCommission").alias("TotalCommission"),
    )
    out = out.withColumn("AvgQuotaAttainmentPct", fx.ratio("__pct", "Reps", 1)).drop("__pct")
    return out.orderBy(F.desc("AvgQuotaAttainmentPct"), "PerformanceBand")


def rep_quota_gap(reps: DataFrame) -> DataFrame:
    gap = fx.money(F.col("YTDQuota") - F.col("TotalRevenue")).alias("RevenueGap")
    out = reps.select(
        "SalesRepID", "RepName", "YTDQuota", "TotalRevenue", gap, "QuotaAttainmentPct", "PerformanceBand"
    )
    return out.orderBy(F.desc("QuotaAttainmentPct"), "SalesRepID")


def regional_totals(dashboard: DataFrame) -> DataFrame:
    """Target, actual, gap and attainment per region over the periods on the dashboard."""
    out = dashboard.groupBy("Region").agg(
        F.sum("RevenueTarget").alias("Target"), F.sum("ActualRevenue").alias("Actual")
    )
    out = out.withColumns(
        {"Gap": fx.money(F.col("Actual") - F.col("Target")), "AttainmentPct": fx.percent("Actual", "Target")}
    )
    return out.orderBy(F.desc("Actual"), "Region")


def by_target_status(dashboard: DataFrame) -> DataFrame:
    out = distribution(dashboard, "TargetStatus", {"TotalRevenue": "ActualRevenue"}, count="RegionQuarters")
    return out.orderBy("TargetStatus")


def kpi_snapshot(enriched: DataFrame) -> DataFrame:
    out = enriched.agg(
        F.count(F.lit(1)).alias("TotalTransactions"),
        F.sum("GrossRevenue").alias("TotalGrossRevenue"),
        F.sum("NetRevenue").alias("TotalNetRevenue"),
        F.sum("DiscountAmount").alias("TotalDiscountGiven"),
        F.sum("COGS").alias("TotalCOGS"),
        F.sum("GrossMargin").alias("TotalGrossMargin"),
        F.sum("FinalCommission").alias("TotalCommissionPaid"),
        F.sum("MarginPct").alias("__margin"),
        F.count_distinct("CustomerID").alias("UniqueCustomers"),
        F.count_distinct("ProductID").alias("UniqueProducts"),
        F.count_distinct("SalesRepID").alias("UniqueReps"),
    )
    return out.withColumns(
        {
            "AvgMarginPct": fx.ratio("__margin", "TotalTransactions", 1),
            "AvgTransactionValue": fx.mean("TotalNetRevenue", "TotalTransactions"),
        }
    ).drop("__margin")


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table, counted one after the other, so that the disk holds the shuffles of one count at a time."""
    spark = next(iter(tables.values())).sparkSession
    with shuffles_removed(spark):
        sizes = [(name, df.agg(F.count(F.lit(1))).collect()[0][0], len(df.columns)) for name, df in tables.items()]
    return spark.createDataFrame(sizes, "TableName string not null, RowCount bigint not null, ColumnCount int not null")
