"""Sales-commission pipeline: returns split, staging, star schema, formulas, reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions import formulas as fx
from tallyloom.operators.joins import join_dim
from tallyloom.operators.quality import require_unique
from tallyloom.operators.rows import split_rows

Edges = tuple[tuple[object, str], ...]


@dataclass(frozen=True)
class SalesRules:
    """Band edges and multipliers."""

    # Lower edge and label, from high to low, then the label below all edges.
    deal_tiers: Edges = ((2000, "Platinum"), (800, "Gold"), (300, "Silver"))
    deal_tier_default: str = "Bronze"
    discount_tiers: Edges = ((0.15, "Heavy Discount"), (0.05, "Standard Discount"))
    discount_tier_default: str = "No Discount"
    account_tiers: Edges = ((80000, "Strategic"), (30000, "Major"), (12000, "Standard"))
    account_tier_default: str = "Starter"
    commission_bands: Edges = ((500, "High Commission"), (200, "Mid Commission"))
    commission_band_default: str = "Standard Commission"
    customer_bands: Edges = ((10000, "VIP"), (5000, "High Value"), (2000, "Growth"))
    customer_band_default: str = "Emerging"
    performance_bands: Edges = ((100, "Overachiever"), (80, "On Track"), (60, "At Risk"))
    performance_band_default: str = "Underperforming"
    target_statuses: Edges = ((100, "Target Met"), (80, "Close to Target"))
    target_status_default: str = "Off Track"
    # Commission factors.
    tier_multipliers: tuple[tuple[str, str], ...] = (("Platinum", "1.50"), ("Gold", "1.25"), ("Silver", "1.00"))
    tier_multiplier_default: str = "0.75"
    returned_multiplier: str = "0.5"
    wire_minimum: int = 1000
    target_days: int = 90

    @property
    def tier_labels(self) -> list[str]:
        return [label for _, label in self.deal_tiers] + [self.deal_tier_default]


DEFAULT_RULES = SalesRules()


# --- formula blocks --------------------------------------------------------------------------

def date_features(df: DataFrame, date: str = "TransactionDate") -> DataFrame:
    """Quarter (Q1..Q4), Year, Month name; the date itself may still be ISO text."""
    day = F.to_date(F.col(date))
    return df.withColumns(
        {
            date: day,
            "Quarter": fx.quarter_label(day),
            "Year": F.year(day),
            "Month": fx.month_name(day),
        }
    )


def revenue_features(df: DataFrame) -> DataFrame:
    gross = fx.money(F.col("Quantity") * F.col("UnitPrice").cast(fx.MONEY))
    df = df.withColumn("GrossRevenue", gross)
    discount = F.lit(1) - F.col("Discount").cast("decimal(5,4)")
    df = df.withColumn("NetRevenue", fx.money(F.col("GrossRevenue") * discount))
    return df.withColumn("DiscountAmount", fx.money(F.col("GrossRevenue") - F.col("NetRevenue")))


def margin_features(df: DataFrame) -> DataFrame:
    """COGS, GrossMargin, and MarginPct on the gross (pre-discount) revenue that also guards it."""
    df = df.withColumn("COGS", fx.money(F.col("CostPrice") * F.col("Quantity")))
    df = df.withColumn("GrossMargin", fx.money(F.col("NetRevenue") - F.col("COGS")))
    return df.withColumn("MarginPct", fx.percent(F.col("GrossRevenue") - F.col("COGS"), "GrossRevenue"))


def payment_risk(method: str = "PaymentMethod", amount: str = "NetRevenue", rules: SalesRules = DEFAULT_RULES) -> Column:
    """Small wire transfers fall through to the last label, as in the original rule."""
    safe_wire = (F.col(method) == "Wire Transfer") & (F.col(amount) >= rules.wire_minimum)
    return F.when(safe_wire, "Low Risk").when(F.col(method) == "Credit Card", "Medium Risk").otherwise("PayPal Risk")


def line_features(df: DataFrame, rules: SalesRules = DEFAULT_RULES) -> DataFrame:
    """The formulas that need no dimension."""
    return df.withColumns(
        {
            "DealTier": fx.band("NetRevenue", rules.deal_tiers, rules.deal_tier_default),
            "DiscountTier": fx.band("DiscountRate", _decimal_edges(rules.discount_tiers), rules.discount_tier_default),
            "PaymentRisk": payment_risk(rules=rules),
            "RevenuePerUnit": fx.ratio("NetRevenue", "Quantity", 2),
        }
    )


def account_features(df: DataFrame, rules: SalesRules = DEFAULT_RULES) -> DataFrame:
    opened = F.to_date(F.col("AccountOpenDate"))
    return df.withColumns(
        {
            "AccountTier": fx.band("CreditLimit", rules.account_tiers, rules.account_tier_default),
            "AccountAgeDays": fx.days_between("TransactionDate", opened),
        }
    )


def _decimal_edges(edges: Edges):
    return [(Decimal(str(edge)), label) for edge, label in edges]


def target_features(df: DataFrame, rules: SalesRules = DEFAULT_RULES) -> DataFrame:
    """Share of the region's daily target, 0 where there is none."""
    share = fx.percent(F.col("NetRevenue") * rules.target_days, "RevenueTarget")
    return df.withColumn("PctDailyTarget", share)


def commission(
    df: DataFrame,
    rules: SalesRules = DEFAULT_RULES,
    return_flag: str | None = None,
    round_base: bool = True,
) -> DataFrame:
    """Tier and return multipliers, base and final commission, band.

    With ``return_flag`` a returned line (Y) earns the reduced share; without it every line is a
    valid sale. ``round_base=False`` keeps the base unrounded until the final commission.
    """

    def factor(text: str) -> Column:
        return F.lit(text).cast("decimal(4,2)")

    tiers = fx.value_map(
        "DealTier", {k: factor(v) for k, v in rules.tier_multipliers}, factor(rules.tier_multiplier_default)
    )
    kept = factor("1")
    if return_flag:
        kept = F.when(F.col(return_flag) == "Y", factor(rules.returned_multiplier)).otherwise(kept)
    base = F.col("NetRevenue").cast(fx.MONEY) * F.col("CommissionRate").cast("decimal(6,4)")
    df = df.withColumns(
        {"TierMultiplier": tiers, "ReturnMultiplier": kept, "BaseCommission": fx.money(base) if round_base else base}
    )
    final = F.col("BaseCommission") * F.col("TierMultiplier") * F.col("ReturnMultiplier")
    df = df.withColumn("FinalCommission", fx.money(final))
    return df.withColumn(
        "CommissionBand", fx.band("FinalCommission", rules.commission_bands, rules.commission_band_default)
    )


# --- staging and enrichment ------------------------------------------------------------------

STAGING_COLUMNS = [
    "TransactionID", "OrderID", "CustomerID", "ProductID", "SalesRepID", "TransactionDate", "Quarter", "Year",
    "Month", "Quantity", "UnitPrice", "DiscountRate", "DiscountAmount", "GrossRevenue", "NetRevenue",
    "PaymentMethod",
]


def split_returns(transactions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid sales, everything else); an unknown flag goes to the second, so no row is lost."""
    return split_rows(transactions, F.col("ReturnFlag") == "N")


def stage_valid(transactions: DataFrame) -> DataFrame:
    return staged(valid_transactions(transactions)).select(*STAGING_COLUMNS)


def valid_transactions(transactions: DataFrame) -> DataFrame:
    """The valid sales as they came, without the flag."""
    valid, _ = split_returns(transactions)
    return valid.drop("ReturnFlag")


def staged(valid: DataFrame) -> DataFrame:
    """The staging columns of valid sales, and after them what joins have added: the columns that staging does not read."""
    features = revenue_features(date_features(valid)).withColumnRenamed("Discount", "DiscountRate")
    return features.select(*STAGING_COLUMNS, *[F.col(f"`{c}`") for c in features.columns if c not in STAGING_COLUMNS])


def staging_branches(transactions: DataFrame) -> tuple[DataFrame, list, list]:
    """Rows with their features, and the columns of the valid and of the other transactions, for ``sinks.save_split``."""
    names = {c: f"__raw_{c}" for c in transactions.columns}
    kept = transactions.withColumns({new: F.col(old) for old, new in names.items()})
    features = revenue_features(date_features(kept)).withColumn("DiscountRate", F.col("Discount"))
    return features, list(STAGING_COLUMNS), [F.col(new).alias(old) for old, new in names.items()]


def enrich_star(
    staging: DataFrame,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    reps: DataFrame | None = None,
    targets: DataFrame | None = None,
    target_keys: Sequence[str] = ("Region", "Year", "Quarter"),
    check: bool = False,
    late: Callable[[DataFrame], DataFrame] | None = None,
    joined: Sequence[str] = (),
) -> DataFrame:
    """Fact with its dimensions; every fact row stays exactly once when the keys are unique.

    Beyond broadcast size every join shuffles the fact with all columns it has by then, so ``late`` (``staged``) adds the
    fact's own formulas after the joins by key, and before the one with ``targets``. ``joined`` are the keys of the
    dimensions whose columns the fact already has, in full after ``late``; these are named all the same.

    Leave out a dimension whose columns are not needed: the optimizer keeps an unused outer join, and
    beyond broadcast size each one shuffles the fact. ``targets`` needs the customers' region.
    ``check`` verifies unique keys (one small job per dimension). ``target_keys=("Region", "Quarter")``
    suits targets of a single year.
    """
    df = staging
    dims = [(dim, key) for dim, key in ((customers, "CustomerID"), (products, "ProductID"), (reps, "SalesRepID")) if dim is not None]
    for dim, key in dims:
        if key not in joined:
            df = join_dim(df, dim, key, check=check)
        elif check:
            require_unique(dim, [key], "dimension")
    if late:
        # In the order in which the joins leave the columns: their keys first, that of the last join in front.
        keys = [key for _, key in reversed(dims)]
        added = [c for dim, _ in dims for c in dim.columns if c not in keys]
        df = late(df)
        own = [c for c in df.columns if c not in keys and c not in added]
        df = df.select(*keys, *[F.col(f"`{c}`") for c in [*own, *added]])
    if targets is not None:
        wanted = [*target_keys, "RevenueTarget", "UnitTarget", "RetentionTarget"]
        df = join_dim(df, targets, target_keys, wanted, check)
    return df


def enrich(
    staging: DataFrame,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    reps: DataFrame | None = None,
    targets: DataFrame | None = None,
    rules: SalesRules = DEFAULT_RULES,
    **star,
) -> DataFrame:
    """The enriched transactions the reports start from: joins plus every formula they allow."""
    df = enrich_star(staging, customers, products, reps, targets, **star)
    df = line_features(df, rules)
    if customers is not None:
        df = account_features(df, rules)
    if products is not None:
        df = margin_features(df)
    if targets is not None:
        df = target_features(df, rules)
    return commission(df, rules) if reps is not None else df


# --- reports ---------------------------------------------------------------------------------

def customer_kpi(enriched: DataFrame, rules: SalesRules = DEFAULT_RULES) -> DataFrame:
    df = enriched.groupBy("CustomerID", "CustomerName", "Segment", "Region", "AccountTier").agg(
        F.count("TransactionID").alias("TotalOrders"),
        F.sum("NetRevenue").alias("TotalRevenue"),
        F.sum("GrossRevenue").alias("TotalGross"),
        F.sum("GrossMargin").alias("TotalMargin"),
        F.sum("COGS").alias("TotalCOGS"),
        F.sum("Quantity").alias("TotalUnits"),
        F.max("NetRevenue").alias("MaxOrderValue"),
        F.sum("FinalCommission").alias("TotalCommission"),
        F.min("TransactionDate").alias("FirstOrderDate"),
        F.max("TransactionDate").alias("LastOrderDate"),
    )
    return df.withColumns(
        {
            "AvgOrderValue": fx.mean("TotalRevenue", "TotalOrders"),
            "MarginPct": fx.percent("TotalMargin", "TotalGross"),
            "CustomerValueBand": fx.band("TotalRevenue", rules.customer_bands, rules.customer_band_default),
        }
    )


def product_performance(enriched: DataFrame) -> DataFrame:
    df = enriched.groupBy(
        "ProductID", "ProductName", "Category", "SubCategory", "Brand", "MSRP", "CostPrice", "WarrantyMonths"
    ).agg(
        F.count("TransactionID").alias("TotalOrders"),
        F.sum("Quantity").alias("TotalUnitsSold"),
        F.sum("NetRevenue").alias("TotalRevenue"),
        F.sum("GrossMargin").alias("TotalMargin"),
        F.sum("DiscountAmount").alias("TotalDiscount"),
        F.count_distinct("CustomerID").alias("UniqueCustomers"),
    )
    return df.withColumn("AvgSalePrice", fx.mean("TotalRevenue", "TotalOrders"))


REP_KEYS = ("SalesRepID", "RepName", "Territory", "CommissionRate", "YTDQuota")


def rep_commission(enriched: DataFrame, by_region: bool = True, rules: SalesRules = DEFAULT_RULES) -> DataFrame:
    """Deals, commission and quota attainment per rep and customer region, or per rep alone.

    With ``by_region`` each row is compared with the rep's full quota, as the original report does.
    The most common tier is taken from one count per tier label (ties: alphabetical), which keeps
    the whole report in a single aggregation.
    """
    keys = [*REP_KEYS, "Region"] if by_region else list(REP_KEYS)
    labels = sorted(rules.tier_labels)
    counts = [F.count(F.when(F.col("DealTier") == t, 1)).alias(f"__tier{i}") for i, t in enumerate(labels)]
    df = enriched.groupBy(*keys).agg(
        F.count("TransactionID").alias("TotalDeals"),
        F.sum("NetRevenue").alias("TotalRevenue"),
        F.sum("GrossMargin").alias("TotalMargin"),
        F.sum("FinalCommission").alias("TotalCommission"),
        F.sum("Quantity").alias("TotalUnitsSold"),
        F.count_distinct("CustomerID").alias("UniqueAccounts"),
        F.max("NetRevenue").alias("LargestDeal"),
        *counts,
    )
    ranked = [F.struct(F.col(f"__tier{i}").alias("n"), F.lit(-i).alias("i")) for i in range(len(labels))]
    winner = -F.greatest(*ranked)["i"]
    names = F.array(*[F.lit(t) for t in labels])
    df = df.withColumn("MostCommonTier", F.get(names, winner)).drop(*[f"__tier{i}" for i in range(len(labels))])
    df = df.withColumn("QuotaAttainmentPct", fx.percent("TotalRevenue", "YTDQuota"))
    return df.withColumns(
        {
            "PerformanceBand": fx.band(
                "QuotaAttainmentPct", rules.performance_bands, rules.performance_band_default
            ),
            "AvgDealSize": fx.mean("TotalRevenue", "TotalDeals"),
        }
    )


def regional_dashboard(
    enriched: DataFrame, period: Sequence[str] = ("Year", "Quarter"), rules: SalesRules = DEFAULT_RULES
) -> DataFrame:
    """Actual against target per region and period."""
    df = enriched.groupBy("Region", *period, "RevenueTarget", "UnitTarget").agg(
        F.count("TransactionID").alias("TotalTransactions"),
        F.sum("NetRevenue").alias("ActualRevenue"),
        F.sum("GrossMargin").alias("ActualMargin"),
        F.sum("Quantity").alias("ActualUnits"),
        F.sum("FinalCommission").alias("TotalCommission"),
        F.count_distinct("CustomerID").alias("ActiveAccounts"),
    )
    df = df.withColumns(
        {
            "AvgTransactionValue": fx.mean("ActualRevenue", "TotalTransactions"),
            "RevenueAttainmentPct": fx.percent("ActualRevenue", "RevenueTarget"),
            "RevenueGap": fx.money(F.col("ActualRevenue") - F.col("RevenueTarget")),
            "MarginPct": fx.percent("ActualMargin", "ActualRevenue"),
        }
    )
    status = fx.band("RevenueAttainmentPct", rules.target_statuses, rules.target_status_default)
    return df.withColumn("TargetStatus", status).orderBy("Region", *period)
