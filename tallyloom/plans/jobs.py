"""The two pipelines end to end: CSV folder in, catalog tables out.

Each stage is stored before the next one starts from the stored table, so nothing is planned twice.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.lookups import US_STATES
from tallyloom.operators.joins import customer_review_join
from tallyloom.operators.sinks import sanitize_columns, save_split, save_table
from tallyloom.plans import retail, sales
from tallyloom.sources import files
from tallyloom.sources.schemas import RETAIL, SALES, TREND, TREND_TITLE


@dataclass(frozen=True)
class Layout:
    """Where a pipeline reads and writes.

    ``storage`` is an optional folder for the tables' files. ``files`` names inputs that are not
    called ``<table>.csv``, ``renames`` the columns of an input whose header has other names than
    the schema. ``trends`` is a glob of titled CSV files below the source.
    """

    source: str
    schema: str = "default"
    storage: str | None = None
    fmt: str = "parquet"
    files: Mapping[str, str] = field(default_factory=dict)
    renames: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    trends: str | None = None

    def csv(self, name: str) -> str:
        return f"{self.source.rstrip('/')}/{self.files.get(name, name + '.csv')}"

    def place(self, spark: SparkSession, name: str) -> str:
        root = self.storage or spark.conf.get("spark.sql.warehouse.dir")
        return f"{root.rstrip('/')}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.storage.rstrip('/')}/{name}" if self.storage else None
        return save_table(df, f"{self.schema}.{name}", fmt=self.fmt, path=path)


def run_sales(
    spark: SparkSession,
    layout: Layout,
    rules: sales.SalesRules = sales.DEFAULT_RULES,
    target_keys: tuple[str, ...] = ("Region", "Year", "Quarter"),
) -> dict[str, DataFrame]:
    """Staging, enriched transactions and the four reports; returns the stored tables."""
    source = {name: files.read_csv(spark, layout.csv(name), schema, rename=layout.renames.get(name)) for name, schema in SALES.items()}
    out = {}
    if layout.fmt == "parquet":  # both from one pass
        features, valid, returned = sales.staging_branches(source["sales_transactions"])
        tables = [f"{layout.schema}.staging_{name}" for name in ("valid_transactions", "returned_orders")]
        split = {tables[0]: (F.col("ReturnFlag") == "N", valid), tables[1]: (None, returned)}
        stored = save_split(features, split, layout.place(spark, "staging_split"))
        out |= {name.removeprefix(f"{layout.schema}."): df for name, df in stored.items()}
    else:
        valid, returned = sales.stage_valid(source["sales_transactions"]), sales.split_returns(source["sales_transactions"])[1]
        out["staging_valid_transactions"] = layout.save(valid, "staging_valid_transactions")
        out["staging_returned_orders"] = layout.save(returned, "staging_returned_orders")
    people = source["customers"].drop("Email", "Phone", "IsActive")
    goods = source["products"].drop("LaunchDate", "IsActive", "MinStock", "MaxStock")
    reps = source["sales_reps"].select("SalesRepID", "RepName", "Territory", "CommissionRate", "YTDQuota")
    enriched = sales.enrich(
        out["staging_valid_transactions"], people, goods, reps, source["regional_targets"], rules,
        target_keys=target_keys, check=True,
    )
    enriched = out["enriched_transactions"] = layout.save(enriched, "enriched_transactions")
    reports = {
        "customer_kpi_report": sales.customer_kpi(enriched, rules),
        "product_performance": sales.product_performance(enriched),
        "rep_commission_report": sales.rep_commission(enriched, True, rules),
        "regional_dashboard": sales.regional_dashboard(enriched, rules=rules),
        "returned_orders_flagged": out["staging_returned_orders"],
    }
    for name, df in reports.items():
        out[name] = layout.save(df, name)
    return out


def run_retail(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """Bronze, silver, dimension and gold tables of the retail model; returns the stored tables.

    Sources that are not delivered are skipped, and with them the tables that need them: transactions,
    products and both location files for the fact and the market tables, customers and reviews for
    engagement, brands for the brand tables, customers that carry coordinates (``lat``, ``lon``, in
    the file ``customer_geo``) for the trade areas. Trend lines that cannot be read are a table too.
    """
    out, bronze = {}, {}
    for name, schema in RETAIL.items():
        for found in files.ingest_bronze(spark, {name: layout.csv(name)}, schema=schema, rename=layout.renames.get(name)).values():
            bronze[name] = out[f"bronze_{name}"] = layout.save(found, f"bronze_{name}")

    def keep(df: DataFrame, name: str) -> DataFrame:
        out[name] = layout.save(sanitize_columns(df), name)
        return out[name].toDF(*df.columns)

    if "customer" in bronze:
        silver_customers = keep(retail.typed_customers(bronze["customer"]), "silver_customer")
        keep(retail.dim_first(bronze["customer"], "customerid", ["lastname", "firstname", "email"]), "dim_customer")
    if "review" in bronze:
        silver_reviews = keep(retail.typed_reviews(bronze["review"]), "silver_review")
    if "geolocation" in bronze:
        keep(retail.dim_first(bronze["geolocation"], "locationid", ["latitude", "longitude"]), "dim_location")
    if "stock" in bronze:
        keep(retail.dim_first(bronze["stock"], "productid", ["purchasedate", "brandid"]), "dim_product")
    if {"transaction", "stock", "location", "geolocation"} <= bronze.keys():
        fact = retail.enriched_transactions(*[bronze[n] for n in ("transaction", "stock", "location", "geolocation")])
        fact = keep(fact, "fact_transaction")
        keep(retail.dim_date(fact), "dim_date")
        keep(retail.monthly_running_total(fact), "gold_monthly_sales")
        keep(retail.yearly_ytd(fact), "gold_yearly_to_date")
        if "brand" in bronze:
            keep(retail.brand_revenue_share(fact, bronze["brand"]), "gold_brand_revenue_share")
        keep(retail.daily_summary(fact), "gold_daily_transaction_summary")
    if "transaction" in bronze:
        keep(retail.dim_card_type(bronze["transaction"]), "dim_creditcard_type")
        keep(retail.card_revenue_profit(bronze["transaction"]), "gold_creditcard_revenue_summary")
    if "brand" in bronze:
        brands = keep(retail.typed_brands(bronze["brand"]), "silver_brand")
    if {"brand", "review", "customer"} <= bronze.keys():
        keyed = silver_reviews.withColumn("reviewkey", F.xxhash64(*silver_reviews.columns))
        keep(retail.enriched_reviews(keyed, brands, bronze["customer"]), "gold_reviews")
        keep(retail.weighted_rating(silver_reviews, brands), "gold_brand_rating")
        keep(retail.rating_cross_tab(silver_reviews, brands), "gold_rating_cross_tab")
    if {"customer", "review"} <= bronze.keys():
        keep(retail.review_engagement(bronze["customer"], bronze["review"]), "gold_engagement_rate")
    if {"customer_geo", "location", "geolocation"} <= bronze.keys():
        stores = retail.location_dim(bronze["location"], bronze["geolocation"]).select(
            F.col("locationid").alias("storeid"), F.col("geo_latitude").alias("store_lat"), F.col("geo_longitude").alias("store_lon")
        )
        area = retail.trade_area_summary(bronze["customer_geo"], stores, "customerid")
        keep(area.withColumn("CoveringStores", F.array_join("CoveringStores", ",")), "gold_trade_area")
        keep(retail.trade_area_buckets(bronze["customer_geo"], stores, "customerid"), "gold_trade_area_buckets")
    if layout.trends:
        path = f"{layout.source.rstrip('/')}/{layout.trends}"
        trend, rejects = files.read_csv_preamble(spark, path, TREND, TREND_TITLE, file_column="FileName")
        out["bronze_trend"] = layout.save(sanitize_columns(trend), "bronze_trend")
        out["bronze_trend_rejects"] = layout.save(rejects, "bronze_trend_rejects")
        keep(out["bronze_trend"].select("Week", "interest"), "silver_trend")
    if {"customer", "review"} <= bronze.keys():
        engagement = customer_review_join(silver_customers, silver_reviews, US_STATES)
        keep(engagement, "gold_customer_review_engagement")
    return out
