"""The sales pipeline on hand-made rows."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from tallyloom import registry
from tallyloom.operators import joins, sinks
from tallyloom.plans import reports, retail, sales
from tallyloom.registry import reports as report_queries, sales as registered
from tallyloom.sources import model


@pytest.fixture(scope="module")
def tables(spark):
    tx = spark.createDataFrame(
        [
            ("T1", "O1", "C1", "P1", "R1", "2024-01-05", 10, Decimal("250.00"), Decimal("0.10"), "Wire Transfer", "N"),
            ("T2", "O2", "C2", "P1", "R1", "2024-04-01", 1, Decimal("99.99"), Decimal("0.00"), "PayPal", "N"),
            ("T3", "O3", "C9", "P2", "R2", "2024-01-07", 4, Decimal("200.00"), Decimal("0.05"), "Credit Card", "N"),
            ("T4", "O4", "C1", "P2", "R1", "2024-02-01", 1, Decimal("10.00"), Decimal("0.00"), "PayPal", "Y"),
            ("T5", "O5", "C1", "P2", "R1", "2024-02-01", 1, Decimal("10.00"), Decimal("0.00"), "PayPal", None),
        ],
        "TransactionID string, OrderID string, CustomerID string, ProductID string, SalesRepID string, "
        "TransactionDate string, Quantity int, UnitPrice decimal(18,2), Discount decimal(4,2), PaymentMethod string, "
        "ReturnFlag string",
    )
    customers = spark.createDataFrame(
        [("C1", "Ann", "SMB", "North", 80000, "2023-01-05"), ("C2", "Bob", "SMB", "South", 11999, "2024-01-01")],
        "CustomerID string, CustomerName string, Segment string, Region string, CreditLimit int, AccountOpenDate string",
    )
    products = spark.createDataFrame(
        [("P1", "Pump", "HW", "A", "X", Decimal("100.00"), Decimal("260.00"), 12), ("P2", "Pipe", "HW", "B", "X", Decimal("50.00"), Decimal("210.00"), 12)],
        "ProductID string, ProductName string, Category string, SubCategory string, Brand string, "
        "CostPrice decimal(18,2), MSRP decimal(18,2), WarrantyMonths int",
    )
    reps = spark.createDataFrame(
        [("R1", "Rob", "N1", Decimal("0.08"), 2000), ("R2", "Sue", "S1", Decimal("0.07"), 0)],
        "SalesRepID string, RepName string, Territory string, CommissionRate decimal(6,4), YTDQuota int",
    )
    targets = spark.createDataFrame(
        [("North", 2024, "Q1", 9000, 10, Decimal("0.85")), ("North", 2023, "Q1", 1, 1, Decimal("0.85"))],
        "Region string, Year int, Quarter string, RevenueTarget int, UnitTarget int, RetentionTarget decimal(4,2)",
    )
    return tx, customers, products, reps, targets


@pytest.fixture(scope="module")
def enriched(tables):
    tx, *dims = tables
    return sales.enrich(sales.stage_valid(tx), *dims, check=True)


def test_split_loses_nothing(tables, rows):
    valid, returned = sales.split_returns(tables[0])
    assert rows(valid, "TransactionID") == [("T1",), ("T2",), ("T3",)]
    assert rows(returned, "TransactionID") == [("T4",), ("T5",)]


def test_staging(tables):
    staged = sales.stage_valid(tables[0])
    assert staged.columns == sales.STAGING_COLUMNS
    one = staged.filter("TransactionID = 'T1'").first()
    assert (one.TransactionDate, one.Quarter, one.Year, one.Month) == (dt.date(2024, 1, 5), "Q1", 2024, "January")
    assert (one.GrossRevenue, one.NetRevenue, one.DiscountAmount) == (2500, 2250, 250)


def test_enriched_keeps_grain(enriched):
    assert enriched.count() == 3
    one = enriched.filter("TransactionID = 'T1'").first()
    assert (one.COGS, one.GrossMargin, one.MarginPct) == (1000, 1250, 60.0)
    assert (one.DealTier, one.DiscountTier, one.PaymentRisk, one.AccountTier) == ("Platinum", "Standard Discount", "Low Risk", "Strategic")
    assert (one.RevenuePerUnit, one.PctDailyTarget, one.AccountAgeDays) == (225.0, 2250.0, 365)
    assert (one.BaseCommission, one.FinalCommission, one.CommissionBand) == (180, 270, "Mid Commission")
    unknown = enriched.filter("TransactionID = 'T3'").first()
    assert (unknown.Region, unknown.RevenueTarget, unknown.AccountTier, unknown.PctDailyTarget) == (None, None, "Starter", 0.0)


def test_duplicate_dimension_key_is_refused(tables):
    tx, customers, *rest = tables
    with pytest.raises(ValueError):
        sales.enrich_star(sales.stage_valid(tx), customers.union(customers), *rest, check=True)


def test_targets_of_two_years_need_the_year(tables):
    tx, *dims = tables
    with pytest.raises(ValueError):
        sales.enrich_star(sales.stage_valid(tx), *dims, target_keys=("Region", "Quarter"), check=True)


def test_reports(enriched):
    kpi = {r.CustomerID: r for r in sales.customer_kpi(enriched).collect()}
    assert (kpi["C1"].TotalOrders, kpi["C1"].AvgOrderValue, kpi["C1"].MarginPct, kpi["C1"].CustomerValueBand) == (1, 2250.0, 50.0, "Growth")
    product = {r.ProductID: r for r in sales.product_performance(enriched).collect()}
    assert (product["P1"].TotalUnitsSold, product["P1"].UniqueCustomers, float(product["P1"].TotalRevenue)) == (11, 2, 2349.99)
    assert sales.rep_commission(enriched).count() == 3
    total = {r.SalesRepID: r for r in sales.rep_commission(enriched, by_region=False).collect()}
    assert (total["R1"].QuotaAttainmentPct, total["R1"].PerformanceBand, total["R1"].MostCommonTier) == (117.5, "Overachiever", "Bronze")
    assert (total["R2"].QuotaAttainmentPct, total["R2"].PerformanceBand) == (0.0, "Underperforming")
    board = {(r.Region, r.Quarter): r for r in sales.regional_dashboard(enriched).collect()}
    north = board[("North", "Q1")]
    assert (north.RevenueAttainmentPct, north.RevenueGap, north.TargetStatus, north.MarginPct) == (25.0, -6750, "Off Track", 55.6)


def test_returned_value(tables):
    out = reports.returned_value(sales.split_returns(tables[0])[1], net=True).first()
    assert tuple(out) == (2, 20, 20)


def test_the_row_kept_for_a_tied_key_does_not_depend_on_the_partitions(spark):
    rows = [(k % 3, "same", f"v{k}", None if k % 2 else k) for k in range(60)]
    df = spark.createDataFrame(rows, "k int, o string, v string, w int")
    found = {tuple(sorted(map(tuple, retail.dim_first(part, "k", ["o"]).collect()))) for part in (df.coalesce(1), df.repartition(7), df.repartition(5, "v"))}
    assert len(found) == 1


def test_ids_and_formulas_come_after_the_joins_that_shuffle_the_fact(spark):
    for name in ("star_enriched", "enriched_transactions"):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan[plan.rindex("concat_ws") :].count("LeftOuter") == 3


def test_late_formulas_give_the_staged_star(tables):
    tx, *dims = tables
    late = sales.enrich_star(sales.valid_transactions(tx), *dims, late=sales.staged)
    plain = sales.enrich_star(sales.stage_valid(tx), *dims)
    assert late.columns == plain.columns and sorted(map(str, late.collect())) == sorted(map(str, plain.collect()))
    assert sales.stage_valid(tx.selectExpr("*", "1 AS other")).columns == sales.STAGING_COLUMNS


def star_tables(spark, d):
    """Tables with null and repeated keys, orders without customers or lines, and lines without products or reps."""
    day = dt.datetime(1996, 5, 2)
    rows = {
        "region": [(0, "AFRICA"), (1, "ASIA")],
        "nation": [(0, "N0", 0), (1, "N1", 1)],
        "customer": [(1, "Ann", 0, 4000.0, "SMB"), (2, None, 1, 100.5, None), (2, "Bob", 1, 9000.0, "HW"), (None, "Nil", 0, 1.0, "HW"), (3, "Far", 9, 1.0, "HW")],
        "supplier": [(1, "Rob", 0, 1.0), (2, None, 1, 2.0), (2, "Sue", 0, 2.0), (None, "Nil", 1, 3.0)],
        "part": [(1, "pump", "Brand#1", "LARGE", 4, 900.0), (1, "pipe", None, "SMALL", None, None), (2, None, "Brand#2", None, 7, 10.0), (None, "nil", "x", "y", 1, 1.0)],
        "orders": [(k, c, "O", 1.0, day, p) for k, c, p in [(1, 1, "1-URGENT"), (2, 2, "5-LOW"), (3, 8, None), (4, None, "3-MEDIUM"), (4, 3, "2-HIGH"), (5, 1, "5-LOW"), (None, 1, "5-LOW")]],
        "lineitem": [
            (o, p, s, n, 2.0, 50.0 * n, 0.05, 0.0, f, "O", day)
            for n, (o, p, s, f) in enumerate([(1, 1, 1, "N"), (1, 2, 2, "A"), (2, 1, 2, None), (3, 9, 1, "N"), (4, None, 9, "N"), (4, 2, None, "R"), (9, 1, 1, "N"), (None, 1, 1, "N")], 1)
        ],
    }
    for name, found in rows.items():
        spark.createDataFrame(found, model.SCHEMAS[name]).write.parquet(f"{d}/{name}.parquet")
    return str(d)


@pytest.mark.parametrize("few", [500_000, 0])
def test_narrow_joins_give_the_enriched_rows(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(registered, "FEW_REPS", few)
    d = star_tables(spark, tmp_path)
    got, want = registered.enriched_whole(spark, d), registered.enriched(spark, d)
    assert got.columns == want.columns and want.count() == 2 + 2 + 8 + 1 + 2
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("few", [500_000, 0])
def test_texts_of_dimensions_are_not_shuffled_with_the_lines(spark, monkeypatch, few):
    """Beyond broadcast size: three or four exchanges of the fact, by key, and no column that a number can stand for."""
    monkeypatch.setattr(registered, "FEW_REPS", few)
    monkeypatch.setattr(joins, "measured", lambda dim, rows: F.broadcast(dim) if rows else dim)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.QUERIES["enriched_transactions"](spark, "/root/testdata/sf0.001")
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = df._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((\w+)#", plan)
    by_key = {key: cols for cols, key in moved if key in ("l_suppkey", "l_partkey", "l_orderkey", "o_custkey", "o_orderkey")}
    assert len(by_key) == (4 if few else 5)
    assert not any(key in ("CustomerID", "SalesRepID") and "OrderID" in cols for cols, key in moved)
    assert not any(f" {c}#" in cols for cols in by_key.values() for c in ("Segment", "Country", "State", "Category", "Brand"))
    assert "CustomerName#" not in by_key["l_orderkey"] and "__texts_CustomerID#" in by_key["o_orderkey"]


@pytest.mark.parametrize("by_product", [True, False])
def test_parts_make_the_enriched_rows(spark, tmp_path, by_product):
    """Each order in one part, and the other lines and orders of a part are left out before they are shuffled."""
    d = star_tables(spark, tmp_path)
    parts, want = registered.enriched_parts(spark, d, 3, by_product), registered.enriched(spark, d)
    assert all(p.columns == want.columns for p in parts)
    found = [p.collect() for p in parts]
    assert sorted(str(r) for rows in found for r in rows) == sorted(map(str, want.collect()))
    assert sum(len({r.OrderID for r in rows}) for rows in found) == want.select("OrderID").distinct().count()
    plan = parts[1]._jdf.queryExecution().optimizedPlan().toString()
    assert all(f"pmod(xxhash64({key}#" in plan for key in ("l_orderkey", "o_orderkey"))


def test_table_sizes_in_parts(spark, tmp_path, monkeypatch):
    d = star_tables(spark, tmp_path)
    stored = []

    def kept(shared, found):
        stored.append(len(shared))
        return sinks.run_reports(shared, found)

    monkeypatch.setattr(report_queries, "run_reports", kept)
    whole = sorted(map(tuple, registry.QUERIES["table_sizes"](spark, d).collect()))
    monkeypatch.setattr(report_queries, "PART_BYTES", 1)
    assert sorted(map(tuple, registry.QUERIES["table_sizes"](spark, d).collect())) == whole
    assert stored == [1, 4] and ("enriched_transactions", 15, 54) in whole and ("staging_returned_orders", 2, 11) in whole
