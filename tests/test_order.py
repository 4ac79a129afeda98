"""Sorted results keep their order, ties broken as documented."""

import datetime as dt

from tallyloom.plans import reports, retail


def test_months_in_order(spark):
    days = [dt.date(2020, 9, 3), dt.date(2020, 12, 1), dt.date(2019, 12, 5), dt.date(2020, 9, 9)]
    tx = spark.createDataFrame([(d.replace(day=1), 1.0, k) for k, d in enumerate(days)], "Month date, `Purchase Price` double, `Customer ID` int")
    got = [(r["Month"], r["RunTot_Sales"]) for r in retail.monthly_running_total(tx.repartition(4)).collect()]
    assert got == [(dt.date(2019, 12, 1), 1.0), (dt.date(2020, 9, 1), 3.0), (dt.date(2020, 12, 1), 4.0)]


def test_ranked_list_with_a_tie(spark):
    rows = [("Visa", 5.0), ("Cash", 7.0), ("Wire", 5.0), ("Amex", 5.0)]
    staging = spark.createDataFrame(rows, "PaymentMethod string, NetRevenue double").repartition(4)
    assert [r["PaymentMethod"] for r in reports.by_payment(staging).collect()] == ["Cash", "Amex", "Visa", "Wire"]


def test_quarters_in_order(spark):
    staging = spark.createDataFrame([("Q3", 1.0), ("Q1", 2.0), ("Q4", 3.0), ("Q2", 1.0)], "Quarter string, NetRevenue double").repartition(4)
    assert [r["Quarter"] for r in reports.by_quarter(staging).collect()] == ["Q1", "Q2", "Q3", "Q4"]
