import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import formulas as fx
from tallyloom.plans import sales


def value(spark, column, **inputs):
    """The column's value over one row of typed inputs ``name=(value, type)``."""
    schema = ", ".join(f"{n} {t}" for n, (_, t) in inputs.items()) or "x int"
    data = [tuple(v for v, _ in inputs.values()) or (1,)]
    return spark.createDataFrame(data, schema).select(column.alias("out")).first().out


@pytest.mark.parametrize(
    "amount, label", [(2000, "Platinum"), ("1999.99", "Gold"), (800, "Gold"), (300, "Silver"), ("299.99", "Bronze"), (-5, "Bronze"), (None, "Bronze")]
)
def test_deal_band_edges(spark, amount, label):
    rules = sales.DEFAULT_RULES
    cell = amount if amount is None else Decimal(amount)
    column = fx.band("v", rules.deal_tiers, rules.deal_tier_default)
    assert value(spark, column, v=(cell, "decimal(18,2)")) == label


@pytest.mark.parametrize("n, d, want", [(1, 3, 33.3), (1225, 10000, 12.3), (-1225, 10000, -12.3), (5, 0, 0.0), (5, -1, 0.0), (5, None, 0.0), (None, 5, None)])
def test_percent(spark, n, d, want):
    assert value(spark, fx.percent("n", "d"), n=(n, "int"), d=(d, "int")) == want


def test_money_and_multiples(spark):
    assert value(spark, fx.money(F.lit("2.345").cast("decimal(6,3)"))) == Decimal("2.35")
    assert float(value(spark, fx.round_to_multiple("v", 0.1), v=(12.34, "double"))) == 12.3
    assert float(value(spark, fx.round_to_multiple("v", 5), v=(12.5, "double"))) == 15.0


@pytest.mark.parametrize(
    "method, amount, risk",
    [("Wire Transfer", "999.99", "PayPal Risk"), ("Wire Transfer", "1000", "Low Risk"), ("Credit Card", "1", "Medium Risk"), ("PayPal", "1", "PayPal Risk"), (None, "1", "PayPal Risk")],
)
def test_payment_risk(spark, method, amount, risk):
    got = value(spark, sales.payment_risk(), PaymentMethod=(method, "string"), NetRevenue=(Decimal(amount), "decimal(18,2)"))
    assert got == risk


def test_dates(spark):
    day = dt.date(2024, 5, 17)
    got = [value(spark, f("d"), d=(day, "date")) for f in (fx.quarter_label, fx.month_name, fx.month_start)]
    assert got == ["Q2", "May", dt.date(2024, 5, 1)]
    assert value(spark, fx.as_of_date("2024-06-30", text=True)) == "06-30-2024"
    assert value(spark, fx.as_of_date()) is not None


@pytest.mark.parametrize("text, day", [("01/31/2020", dt.date(2020, 1, 31)), ("13/45/2020", None), ("", None), (None, None)])
def test_parse_date(spark, text, day):
    assert value(spark, fx.parse_date("t"), t=(text, "string")) == day


@pytest.mark.parametrize("text, parts", [("a-b", ("a", "b", None)), ("a-b-c", ("a", "b", "c")), ("a-b-c-d", ("a", "b", "c-d")), (None, (None,) * 3)])
def test_split_part(spark, text, parts):
    assert tuple(value(spark, fx.split_part("t", "-", 3, i), t=(text, "string")) for i in (1, 2, 3)) == parts


def test_split_part_takes_the_separator_literally(spark):
    assert value(spark, fx.split_part("t", "|", 2, 2), t=("a|b", "string")) == "b"
    assert value(spark, fx.split_part("t", ".", 2, 1), t=("a.b", "string")) == "a"


def test_text(spark):
    assert value(spark, fx.strip_non_printable("t"), t=("né🙂\tw~ ", "string")) == "nw~ "
    assert value(spark, fx.text_length("t"), t=(None, "string")) == 1
    assert value(spark, fx.text_length("t"), t=("", "string")) == 0
    assert value(spark, fx.full_name("a", "b"), a=("Ann", "string"), b=(None, "string")) is None


@pytest.mark.parametrize("n, d, want", [
    ("0.1235", 1, "12.4%"), (-1235, 10000, "-12.4%"), ("12.2499997", 100, "12.2%"), (1, 0, None), (None, 5, None), (5, None, None), (1, -8, "-12.5%"), (-1, 3000, "0.0%"),
])
def test_percent_label(spark, n, d, want):
    cell = n if n is None else Decimal(n)
    assert value(spark, fx.percent_label("a", "b"), a=(cell, "decimal(18,7)"), b=(d, "int")) == want


@pytest.mark.parametrize("n, d, want", [
    (2, 3, "66.6%"), (2, 0, None), (1, 1, "100%"), (1, 10, "10%"), (1, 20, "5%"), (10666, 100000, "10.6%"), (21, 200, "10.5%"), (0, 7, "0%"), (12, 1, "1200%"), (99999999, 10**9, "9.99%"),
])
def test_truncated_percent_label(spark, n, d, want):
    assert value(spark, fx.truncated_percent_label("a", "b"), a=(n, "bigint"), b=(d, "bigint")) == want


@pytest.mark.parametrize("n, d, digits, want", [
    ("12.249999", 1, 1, 12.2), ("122.499997", 10, 1, 12.2), ("0.499996", 10, 1, 0.0), ("0.5", 10, 1, 0.1), ("-12.25", 1, 1, -12.3), ("12.25", 1, 1, 12.3),
    ("10000000000000.05", 1, 1, 10000000000000.1), ("10000000000000.04", 1, 1, 10000000000000.0), ("9999999999999999.99", 1, 2, 9999999999999999.99), ("1", 3, 4, 0.3333),
])
def test_ratio_rounds_the_exact_quotient(spark, n, d, digits, want):
    assert value(spark, fx.ratio("a", "b", digits), a=(Decimal(n), "decimal(28,6)"), b=(d, "int")) == want


def test_ratio_of_doubles(spark):
    assert value(spark, fx.ratio("a", "b", 1), a=(12.25, "double"), b=(1, "int")) == 12.3
    assert value(spark, fx.ratio("a", "b", 1), a=(0.1 + 0.2 + 0.15, "double"), b=(1, "int")) == 0.5


def _line(spark, net, rate="0.08", flag="N", tier=None):
    df = spark.createDataFrame([(Decimal(net), Decimal(rate), flag)], "NetRevenue decimal(18,2), CommissionRate decimal(6,4), ReturnFlag string")
    tiers = fx.band("NetRevenue", sales.DEFAULT_RULES.deal_tiers, "Bronze")
    return df.withColumn("DealTier", F.lit(tier) if tier else tiers)


@pytest.mark.parametrize("net, factor", [("2000", "1.50"), ("800", "1.25"), ("300", "1.00"), ("100", "0.75")])
def test_commission_tiers(spark, net, factor):
    out = sales.commission(_line(spark, net)).first()
    assert out.TierMultiplier == Decimal(factor) and out.ReturnMultiplier == 1
    assert out.FinalCommission == round(Decimal(net) * Decimal("0.08") * Decimal(factor), 2)


def test_commission_returns_and_rounding(spark):
    back = sales.commission(_line(spark, "2000", flag="Y"), return_flag="ReturnFlag").first()
    assert back.ReturnMultiplier == Decimal("0.5") and back.FinalCommission == Decimal("120.00")
    assert sales.commission(_line(spark, "2000", flag="Y")).first().FinalCommission == Decimal("240.00")
    tie = _line(spark, "100.06", "0.0750", tier="Gold")  # base 7.5045
    assert sales.commission(tie).first().FinalCommission == Decimal("9.38")  # 7.50 x 1.25
    assert sales.commission(tie, round_base=False).first().FinalCommission == Decimal("9.38")
    half = _line(spark, "100.20", "0.0750", tier="Platinum")  # base 7.515 -> 7.52
    assert sales.commission(half).first().FinalCommission == Decimal("11.28")
    assert sales.commission(half, round_base=False).first().FinalCommission == Decimal("11.27")
