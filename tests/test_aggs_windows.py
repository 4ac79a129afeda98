import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window as W, functions as F

from tallyloom.operators import aggs, quality, windows
from tallyloom.plans import retail


def test_summarize(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None)], "k string, v int")
    out = aggs.summarize(df, "k", {"s": ("v", "sum"), "n": ("v", "count"), "d": ("v", "countDistinct"), "r": ("*", "count")})
    assert rows(out) == [("a", 4, 2, 2, 2), ("b", None, 0, 0, 1)]
    assert rows(aggs.summarize(df, [], {"lo": ("v", "min"), "hi": ("v", "max"), "m": ("v", "avg")})) == [(1, 3, 2.0)]
    with pytest.raises(ValueError):
        aggs.summarize(df, "k", {"x": ("v", "median")})


def test_mode(spark, rows):
    data = [("tie", "b"), ("tie", "a"), ("one", "z"), ("none", None), ("none", None), ("top", "q"), ("top", "q"), ("top", "a"), ("top", None), ("top", None), ("top", None)]
    df = spark.createDataFrame(data, "k string, v string")
    assert rows(aggs.mode_by(df, "k", "v", "m")) == [("none", None), ("one", "z"), ("tie", "a"), ("top", "q")]


def test_weighted_average(spark, rows):
    df = spark.createDataFrame([("a", 5, 1), ("a", 1, 3), ("z", 4, 0), ("n", 4, None)], "k string, v int, w int")
    assert rows(aggs.weighted_average(df, "v", "w", "k", "avg")) == [("a", 2.0), ("n", None), ("z", None)]


def test_revenue_profit_needs_profit(spark):
    with pytest.raises(ValueError):
        aggs.revenue_profit_by(spark.createDataFrame([("v", 1)], "c string, purchaseprice int"), "c")


def test_cross_tab_and_transpose(spark, rows):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 20), ("a", 3, 5), ("b", 2, 1)], "brand string, stars int, v int")
    assert rows(aggs.cross_tab(df, "brand", "stars", "v", [1, 2, 3])) == [("a", 2, 0, 1), ("b", 0, 1, 0)]
    assert rows(aggs.cross_tab(df, "brand", "stars", "v", [1, 2, 3], "sum")) == [("a", 30, None, 5), ("b", None, 1, None)]
    pct = aggs.cross_tab(df, "brand", "stars", "v", [1, 2, 3], "percent", prefix="p")
    assert pct.columns == ["brand", "p1", "p2", "p3"]
    assert [round(x, 3) for x in pct.filter("brand = 'a'").first()[1:]] == [66.667, 0.0, 33.333]
    wide = spark.createDataFrame([("k", 1, None)], "k string, a int, b int")
    assert rows(aggs.transpose(wide, ["k"], ["a", "b"])) == [("k", "a", 1), ("k", "b", None)]
    with pytest.raises(ValueError):
        aggs.cross_tab(df, "brand", "stars", "v", [1], "other")


@pytest.mark.parametrize("joined", [False, True])
def test_days_since_last(spark, rows, joined):
    day = lambda n: dt.date(2024, 1, n)
    data = [("c", day(1), 1), ("c", day(5), 3), ("c", day(5), 2), ("c", day(9), 4), ("d", day(2), 5), (None, day(1), 6), (None, day(4), 7), ("e", None, 8)]
    df = spark.createDataFrame(data, "cust string, d date, id int")
    out = windows.days_since_last(df, "cust", "d", "id", "gap", joined)
    assert rows(out, "id", "gap") == [(1, None), (2, 4), (3, 0), (4, 4), (5, None), (6, None), (7, 3), (8, None)]


@pytest.mark.parametrize("joined", [False, True])
def test_days_since_last_equals_plain_window_with_hot_key(spark, joined):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("cust"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 37 % 300).cast("int")).alias("d"),
        "id",
    )
    plain = F.datediff("d", F.lag("d").over(W.partitionBy("cust").orderBy("d", "id")))
    out = windows.days_since_last(df, "cust", "d", "id", "gap", joined).withColumn("want", plain)
    assert out.filter("not (gap <=> want)").count() == 0 and out.count() == 4000


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_look_back_over_joined_tables_scans_each_once(spark, tmp_path):
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("o") % 97).cast("int"))
    spark.range(900).select(F.col("id").alias("o"), (F.col("id") % 7).alias("cust")).withColumn("d", day).write.parquet(str(tmp_path / "orders"))
    spark.range(3000).select((F.col("id") % 900).alias("o"), "id", (F.col("id") % 5).alias("product")).write.parquet(str(tmp_path / "lines"))
    stock = spark.createDataFrame([(1, 7, dt.date(2019, 1, 1)), (2, 8, None), (None, 9, None)], "productid long, locationid int, purchasedate date")
    names = {"cust": "Customer ID", "d": "Transaction Date", "id": "Transaction ID", "product": "Product ID"}
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        tx = spark.read.parquet(str(tmp_path / "lines")).join(spark.read.parquet(str(tmp_path / "orders")), "o").withColumnsRenamed(names)
        found = {}
        for joined in (True, False):
            out = retail.with_product(retail.days_since_purchase(tx, joined), stock, joined)
            plan = final_plan(out)
            assert joined is (plan.count("FileScan parquet") == 2)
            found[joined] = sorted(tuple(r) for r in out.select("Transaction ID", "Days Since Last Purchase", "stock_locationid").collect())
        assert found[True] == found[False] and len(found[True]) == 1200
    finally:
        for key in off:
            spark.conf.unset(key)


def test_pct_change(spark):
    df = spark.createDataFrame([(2020, 0), (2021, 80), (2022, 100), (2024, 90)], "y int, v int")
    got = [r.c for r in windows.pct_change(df, "v", "y", "c").orderBy("y").collect()]
    assert got == [None, None, "25.0%", "-10.0%"]
    assert windows.pct_change(df, "v", "y", "c", label=False).orderBy("y").collect()[2].c == 0.25


@pytest.mark.parametrize("aggregated", [True, False])
def test_running_total(spark, rows, aggregated):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 3, 2), ("b", 1, 1), (None, 1, 4), (None, 2, 4)], "g string, o int, v int")
    out = windows.running_total(df, "v", ["o"], ["g"], "t", aggregated)
    assert rows(out, "g", "o", "t") == [(None, 1, 4), (None, 2, 8), ("a", 1, 5), ("a", 2, 5), ("a", 3, 7), ("b", 1, 1)]
    whole = windows.running_total(df.filter("g = 'a'"), "v", ["o"], aggregated=aggregated)
    assert rows(whole, "o", "RunTot_v") == [(1, 5), (2, 5), (3, 7)]


def test_running_total_over_many_partitions(spark):
    df = spark.range(20000).select((F.col("id") % 4).alias("g"), "id", F.lit(1).alias("v"))
    df = df.withColumn("g", F.when(F.col("g") < 3, 0).otherwise(F.col("id")))
    out = windows.running_total(df, "v", ["id"], ["g"], "t")
    want = F.row_number().over(W.partitionBy("g").orderBy("id"))
    assert out.withColumn("want", want).filter("t != want").count() == 0


@pytest.mark.parametrize("n", [1, 2])
def test_first_n(spark, rows, n):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9)], "k string, o int")
    small = rows(windows.first_n(df, ["k"], n, ["o"]))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "0")
    try:
        assert rows(windows.first_n(df, ["k"], n, ["o"])) == small
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert small == ([("a", 1), ("a", 2), ("b", 9)] if n == 2 else [("a", 1), ("b", 9)])


def test_record_id_and_ranges(spark, rows):
    df = spark.range(100).select((99 - F.col("id")).alias("k"))
    ids = windows.record_id(df, ["k"], start=5, name="n")
    assert ids.columns == ["n", "k"] and ids.filter("n != k + 5").count() == 0
    picked = windows.select_ranges(df, [(1, 3), (3, 4), (98,), (500, None)], ["k"])
    assert rows(picked) == [(0,), (1,), (2,), (3,), (97,), (98,), (99,)]
    assert windows.select_ranges(df, [], ["k"]).count() == 100


def test_surrogate_and_share(spark, rows):
    df = spark.createDataFrame([("b", 1), ("a", 3)], "k string, v int")
    for small in (True, False):
        assert rows(windows.surrogate_key(df.select("k"), ["k"], "id", small)) == [("a", 1), ("b", 2)]
    assert rows(windows.share_of_total(df, "v"), "k", "Share") == [("a", 0.75), ("b", 0.25)]
    zero = spark.createDataFrame([("a", 0)], "k string, v int")
    assert rows(windows.share_of_total(zero, "v", "s", "t")) == [("a", 0, 0, None)]


def test_zip(spark, rows):
    a = spark.createDataFrame([("x",), ("y",), ("z",)], "a string")
    b = spark.createDataFrame([(2,), (1,)], "b int")
    assert rows(windows.zip_by_position([(a, ["a"]), (b, ["b"])])) == [(1, "x", 1), (2, "y", 2), (3, "z", None)]


def test_yearly_ytd_compares_numbers_not_text(spark, rows):
    data = [(1, dt.date(2022, 9, 1), 10), (2, dt.date(2022, 12, 1), 5), (1, dt.date(2023, 2, 1), 7), (3, dt.date(2022, 1, 3), 1)]
    df = spark.createDataFrame(data, ["Customer ID", "Transaction Date", "Purchase Price"])
    out = retail.yearly_ytd(retail.time_features(df))
    assert rows(out, "Year", "Customers", "Revenue") == [(2022, 1, 1), (2023, 1, 7)]
    late = spark.createDataFrame(data + [(9, dt.date(2023, 12, 1), 2)], df.columns)
    out = retail.yearly_ytd(retail.time_features(late))
    assert rows(out, "Year", "Customers", "Revenue") == [(2022, 3, 16), (2023, 2, 9)]


def test_brand_revenue_latest_year(spark, rows):
    data = [(1, 2022, 9), (1, 2023, 1), (2, 2023, 2), (3, 2022, 5), (4, 2023, 8)]
    df = spark.createDataFrame(data, ["brandid", "Year", "Purchase Price"])
    brands = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "brandid int, brandname string")
    assert rows(retail.brand_revenue(df, brands)) == [("a", 3)]


def test_brand_ratings_are_counted_before_the_join(spark, rows):
    reviews = spark.createDataFrame([(1, 5, "abc"), (1, 5, None), (2, 1, "ab"), (9, 3, "x")], "brandid int, starrating int, review string")
    brands = spark.createDataFrame([(1, "a"), (2, "a")], "brandid int, brandname string")
    assert rows(retail.rating_cross_tab(reviews, brands)) == [(None, 0, 0, 1, 0, 0), ("a", 1, 0, 0, 0, 2)]
    assert rows(retail.weighted_rating(reviews, brands)) == [(None, 3.0), ("a", 22 / 6)]


def test_engagement(spark, rows):
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customerid int")
    reviews = spark.createDataFrame([(1,), (1,), (9,)], "customerid int")
    assert rows(retail.review_engagement(customers, reviews)) == [(1, 3, "33.3%")]


def test_profile_and_grain(spark, rows):
    df = spark.createDataFrame([(1, None), (1, Decimal("2.50"))], "k int, v decimal(5,2)")
    assert rows(quality.profile_table(df)) == [("k", "int", 2, 0, "1", "1"), ("v", "decimal(5,2)", 2, 1, "2.50", "2.50")]
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
