from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.operators import rows as ops
from tallyloom.operators.ordering import global_index, group_row_number


def test_split_is_total(spark, rows):
    df = spark.createDataFrame([(1, "Y"), (2, "N"), (3, None), (4, "n")], "id int, flag string")
    kept, other = ops.split_rows(df, "flag = 'N'")
    assert rows(kept, "id") == [(2,)]
    assert rows(other, "id") == [(1,), (3,), (4,)]


def test_select_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert ops.select_cols(df, ["c"], {"c": "z"}, keep_rest=True).columns == ["z", "a", "b"]
    assert ops.rename_cols(df, {"a": "x"}).columns == ["x", "b", "c"]


def test_casts(spark, rows):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    assert rows(ops.cast_cols(df, {"v": "int"}, strict=False)) == [(None,), (None,), (1,)]
    with pytest.raises(PySparkException):
        ops.cast_cols(df, {"v": "int"}).collect()


def test_backfill(spark, rows):
    df = spark.createDataFrame(
        [("A", None), ("B", ""), ("C", "  "), ("D", "http://d"), (None, None)], "brandname string, website string"
    )
    search = "http://www.google.com/search?q="
    assert dict(rows(ops.backfill_urls(df))) == {
        "A": search + "A", "B": search + "B", "C": search + "C", "D": "http://d", None: None,
    }
    assert dict(rows(ops.backfill_urls(df, blank_is_null=False)))["B"] == ""


def test_cleanse(spark, rows):
    df = spark.createDataFrame([("  the\tbig \r\n  café ",), (None,)], "t string")
    assert rows(ops.cleanse_text(df, "t")) == [(None,), ("the big café",)]
    assert rows(ops.cleanse_text(df, "t", case="title")) == [(None,), ("The Big Café",)]
    assert ops.cleanse_text(df, "absent").columns == ["t"]
    with pytest.raises(ValueError):
        ops.cleanse_text(df, "t", case="odd")


def test_drop_nulls_and_duplicates(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k int, v string")
    assert rows(ops.drop_nulls(df)) == [(2, "a")]
    assert ops.drop_nulls(df, ["k"]).count() == 3
    assert rows(ops.drop_duplicates(df)) == [(1, None), (2, "a")]
    assert ops.drop_duplicates(df, ["k"]).count() == 2


def test_unique_and_duplicates_partition_the_input(spark, rows):
    data = [(1, 3, "a"), (1, 1, "b"), (None, 2, "c"), (None, 1, "d"), (2, 1, "e")]
    df = spark.createDataFrame(data, "k int, o int, v string")
    unique, dups = ops.unique_by(df, ["k"], ["o"])
    assert rows(unique, "v") == [("b",), ("d",), ("e",)]
    assert rows(dups, "v") == [("a",), ("c",)]


def test_infer_types(spark, rows):
    data = [
        ("1", "200", "40000", "5000000000", "1.5", "2024-01-31", "2024-01-31 10:00:00", "x", None, " 7 "),
        ("-128", "-300", "7", "1", "2", "2023-12-01", "2024-02-01 11:30:00", "2", None, "8"),
    ]
    names = "tiny small mid big real day time mixed none padded".split()
    df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))
    assert dict(rows(ops.infer_types_profile(df))) == {
        "tiny": "tinyint", "small": "smallint", "mid": "int", "big": "bigint", "real": "double", "day": "date",
        "time": "timestamp", "mixed": "string", "none": "string", "padded": "tinyint",
    }
    typed = ops.infer_types(df)
    assert dict(typed.dtypes)["big"] == "bigint" and typed.count() == 2


@pytest.mark.parametrize(
    "strategy, fill", [("constant", Decimal(9)), ("mean", Decimal("3.5")), ("median", Decimal("3.5")), ("mode", Decimal(2))]
)
def test_impute(spark, rows, strategy, fill):
    values = [None, 2, 2, 5, 5, None]
    df = spark.createDataFrame([(i, v if v is None else Decimal(v)) for i, v in enumerate(values)], "i int, v decimal(10,2)")
    out = ops.impute(df, "v", strategy, value=9, indicator="was_null")
    assert [r.v for r in out.orderBy("i").collect()] == [fill, 2, 2, 5, 5, fill]
    assert [r.was_null for r in out.orderBy("i").collect()] == [True, False, False, False, False, True]


def test_impute_marker_odd_median_and_no_values(spark, rows):
    df = spark.createDataFrame([(-1.0,), (4.0,), (1.0,), (9.0,)], "v double")
    assert rows(ops.impute(df, "v", "median", missing=-1.0)) == [(1.0,), (4.0,), (4.0,), (9.0,)]
    empty = spark.createDataFrame([(None,)], "v double")
    for strategy in ("mean", "median", "mode"):
        assert rows(ops.impute(empty, "v", strategy)) == [(None,)]
    with pytest.raises(ValueError):
        ops.impute(df, "v", "guess")


def test_global_index_matches_plain_numbering(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("p"))
    out = global_index(df, ["k"], "n", start=10)
    assert out.filter("n != k + 10").count() == 0 and out.count() == 5000


def test_group_numbers_with_a_hot_key(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 1).otherwise(F.col("id")).alias("k"), "id")
    out = group_row_number(df, ["k"], ["id"], "n")
    wrong = out.withColumn("want", F.expr("row_number() over (partition by k order by id)")).filter("n != want")
    assert wrong.count() == 0 and out.count() == 6000


def test_empty_frames(spark):
    df = spark.createDataFrame([], "k int, v int")
    assert global_index(df, ["k"], "n").count() == 0
    assert ops.unique_by(df, ["k"], ["v"])[1].count() == 0
    assert ops.infer_types_profile(df).count() == 2
