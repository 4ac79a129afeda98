import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.lookups import US_STATES
from tallyloom.operators import joins as ops


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "k int, r string")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
def test_split_join_equals_plain_join(sides, rows, how):
    left, right = sides
    plain = ops.join_dfs(left, right, "k", how)
    split = ops.join_dfs(left, right, "k", how, split_hot=True)
    assert plain.columns == split.columns
    assert rows(plain) == rows(split)


def test_unknown_join_type(sides):
    with pytest.raises(ValueError):
        ops.join_dfs(*sides, "k", "sideways")


def test_streams(sides, rows):
    matched, left_only, right_only = ops.join_streams(*sides, "k")
    assert matched.count() == 4
    assert rows(left_only, "l") == [("c",), ("d",)]
    assert rows(right_only, "r") == [("n",), ("z",)]


def test_left_keep_and_dim_check(spark, sides, rows):
    left, right = sides
    dim = right.dropDuplicates(["k"])
    assert ops.left_keep(left, dim, "k").count() == left.count()
    assert ops.join_dim(left, dim, "k", ["k"], check=True).count() == left.count()
    with pytest.raises(ValueError):
        ops.join_dim(left, right, "k", check=True)


def test_join_on(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    right = spark.createDataFrame([(1, "x", 5)], "rid int, v string, w int")
    out = ops.join_on(left, right, {"id": "rid"}, "left", ["v"], prefix="r_")
    assert out.columns == ["id", "v", "r_v"]
    assert rows(out) == [(1, "a", "x"), (2, "b", None)]


def test_lookup(spark, rows):
    data = [("ca",), (" CA ",), ("California",), ("ZZ",), (None,)]
    df = spark.createDataFrame(data, "s string")
    want = [(None,), ("California",), ("California",), ("California",), ("ZZ",)]
    assert rows(ops.lookup_replace(df, "s", US_STATES)) == want
    dim = spark.createDataFrame(list(US_STATES.items()), "code string, name string")
    assert rows(ops.lookup_replace_table(df, "s", dim, "code", "name")) == want


def test_lookup_substring_is_one_pass(spark, rows):
    df = spark.createDataFrame([("xCAx al",), (None,), ("",)], "s string")
    out = ops.lookup_replace(df, "s", {"CA": "California", "AL": "Alabama"}, mode="substring")
    assert rows(out) == [(None,), ("",), ("xCaliforniax Alabama",)]
    with pytest.raises(ValueError):
        ops.lookup_replace(df, "s", {}, mode="fuzzy")


def test_lookup_inside_by_a_table(spark):
    def by_hand(text, pairs, at=0):
        if text is None:
            return None
        folded, out = "".join(c.lower() if c.isascii() else c for c in text), ""
        while at < len(text):
            hits = [k for k in pairs if folded.startswith(k, at)]
            best = max(hits, key=len, default=None)
            out, at = (out + text[at], at + 1) if best is None else (out + pairs[best], at + len(best))
        return out

    pick = random.Random(5)
    word = lambda n: "".join(pick.choice("abß𝄞 A") for _ in range(n))
    pairs = {"common" + str(i): f"<{i}>" for i in range(60)} | {word(pick.randint(1, 9)).replace("A", "a"): f"[{i}]" for i in range(40)}
    pairs |= {"ab": "", "abab": "ba", "a.b": "dot", "$1": "\\1"}
    texts = [word(pick.randint(0, 60)) + pick.choice(["", "COMMON7", "xcommon59common5", "a.b$1"]) for _ in range(150)]
    texts += [None, "", "ß", "nothing here"] + ["hot ABABab"] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "id int, `t.x` string")
    dim = spark.createDataFrame([*pairs.items(), ("", "empty"), (None, "null"), ("AB", "zz")], "k string, v string")
    for gram in (1, 3, 4, 20):
        out = ops.lookup_replace_inside(df, "t.x", dim, "k", "v", "new", gram)
        got = {r["id"]: (r["t.x"], r["new"]) for r in out.collect()}
        assert got == {i: (t, by_hand(t, pairs)) for i, t in enumerate(texts)}
    same = ops.lookup_replace_inside(df, "t.x", dim.limit(0), "k", "v", "new")
    assert same.filter("not (new <=> `t.x`)").count() == 0 and same.count() == len(texts)
    assert ops.lookup_replace_inside(df.limit(0), "t.x", dim, "k", "v").columns == ["id", "t.x"]


def test_append_fields(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    one = spark.createDataFrame([(7, None)], "t int, u string")
    assert rows(ops.append_fields(df, one)) == [(1, 7, None), (2, 7, None)]
    assert ops.append_fields(df, one.limit(0)).count() == 0
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        ops.append_fields(df, one.union(one)).collect()


def test_append_fields_of_several_rows(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, `t.u` string")
    some = spark.createDataFrame([(7, None), (8, "p")], "t int, `a.b` string")
    out = ops.append_fields(df, some, max_rows=2)
    assert out.columns == ["a", "t.u", "t", "a.b"]
    assert rows(out) == [(1, "x", 7, None), (1, "x", 8, "p"), (2, None, 7, None), (2, None, 8, "p")]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert ops.append_fields(df, some.limit(0), max_rows=2).count() == 0
    assert ops.append_fields(df.limit(0), some, max_rows=2).count() == 0
    with pytest.raises(Exception, match="more than 2 rows to append"):
        ops.append_fields(df, some.union(some), max_rows=2).collect()
    with pytest.raises(ValueError):
        ops.append_fields(df, some, max_rows=0)


def test_join_multiple(spark, rows):
    a = spark.createDataFrame([(1, "p"), (2, "q")], "k int, v string")
    b = spark.createDataFrame([(1, "r"), (3, "s")], "k int, v string")
    out = ops.join_multiple({"a_": a, "b_": b}, "k")
    assert out.columns == ["k", "a_v", "b_v"] and rows(out) == [(1, "p", "r")]


def test_union(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2.5, 2)], "w double, k int")
    assert rows(ops.union_by_name(a, b)) == [(1, "x", None), (2, None, 2.5)]


def test_customer_review_join_with_hot_customer(spark):
    customers = spark.createDataFrame([(i, "CA") for i in range(30)], "customerid int, state string")
    reviews = spark.createDataFrame([(7, i) for i in range(500)] + [(8, 1), (99, 1)], "customerid int, stars int")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ops.customer_review_join(customers, reviews, US_STATES)
        assert out.count() == 500 + 1 + 28
        assert out.filter("state != 'California'").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_dimensions_do_not_move_the_fact(spark):
    """No exchange by the store key, although the store table is itself a join."""
    from tallyloom import registry

    registry.load_all()
    plan = registry.QUERIES["geo_enriched_transactions"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [cast(Location ID" in plan and "hashpartitioning(Location ID" not in plan and "hashpartitioning(cast(Location" not in plan


def test_measured(spark):
    small = spark.range(5)
    hinted = ops.measured(small, rows=5)._jdf.queryExecution().analyzed().toString()
    plain = ops.measured(small, rows=4)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted and "broadcast" not in plain


def test_coded_dimension_comes_back(spark):
    """Few texts become one number, with nulls, repeated keys and rows without a match; many texts stay."""
    rows = [(k, f"name {k}", f"colour {k % 3}" if k % 4 else None, "" if k % 2 else "même", None, k) for k in [*range(40), 7]]
    rows.append((None, "nobody", "blue", "", None, 0))
    dim = spark.createDataFrame(rows, "k long, name string, colour string, word string, none string, n long")
    narrow, spelt = ops.coded(dim, ["k"], values=20)
    assert [c for c in narrow.columns if c in dim.columns] == ["k", "name", "none", "n"] and len(narrow.columns) == 5
    fact = spark.createDataFrame([(k, j) for j, k in enumerate([1, 2, 2, 7, 39, 40, None])], "k long, j long")
    want = fact.join(dim, "k", "left")
    got = spelt(fact.join(narrow, "k", "left")).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.filter("colour IS NOT NULL").count() == 6
    plain, same = ops.coded(dim.select("k", "n"), ["k"])
    assert same(plain).columns == ["k", "n"]


@pytest.mark.parametrize("how", ["left", "right", "outer"])
def test_join_hot_equals_the_plain_join(spark, how):
    left = spark.range(3000).select(F.when(F.col("id") % 7 != 0, F.col("id") % 60).alias("k"), F.col("id").alias("a"))
    left = left.unionByName(spark.range(400).select(F.lit(200).cast("long").alias("k"), F.col("id").alias("a")))
    right = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, F.lit(100)).otherwise(F.col("id") % 80).alias("k"), F.col("id").alias("b"))
    right = right.unionByName(spark.createDataFrame([(None, k) for k in range(50)], "k long, b long"))
    want = left.join(right, "k", how)
    got = ops.join_hot(left, right, "k", how, hot_rows=100, salts=8)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_join_hot_spreads_a_padded_key(spark):
    """Two thirds of the padded side on one key and many null keys: no task gets over twice the median, each side is read once."""
    left = spark.range(4000).withColumnRenamed("id", "k")
    right = spark.range(90_000).select(F.when(F.col("id") % 3 < 2, F.lit(5)).when(F.col("id") % 6 == 2, F.col("id") % 4000).alias("k"), F.col("id").alias("b"))
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k, v in zip(keys, ("false", "-1")):
            spark.conf.set(k, v)
        out = ops.join_hot(left, right, "k", "outer", hot_rows=10_000, salts=512)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == left.join(right, "k", "outer").count() and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 2
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
