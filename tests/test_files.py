import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import sinks
from tallyloom.plans import reports
from tallyloom.registry.files import TREND, TREND_TITLE
from tallyloom.session import CLEAN_SHUFFLES, shared_dir, size_shuffles
from tallyloom.sources import files


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_csv_with_and_without_schema(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", "k,v\r\n1,x\r\n2,\r\n")
    assert rows(files.read_csv(spark, path, "k int, v string")) == [(1, "x"), (2, None)]
    assert files.read_csv(spark, path).dtypes[0] == ("k", "int")


def test_csv_columns_go_by_name(spark, tmp_path, rows):
    path = write(tmp_path / "n.csv", "id,name,amount\n1,x,2.5\n")
    assert rows(files.read_csv(spark, path, "id int, amount double, name string")) == [(1, 2.5, "x")]
    assert rows(files.read_csv(spark, path, "key int, name string", rename={"id": "key"})) == [(1, "x")]
    with pytest.raises(ValueError, match="amounts"):
        files.read_csv(spark, path, "id int, amounts double")


@pytest.mark.parametrize("line", ["2", "2,x,9,9", "two,x,1.5", "2,x,much"])
def test_csv_malformed_lines_stop_the_query(spark, tmp_path, line):
    path = write(tmp_path / "bad.csv", f"id,name,amount\n1,x,2.5\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_csv(spark, path, "id int, name string, amount double").collect()


def test_csv_files_with_different_headers_stop_the_query(spark, tmp_path):
    write(tmp_path / "h" / "a.csv", "id,name\n1,x\n")
    write(tmp_path / "h" / "b.csv", "name,id\nx,1\n")
    with pytest.raises(Exception):
        files.read_many(spark, str(tmp_path / "h" / "*.csv"), "id int, name string").collect()


def test_preamble(spark, tmp_path, rows):
    write(tmp_path / "t" / "2018.csv", "Category: All categories\r\n\r\nWeek,interest\r\n2018-01-07,54\r\n2018-01-14,68\r\n")
    write(tmp_path / "t" / "2019.csv", "Week,interest\n2019-01-06,7\n")
    out, rejects = files.read_csv_preamble(spark, str(tmp_path / "t" / "*.csv"), TREND, TREND_TITLE, file_column="f")
    assert rows(out) == [
        (dt.date(2018, 1, 7), 54, "2018.csv"), (dt.date(2018, 1, 14), 68, "2018.csv"), (dt.date(2019, 1, 6), 7, "2019.csv"),
    ]
    assert rows(rejects) == []


def test_preamble_hands_back_what_it_cannot_read(spark, tmp_path, rows):
    lines = ["2020-13-05,1", "05/01/2020,2", "2020-01-12", "2020-01-19,3,4", "Some title", "2020-01-26,many", "2020-02-02,", "2020-02-09,5"]
    path = write(tmp_path / "r.csv", "Category: x\nWeek,interest\n" + "\n".join(lines) + "\n")
    out, rejects = files.read_csv_preamble(spark, path, TREND, TREND_TITLE)
    assert rows(out) == [(dt.date(2020, 2, 2), None), (dt.date(2020, 2, 9), 5)]
    assert [r[0] for r in rows(rejects)] == sorted(lines[:6])


def test_many_files(spark, tmp_path, rows):
    a = write(tmp_path / "m" / "a.csv", "k,v\n1,x\n")
    b = write(tmp_path / "m" / "b.csv", "w,k\n2.5,2\n")
    out = files.read_many(spark, {a: "k int, v string", b: "w double, k int"})
    assert rows(out, "k", "v", "w", "FileName") == [(1, "x", None, "a.csv"), (2, None, 2.5, "b.csv")]
    assert files.read_many(spark, [a, a], "k int, v string", file_column=None).count() == 2
    assert files.read_many(spark, str(tmp_path / "m" / "a*.csv"), "k int, v string").count() == 1


def test_listing(spark, tmp_path, rows):
    write(tmp_path / "l" / "a.csv", "12345")
    write(tmp_path / "l" / "b.txt", "1")
    assert rows(files.list_files(spark, str(tmp_path / "l"), "*.csv"), "FileName", "Size") == [("a.csv", 5)]


def test_ingest_skips_absent(spark, tmp_path):
    path = write(tmp_path / "i.csv", "k\n1\n")
    assert list(files.ingest_bronze(spark, {"here": path, "gone": str(tmp_path / "no.csv")})) == ["here"]


def test_write_formats(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    for fmt in ("csv", "parquet"):
        sinks.write_output(df, str(tmp_path / fmt), fmt)
    assert rows(files.read_csv(spark, str(tmp_path / "csv"), "k int, v string")) == [(1, "a")]
    sinks.write_output(df, str(tmp_path / "parquet"), "parquet", "append")
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2
    with pytest.raises(ValueError):
        sinks.write_output(df, str(tmp_path / "x"), "xlsx")
    with pytest.raises(RuntimeError, match="package"):
        sinks.write_output(df, str(tmp_path / "d"), "delta")


def test_table_is_replaced_with_its_schema(spark, rows):
    sinks.save_table(spark.createDataFrame([(1,)], "a int"), "replaced_table")
    out = sinks.save_table(spark.createDataFrame([("x", 2)], "b string, c int"), "replaced_table")
    assert out.columns == ["b", "c"] and rows(files.read_table(spark, "replaced_table")) == [("x", 2)]
    spark.sql("drop table replaced_table")


def test_sanitize(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "a: (b)"])
    assert sinks.sanitize_columns(df).columns == ["a_b", "a___b_"]
    assert sinks.sanitize_columns(df, " ").columns == ["a_b", "a:_(b)"]
    with pytest.raises(ValueError):
        sinks.sanitize_columns(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


def test_reports_share_one_copy(spark):
    out = sinks.run_reports(spark.range(10), {"all": lambda df: df, "n": lambda df: df.groupBy().count()})
    assert out["all"].count() == 10 and out["n"].first()[0] == 10
    assert all(shared_dir(spark).removeprefix("file:") in f for f in out["all"].inputFiles())


def test_reports_and_their_sizes_keep_no_shuffles(spark):
    def kept():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle_")}

    before, setting = kept(), spark.conf.get(CLEAN_SHUFFLES, None)
    out = sinks.run_reports(spark.range(1000).repartition(3, "id"), {"all": lambda df: df, "n": lambda df: df.groupBy("id").count()})
    assert sorted(map(tuple, reports.table_sizes(out).collect())) == [("all", 1000, 1), ("n", 1000, 2)]
    assert not kept() - before and spark.conf.get(CLEAN_SHUFFLES, None) == setting
    assert all(f.endswith(".zstd.parquet") for f in out["all"].inputFiles())


def test_shuffles_follow_the_input_size(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        size_shuffles(spark, 100 * 2**40)
        assert spark.conf.get(key) == str(100 * 2**40 // (256 * 2**20))
        size_shuffles(spark, 1)
        assert spark.conf.get(key) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        spark.conf.unset(key)


def test_merged_shuffle_partitions_stay_small(spark):
    """A task's memory must not grow with the input: partitions merge up to a fixed size, and there are enough of them."""
    parts, merged = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(merged, None)
    try:
        spark.conf.unset(merged)
        size_shuffles(spark, 6 * 2**30)
        assert (spark.conf.get(parts), spark.conf.get(merged)) == (str(6 * 2**30 // (8 * 2**20)), str(16 * 2**20))
        spark.conf.set(merged, "16k")
        size_shuffles(spark, 1)
        assert spark.conf.get(merged) == "16k"
    finally:
        spark.conf.unset(parts)
        spark.conf.unset(merged)
        if before is not None:
            spark.conf.set(merged, before)


def test_files_are_united_by_the_headers_they_have(spark, tmp_path, rows):
    for k in range(60):
        head, line = [("id,name", f"{k},007"), ("name,amount,id", f"x{k},1.5,{k}"), ('"id","when, utc",name', f'{k},2024-01-0{1 + k % 9},')][k % 3]
        write(tmp_path / "u" / f"f{k:03}.csv", f"{head}\n{line}\n")
    write(tmp_path / "u" / "empty.csv", "")
    out = files.read_by_header(spark, str(tmp_path / "u" / "*.csv"))
    assert dict(out.dtypes) == {"id": "int", "name": "string", "amount": "double", "when, utc": "date", "FileName": "string"}
    found = {r["id"]: r for r in out.collect()}
    assert len(found) == 60 and found[0]["name"] == "007" and found[0]["amount"] is None
    assert found[1].asDict() == {"id": 1, "name": "x1", "amount": 1.5, "when, utc": None, "FileName": "f001.csv"}
    assert found[2]["when, utc"] == dt.date(2024, 1, 3) and found[2]["name"] is None
    # One scan per header, not per file.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3


def test_types_are_widened_over_the_headers(spark, tmp_path, rows):
    write(tmp_path / "w" / "a.csv", "k,v,t\n1,5,007\n")
    write(tmp_path / "w" / "b.csv", "v,k,t,e\n2.5,30000000000,abc,\n")
    out = files.read_by_header(spark, str(tmp_path / "w" / "*.csv"), file_column=None)
    assert dict(out.dtypes) == {"k": "bigint", "v": "double", "t": "string", "e": "string"}
    assert rows(out, "k", "v", "t", "e") == [(1, 5.0, "007", None), (30000000000, 2.5, "abc", None)]


def test_headers_that_cannot_be_united(spark, tmp_path):
    write(tmp_path / "x" / "a.csv", "k,K\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        files.read_by_header(spark, str(tmp_path / "x" / "*.csv"))
    write(tmp_path / "y" / "a.csv", "")
    with pytest.raises(ValueError, match="no header"):
        files.read_by_header(spark, str(tmp_path / "y" / "*.csv"))


@pytest.mark.parametrize("block", ["64", "1000", "100000"])
def test_lines_are_skipped_by_count_in_every_file(spark, tmp_path, rows, block):
    """The skipped lines look like data; files are read in many blocks, and several in one task."""
    want = []
    for f in range(4):
        data = [f"2024-01-{1 + k % 28:02},{1000 * f + k}" for k in range(50 * f)]
        want += [(f"f{f}.csv", 1000 * f + k) for k in range(50 * f)]
        write(tmp_path / "s" / f"f{f}.csv", "\n".join(["2020-01-01,1", "2020-01-01,2", "", *data]) + "\n")
    write(tmp_path / "s" / "short.csv", "2020-01-01,1\n2020-01-01,2\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, block)
        out, rejects = files.read_csv_after(spark, str(tmp_path / "s" / "*.csv"), TREND, 3, file_column="f")
        assert rows(out, "f", "interest") == sorted(want) and rejects.count() == 0
    finally:
        spark.conf.set(key, before)


def test_a_failing_write_leaves_the_old_table(spark, rows):
    name = "kept_table"
    sinks.save_table(spark.range(5).withColumn("v", F.col("id") * 2), name)
    broken = spark.range(9).withColumn("v", F.when(F.col("id") == 8, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        sinks.save_table(broken, name)
    assert rows(files.read_table(spark, name)) == [(k, 2 * k) for k in range(5)]
    spark.sql(f"drop table {name}")


def test_a_table_is_rebuilt_from_itself(spark, rows):
    name = "own_table"
    sinks.save_table(spark.range(4), name)
    planned = files.read_table(spark, name).filter("id > 0")
    for k in (1, 2):
        out = sinks.save_table(files.read_table(spark, name).withColumn("id", F.col("id") + 1), name)
        assert rows(out) == [(i + k,) for i in range(4)]
    # What was planned before still reads the old files, until they are dropped.
    assert rows(planned) == [(1,), (2,), (3,)]
    assert sinks.drop_versions(spark, name, older_than=3600) == 0
    assert sinks.drop_versions(spark, name, older_than=-5) == 2
    assert rows(files.read_table(spark, name)) == [(i + 2,) for i in range(4)]
    spark.sql(f"drop table {name}")


def test_split_tables_come_from_one_pass(spark, rows):
    names = ["split_yes", "split_no", "split_rest"]
    place = spark.conf.get("spark.sql.warehouse.dir") + "/split"
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    def split(n, data):
        df = spark.createDataFrame(data, "id int, x string")
        watched = df.mapInPandas(passed, df.schema).toDF("id", "f.x")
        cond = F.col("`f.x`")
        return sinks.save_split(
            watched,
            {names[0]: (cond == "y", ["id", F.col("id").cast("long").alias("wide")]), names[1]: (cond == "n", ["id"]), names[2]: (None, ["f.x", "id"])},
            place,
        )

    data = [(1, "y"), (2, "n"), (3, None), (4, "y"), (None, "?")]
    out = split(1, data)
    assert seen.value == 5
    assert rows(out[names[0]]) == [(1, 1), (4, 4)] and rows(out[names[1]]) == [(2,)]
    assert rows(spark.table(names[2])) == [(None, 3), ("?", None)] and out[names[2]].columns == ["f.x", "id"]
    assert "__branch" not in out[names[0]].columns
    # A later version without rows for a table; the old version goes, the tables stay.
    out = split(2, [(7, "n")])
    assert [out[n].count() for n in names] == [0, 1, 0]
    assert sinks.drop_versions(spark, names, place, older_than=-5) == 1
    assert [spark.table(n).count() for n in names] == [0, 1, 0]
    df = spark.range(3)
    with pytest.raises(ValueError, match="two types"):
        sinks.save_split(df, {"a": (F.lit(True), ["id"]), "b": (None, [F.lit("x").alias("id")])}, place)
    with pytest.raises(ValueError, match="only the last"):
        sinks.save_split(df, {"a": (None, ["id"]), "b": (None, ["id"])}, place)
    for n in names:
        spark.sql(f"drop table {n}")
