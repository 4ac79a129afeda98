"""Queries of the file sources and sinks. They write to, and read back from, the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyloom.operators import sinks
from tallyloom.registry import query
from tallyloom.registry.sql import sql
from tallyloom.session import fresh_path
from tallyloom.sources import files, model
from tallyloom.sources.schemas import TREND, TREND_TITLE  # noqa: F401

ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderdate::DATE AS orderdate, o_totalprice, o_orderpriority FROM orders"""


def _orders(spark, d):
    return model.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("orderdate"), "o_totalprice", "o_orderpriority"
    )


@query("scan_csv_roundtrip", ORDERS_SQL)
def scan_csv_roundtrip(spark, d):
    path = fresh_path(spark, "orders-csv")
    sinks.write_output(_orders(spark, d), path, "csv")
    return files.read_csv(
        spark, path, "o_orderkey bigint, o_custkey bigint, orderdate date, o_totalprice double, o_orderpriority string"
    )


@query("write_parquet_roundtrip", ORDERS_SQL)
def write_parquet_roundtrip(spark, d):
    path = fresh_path(spark, "orders-parquet")
    sinks.write_output(_orders(spark, d), path, "parquet")
    return spark.read.parquet(path)


@query("save_table_roundtrip", ORDERS_SQL)
def save_table_roundtrip(spark, d):
    name = f"orders_{uuid.uuid4().hex}"
    sinks.save_table(_orders(spark, d), name, path=fresh_path(spark, "orders-table"))
    return files.read_table(spark, name)


@query(
    "multi_file_union",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS folder FROM orders""",
)
def multi_file_union(spark, d):
    """Open and closed orders in files with different columns, united by the headers found in them, each with the folder it came from."""
    orders = model.table(spark, d, "orders")
    root = fresh_path(spark, "union")
    closed, opened = f"{root}/closed", f"{root}/open"
    sinks.write_output(orders.filter("o_orderstatus <> 'O'").select("o_orderkey", "o_custkey", "o_totalprice"), closed)
    sinks.write_output(orders.filter("o_orderstatus = 'O'").select("o_totalprice", "o_orderpriority", "o_orderkey"), opened)
    united = files.read_by_header(spark, f"{root}/*/*.csv", file_column="path", full_path=True)
    # Small keys are inferred as int.
    united = united.withColumns({k: F.col(k).cast("bigint") for k in ("o_orderkey", "o_custkey")})
    return united.withColumn("folder", F.regexp_extract("path", "/([^/]+)/[^/]+$", 1)).drop("path")


@query("file_inventory")
def file_inventory(spark, d):
    """The table files, by listing; file times and paths have no SQL counterpart."""
    return files.list_files(spark, d, "*.parquet").select("FileName", "Size", "LastWriteTime")


@query(
    "bronze_row_counts",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "TableName", count(*) AS "RowCount" FROM {t}""" for t in ("orders", "customer", "events", "part")
    ),
)
def bronze_row_counts(spark, d):
    """Ingest of the listed sources; the absent one is skipped."""
    names = ("orders", "customer", "events", "part", "not_delivered")
    manifest = {n: f"{d.rstrip('/')}/{n}.parquet" for n in names}
    counts = [
        df.agg(F.count(F.lit(1)).alias("RowCount")).select(F.lit(name).alias("TableName"), "RowCount")
        for name, df in files.ingest_bronze(spark, manifest, "parquet").items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


@query(
    "trend_weekly",
    sql(
        "",
        """SELECT date_trunc('week', o_orderdate)::DATE AS "Week", count(*) AS interest FROM orders GROUP BY 1""",
    ),
)
def trend_weekly(spark, d):
    """Weekly interest, exported as one CSV per year under two title lines and a header, read back as one table."""
    weeks = model.weekly_trend(spark, d).withColumn("yr", F.year("Week"))
    data = weeks.select(
        "yr", F.lit(3).alias("line"), F.concat_ws(",", F.col("Week").cast("string"), "interest").alias("value")
    )
    titles = F.array(F.lit("Category: All categories"), F.lit(""), F.lit("Week,interest"))
    head = weeks.select("yr").distinct().select("yr", F.posexplode(titles).alias("line", "value"))
    path = fresh_path(spark, "trend")
    lines = head.unionByName(data).repartition("yr").sortWithinPartitions("yr", "line", "value")
    lines.select("yr", "value").write.partitionBy("yr").text(path)
    trend, rejects = files.read_csv_after(spark, f"{path}/yr=*/*", TREND, 3)
    if not rejects.isEmpty():
        raise ValueError("lines of the trend files cannot be read")
    return trend
