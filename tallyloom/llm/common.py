"""Helpers the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.session import checkpointed, fresh_path, tune

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words of the shingle operators: runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


# What a Python worker gets at a time: small, so that two workers and the JVM fit a small executor.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings the corpus queries count on."""
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return tune(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII text takes the fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: later steps neither recompute it nor lose it with an executor."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows_per_task: int = 250_000) -> DataFrame:
    """A stored narrow table in as many partitions as its rows need: steps over a small one then need no shuffle."""
    return df.coalesce(max(1, -(-df.count() // rows_per_task)))


def row_key(ident: Column, text: Column) -> Column:
    """128 bits of id and text: tells rows apart whose ids repeat or are null. Null texts count as empty."""
    return F.md5(F.concat_ws(":", F.coalesce(ident.cast("string"), F.lit("null")), F.coalesce(text, F.lit(""))).cast("binary"))


def without(docs: DataFrame, dropped: DataFrame, keys: dict[str, Column], broadcast_rows: int = 2_000_000) -> DataFrame:
    """``docs`` without the rows whose ``keys`` (column of ``dropped``: expression over ``docs``) are in ``dropped``; null equals null.

    ``dropped`` is broadcast up to ``broadcast_rows``; beyond that both sides shuffle.
    """
    gone = checkpointed(dropped.select(*[F.col(k).alias(f"__gone_{k}") for k in keys]).distinct())
    if gone.count() <= broadcast_rows:
        gone = F.broadcast(gone)
    match = F.lit(True)
    for k, value in keys.items():
        match = match & value.eqNullSafe(F.col(f"__gone_{k}"))
    return docs.join(gone, match, "left_anti")
