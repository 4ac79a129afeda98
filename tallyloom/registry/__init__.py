"""The registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, ShortType

from tallyloom.session import input_bytes, size_shuffles, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def published(df: DataFrame) -> DataFrame:
    """Final types: decimals as double, small integers as bigint."""
    wider = {DecimalType: "double", ByteType: "bigint", ShortType: "bigint", IntegerType: "bigint"}
    casts = {
        f.name: F.col(f"`{f.name}`").cast(wider[type(f.dataType)])
        for f in df.schema.fields
        if type(f.dataType) in wider
    }
    return df.withColumns(casts) if casts else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked (and a fixture test covers it)."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: published(fn(size_shuffles(tune(spark), input_bytes(spark, sf_dir)), sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def load_all() -> None:
    from tallyloom.registry import files, geo, joins, reports, retail, rows, sales  # noqa: F401
