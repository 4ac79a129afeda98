"""Grain checks and table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; empty when the keys identify a row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("Rows")).filter("Rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> DataFrame:
    """Raise when a key repeats. Runs one grouped job; use it where a join must keep the fact's grain."""
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"{what} is not unique on {list(keys)}")
    return df


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, NULLs, smallest and largest value as text. One pass."""
    types = dict(df.dtypes)
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        measures += [
            F.count(F.col(f"`{c}`")).alias(f"_n{i}"),
            F.min(F.col(f"`{c}`")).cast("string").alias(f"_lo{i}"),
            F.max(F.col(f"`{c}`")).cast("string").alias(f"_hi{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("ColumnName"),
            F.lit(types[c]).alias("DataType"),
            F.col("_rows").alias("RowCount"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("NullCount"),
            F.col(f"_lo{i}").alias("MinValue"),
            F.col(f"_hi{i}").alias("MaxValue"),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))
