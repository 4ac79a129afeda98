"""Grouped aggregation, mode, weighted mean, cross tab, transpose.

All of these aggregate before the shuffle, so a hot group arrives as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

AGGREGATES = {
    "sum": F.sum,
    "avg": F.avg,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "countDistinct": F.count_distinct,
}


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def summarize(df: DataFrame, keys: str | Sequence[str], aggs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Group (or, with no keys, fold) by ``{output: (column, function)}``."""
    measures = []
    for out, (source, fn) in aggs.items():
        if fn not in AGGREGATES:
            raise ValueError(f"unsupported aggregation {fn!r}; choose one of {', '.join(AGGREGATES)}")
        column = F.lit(1) if source == "*" else F.col(f"`{source}`")
        measures.append(AGGREGATES[fn](column).alias(out))
    return df.groupBy(*_names(keys)).agg(*measures)


def mode_by(df: DataFrame, keys: str | Sequence[str], col: str, name: str) -> DataFrame:
    """Most frequent non-NULL value per group, ties to the smallest; NULL for a group without values.

    Counts per (group, value) first, so no task holds a group's values.
    """
    keys = _names(keys)
    counts = df.groupBy(*keys, col).agg(F.count(col).alias("__n"))
    first = W.partitionBy(*keys).orderBy(F.desc("__n"), col)
    ranked = counts.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1")
    return ranked.select(*keys, F.col(col).alias(name))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def revenue_profit_by(df: DataFrame, key: str, revenue: str = "purchaseprice", profit: str = "Profit") -> DataFrame:
    """Revenue and profit per control value."""
    if profit not in df.columns:
        raise ValueError(f"missing column {profit!r}: join the costs or derive it first")
    return df.groupBy(key).agg(F.sum(revenue).alias("Revenue"), F.sum(profit).alias("Sum_Profit"))


def weighted_average(
    df: DataFrame, value: str, weight: str, keys: str | Sequence[str], name: str = "Weighted Average"
) -> DataFrame:
    """Sum of value x weight over sum of weight per group; NULL where the weights sum to 0 or NULL."""
    v, w = F.col(value).cast("double"), F.col(weight).cast("double")
    return df.groupBy(*_names(keys)).agg(F.try_divide(F.sum(v * w), F.sum(w)).alias(name))


def cross_tab(
    df: DataFrame,
    row: str | Sequence[str],
    header: str,
    data: str,
    values: Sequence,
    method: str = "count",
    prefix: str = "",
    counted: bool = False,
) -> DataFrame:
    """Rows by header values. ``count``, ``sum``, or ``percent`` (share of the row's count).

    ``counted``: the data column already holds counts, which are then added up.
    """
    row = _names(row)
    grouped = df.groupBy(*row).pivot(header, list(values))
    names = [f"{prefix}{v}" for v in values]
    if method == "sum":
        return grouped.agg(F.sum(data)).toDF(*row, *names)
    if method not in ("count", "percent"):
        raise ValueError("method must be 'count', 'sum' or 'percent'")
    table = grouped.agg(F.sum(data) if counted else F.count(data)).toDF(*row, *names).fillna(0, names)
    if method == "count":
        return table
    whole = sum((F.col(f"`{n}`") for n in names[1:]), F.col(f"`{names[0]}`"))
    return table.select(*row, *[F.try_divide(F.col(f"`{n}`") * 100.0, whole).alias(n) for n in names])


def transpose(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str = "Name", value: str = "Value"
) -> DataFrame:
    """Wide to long: one row per key and data column."""
    return df.unpivot(list(keys), list(cols), name, value)
