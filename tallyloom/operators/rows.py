"""Filters, projections, casts and cleaning of rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyloom.functions import formulas as fx
from tallyloom.operators.ordering import join_null_safe, running_sum


def _condition(cond: str | Column) -> Column:
    return F.expr(cond) if isinstance(cond, str) else cond


def filter_rows(df: DataFrame, cond: str | Column) -> DataFrame:
    return df.filter(_condition(cond))


def split_rows(df: DataFrame, cond: str | Column) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy the condition, all others); a NULL outcome counts as not satisfied.

    The first filter stays the bare condition, so it reaches the file scan.
    """
    holds = _condition(cond)
    return df.filter(holds), df.filter(~F.coalesce(holds, F.lit(False)))


def select_cols(
    df: DataFrame, cols: Sequence, rename: Mapping[str, str] | None = None, keep_rest: bool = False
) -> DataFrame:
    """Choose, order and rename columns; ``keep_rest`` appends the columns not named."""
    rest = [c for c in df.columns if c not in cols] if keep_rest else []
    return df.select(*cols, *rest).withColumnsRenamed(dict(rename or {}))


def rename_cols(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def cast_cols(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast the named columns. Bad text raises, or becomes NULL with ``strict=False``."""

    def to(name: str, dtype: str) -> Column:
        c = F.col(f"`{name}`")
        return c.cast(dtype) if strict else c.try_cast(dtype)

    return df.withColumns({name: to(name, dtype) for name, dtype in types.items()})


def add_column(df: DataFrame, name: str, expr: str | Column) -> DataFrame:
    return df.withColumn(name, _condition(expr))


def multi_field(df: DataFrame, cols: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """One formula over several columns; names the table lacks are passed over."""
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in cols if c in df.columns})


def backfill_urls(
    df: DataFrame,
    key: str = "brandname",
    cols: Sequence[str] = ("website", "facebookpage", "twitter"),
    prefix: str = "http://www.google.com/search?q=",
    blank_is_null: bool = True,
) -> DataFrame:
    """Missing links become a search for the key."""
    search = F.concat(F.lit(prefix), F.col(key))
    missing = fx.is_blank if blank_is_null else (lambda c: c.isNull())
    return multi_field(df, cols, lambda c: F.when(missing(c), search).otherwise(c))


def cleanse_text(
    df: DataFrame, col: str, trim: bool = True, collapse: bool = True, case: str | None = None
) -> DataFrame:
    return multi_field(df, [col], lambda c: fx.cleanse(c, trim, collapse, case))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Whole-row distinct; on a subset the surviving row is arbitrary, so prefer ``unique_by``."""
    return df.dropDuplicates(list(subset)) if subset else df.distinct()


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(first row per key, all further rows); ``order`` must be total within a key.

    The first output filters ``row_number = 1``, which Spark also applies before the shuffle. The
    second is an anti join on key and order columns together, so the rows of a hot key spread out.
    """
    first = W.partitionBy(*keys).orderBy(*order)
    unique = df.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn")
    if len(order) == 1:  # a plain number aggregates by hash, a struct by sorting
        least = df.groupBy(*keys).agg(F.min(order[0]).alias(order[0]))
    else:
        least = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("__first"))
        least = least.select(*keys, *[F.col("__first")[c].alias(c) for c in order if c not in keys])
    return unique, join_null_safe(df, least, least.columns, "left_anti")


# --- type inference --------------------------------------------------------------------------

# Shapes that are worth a cast; the cast still decides. A failing cast costs an exception per row.
_WHOLE = r"^[+-]?[0-9]{1,19}$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]"
_INT_LIMITS = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31))


def infer_types_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(ColumnName, DataType): the narrowest type that every value of a text column fits.

    Tried in order: integers by width, double, date, timestamp, else string. One pass; integer widths
    come from the extremes, and a column without values stays a string.
    """
    cols = list(cols or df.columns)
    shaped, measures, rows = [], [], []
    for i, c in enumerate(cols):
        text, shape = F.col(f"_t{i}"), F.col(f"_s{i}")
        shaped.append(F.trim(F.col(f"`{c}`").cast("string")).alias(f"_t{i}"))
        whole = F.when(shape == "whole", text.try_cast("bigint"))
        measures += [
            F.count(text).alias(f"_all{i}"),
            F.count(whole).alias(f"_whole{i}"),
            F.min(whole).alias(f"_low{i}"),
            F.max(whole).alias(f"_high{i}"),
            F.count(
                F.when(shape == "whole", F.lit(0.0)).when(shape == "number", text.try_cast("double"))
            ).alias(f"_double{i}"),
            F.count(F.when(shape == "date", text.try_cast("date"))).alias(f"_date{i}"),
            F.count(F.when(shape == "timestamp", text.try_cast("timestamp"))).alias(f"_timestamp{i}"),
        ]
        rows.append(F.struct(F.lit(c).alias("ColumnName"), _narrowest(i).alias("DataType")))
    # The shape is a column of its own, so each value meets the patterns once.
    values = df.select(*shaped).withColumns({f"_s{i}": _shape(F.col(f"_t{i}")) for i in range(len(cols))})
    return values.agg(*measures).select(F.inline(F.array(*rows)))


def _shape(text: Column) -> Column:
    """Which pattern the text has. Its first and fifth characters leave at most two of them to try for most values."""
    dashed = F.substring(text, 5, 1) == "-"
    out = F.when(text.isNull() | ~F.substring(text, 1, 1).between("+", "9"), None)
    out = out.when(dashed & text.rlike(_DATE), "date").when(dashed & text.rlike(_TIMESTAMP), "timestamp")
    return out.when(~dashed & text.rlike(_WHOLE), "whole").when(text.rlike(_NUMBER), "number")


def _narrowest(i: int) -> Column:
    total, low, high = F.col(f"_all{i}"), F.col(f"_low{i}"), F.col(f"_high{i}")
    every_whole = F.col(f"_whole{i}") == total
    out = F.when(total == 0, "string")
    for dtype, limit in _INT_LIMITS:
        out = out.when(every_whole & (low >= -limit) & (high < limit), dtype)
    out = out.when(every_whole, "bigint")
    for dtype in ("double", "date", "timestamp"):
        out = out.when(F.col(f"_{dtype}{i}") == total, dtype)
    return out.otherwise("string")


def infer_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast text columns to their narrowest type. Runs the profile job (one row per column comes back)."""
    found = {r.ColumnName: r.DataType for r in infer_types_profile(df, cols).collect()}
    return cast_cols(df.withColumns({c: F.trim(F.col(f"`{c}`")) for c in found}), found)


# --- imputation ------------------------------------------------------------------------------

def impute(
    df: DataFrame,
    col: str,
    strategy: str = "constant",
    value=0,
    missing=None,
    indicator: str | None = None,
) -> DataFrame:
    """Replace NULL (or the marker value ``missing``) by a constant or by the column's statistic.

    Statistics leave missing rows out: ``mean``, ``median`` (exact), ``mode`` (ties: smallest value).
    They enter as a scalar subquery. ``median`` runs a job, see :mod:`tallyloom.operators.ordering`.
    """
    source = F.col(f"`{col}`")
    gap = source.isNull() if missing is None else source.eqNullSafe(F.lit(missing))
    known = df.filter(~gap).filter(source.isNotNull()).select(source.alias("v"))
    if strategy == "constant":
        fill = F.lit(value)
    elif strategy == "mean":
        fill = known.agg(F.avg("v").alias("v")).scalar()
    elif strategy == "median":
        fill = exact_median(known, "v").scalar()
    elif strategy == "mode":
        counts = known.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        fill = counts.orderBy(F.desc("n"), "v").limit(1).select("v").scalar()
    else:
        raise ValueError(f"unknown strategy {strategy!r}; choose constant, mean, median or mode")
    out = df.withColumn(indicator, gap) if indicator else df
    return out.withColumn(col, F.when(gap, fill).otherwise(source))


def exact_median(df: DataFrame, col: str) -> DataFrame:
    """One row with the exact median, from value counts and their running total over sorted values.

    The built-in exact percentile keeps all distinct values in one task; this does not.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_sum(counts, F.col("__n"), [col], "__upto")
    total = ranked.agg(F.sum("__n").alias("t")).scalar()
    low, high = F.floor((total + 1) / 2), F.ceil((total + 1) / 2)
    covers_low = (F.col("__upto") >= low) & (F.col("__upto") - F.col("__n") < low)
    covers_high = (F.col("__upto") >= high) & (F.col("__upto") - F.col("__n") < high)
    middle = ranked.filter(covers_low | covers_high)  # one row, or the two around the middle
    return middle.agg(F.avg(col).alias(col))
