"""Row-to-row operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyloom.functions import formulas as fx
from tallyloom.operators.joins import append_fields
from tallyloom.operators.ordering import global_index, group_row_number, join_null_safe, running_sum


def days_since_last(
    df: DataFrame, key: str, date: str, tie: str, name: str = "Days Since Last Purchase", joined: bool = False
) -> DataFrame:
    """Days since the same key's previous row by (date, tie); NULL on its first row.

    Only the first row of a day looks back to an earlier day, later ones are 0 days after it. So the
    window runs over distinct (key, day) pairs, whose number per key the calendar bounds, and rows
    meet their pair by key *and* day: a key with a third of all rows still spreads over its days, and
    a hot day of one key is a skewed join partition, which adaptive execution splits. A numeric
    ``tie`` is cheaper than text, whose minimum needs a sort.

    The days and the rows both come from ``df``. ``joined=True`` is for a frame made by joins of
    shuffled tables: the days then ask for every column, so both uses have the same exchanges below
    them, Spark reuses them, and each table is scanned and shuffled once. For a stored table the
    default is better: it reads the three columns again.
    """
    firsts = [F.min(tie).alias("__first")]
    if joined:
        firsts.append(F.max(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).alias("__whole"))
    days = df.groupBy(key, date).agg(*firsts)
    previous = F.lag(date).over(W.partitionBy(key).orderBy(date))
    if joined:
        # Never null here; the condition only keeps the optimizer from dropping the columns.
        previous = F.when(F.col("__whole").isNotNull(), previous)
    days = days.withColumn("__previous", previous).drop("__whole")
    day = F.col(f"`{date}`")
    since = F.when(F.col(f"`{tie}`") == F.col("__first"), F.datediff(day, F.col("__previous")))
    since = since.when(day.isNotNull(), F.lit(0))
    out = join_null_safe(df, days, [key, date], "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], since.alias(name))


def pct_change(df: DataFrame, col: str, order: str, name: str, label: bool = True) -> DataFrame:
    """Change against the previous row, as text such as ``12.5%`` or as a fraction.

    For aggregated frames (years, months): the window is unpartitioned. NULL on the first row and
    after a 0.
    """
    previous = F.lag(col).over(W.orderBy(order))
    if label:
        return df.withColumn(name, fx.percent_label(F.col(col) - previous, previous))
    previous = previous.cast("double")
    return df.withColumn(name, F.try_divide(F.col(col).cast("double") - previous, previous))


def running_total(
    df: DataFrame,
    col: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str | None = None,
    aggregated: bool = False,
) -> DataFrame:
    """Running total in a total order, per group if given; NULL counts as 0.

    Groups may be of any size. ``aggregated=True`` is the plain window for frames already reduced to
    a few rows per group (months, years).
    """
    name = name or f"RunTot_{col}"
    if not aggregated:
        return running_sum(df, F.col(f"`{col}`"), order, name, by)
    upto = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(name, F.sum(F.coalesce(F.col(f"`{col}`"), F.lit(0))).over(upto))


def first_n(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows per key; ``order`` must be total.

    Up to Spark's group-limit threshold each task keeps at most ``n`` rows of a key before the
    shuffle. Beyond it the rows are numbered without one window per key.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= threshold:
        numbered = df.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    else:
        numbered = group_row_number(df, keys, order, "__rn")
    return numbered.filter(F.col("__rn") <= n).drop("__rn")


def record_id(df: DataFrame, order: Sequence[str], start: int = 1, name: str = "RecordID") -> DataFrame:
    """Sequential number in the given order, first column of the result. Runs a job."""
    numbered = global_index(df, order, name, start)
    return numbered.select(name, *df.columns)


def select_ranges(df: DataFrame, ranges: Sequence[tuple], order: Sequence[str]) -> DataFrame:
    """Rows whose number in the given order lies in a range: ``(1, 10)``, ``(30, None)`` or ``(30,)`` for 30+.

    No ranges: all rows. Runs a job.
    """
    if not ranges:
        return df
    spans = [(r[0], r[1] if len(r) > 1 else None) for r in ranges]
    number = F.col("__row")
    wanted: Column = F.lit(False)
    for low, high in spans:
        wanted = wanted | ((number >= low) if high is None else number.between(low, high))
    return global_index(df, order, "__row").filter(wanted).drop("__row")


def surrogate_key(df: DataFrame, order: Sequence[str], name: str, small: bool = False) -> DataFrame:
    """1, 2, 3 … in the given order, for a dimension of any size (runs a job).

    ``small=True`` is the plain unpartitioned window, for a handful of codes.
    """
    if small:
        return df.withColumn(name, F.row_number().over(W.orderBy(*order)))
    return global_index(df, order, name)


def share_of_total(df: DataFrame, col: str, name: str = "Share", total: str | None = None) -> DataFrame:
    """Each row's part of the column's sum; ``total`` names a column to keep the sum in."""
    keep = total or "__total"
    whole = append_fields(df, df.agg(F.sum(col).alias(keep)))
    share = F.try_divide(F.col(col).cast("double"), F.col(keep).cast("double"))
    out = whole.withColumn(name, share)
    return out if total else out.drop(keep)


def zip_by_position(tables: Sequence[tuple[DataFrame, Sequence[str]]], name: str = "Position") -> DataFrame:
    """Rows of several tables side by side by their number in each table's own order.

    A shorter table is padded with NULL. Every position is one key, so nothing is skewed. Runs one
    job per table.
    """
    numbered = [global_index(df, order, name) for df, order in tables]
    out = numbered[0]
    for other in numbered[1:]:
        out = out.join(other, name, "outer")
    return out
