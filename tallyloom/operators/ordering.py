"""Row order over a whole table without one big window.

``row_number()`` or a running ``sum`` over an unpartitioned (or hot) window pulls its rows into a
single task. Here the rows are range-partitioned by a total order, sorted inside each partition,
and numbered there; what earlier partitions contribute is a table of one row per partition.

The order must be total (end it with a unique column). The ranged rows are checkpointed, so both
passes see the same partitions, also after a lost executor; building one of these frames
therefore runs a job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyloom.session import checkpointed

PART, POS = "__part", "__pos"


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join that also matches NULL with NULL; the right side's keys are dropped."""
    aside = {k: f"__key{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(aside)
    same = [F.col(f"`{k}`").eqNullSafe(F.col(r)) for k, r in aside.items()]
    return left.join(right, reduce(lambda a, b: a & b, same), how).drop(*aside.values())


def _ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    keys = [F.col(f"`{c}`") for c in order]
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return checkpointed(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(PART, F.spark_partition_id())
        .withColumn(POS, position)
    )


def global_index(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers from ``start`` in the given order."""
    rows = _ranged(df, order)
    sizes = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(W.orderBy(PART)) - F.col("__n")  # one row per partition
    offsets = sizes.select(F.col(PART).alias("__p"), before.alias("__before"))
    indexed = rows.join(F.broadcast(offsets), F.col(PART) == F.col("__p"))
    return indexed.select(*df.columns, (F.col(POS) + F.col("__before") + F.lit(start)).alias(name))


def running_sum(
    df: DataFrame, value: Column, order: Sequence[str], name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Running sum in the given order, restarting per ``by`` group, for groups of any size."""
    by = list(by)
    rows = _ranged(df.withColumn("__v", F.coalesce(value, F.lit(0))), [*by, *order])
    inside = W.partitionBy(PART, *by).orderBy(POS).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = rows.withColumn("__local", F.sum("__v").over(inside))
    # Per group: its partitions only. A carry exists where a group goes on from an earlier
    # partition; only the first group of a partition can, so there is at most one per partition.
    pieces = rows.groupBy(PART, *by).agg(F.sum("__v").alias("__piece"))
    earlier = W.partitionBy(*by).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    carry = pieces.withColumn("__carry", F.sum("__piece").over(earlier)).filter("__carry is not null")
    carry = carry.drop("__piece")
    joined = join_null_safe(local, F.broadcast(carry), [PART, *by], "left")
    total = F.col("__local") + F.coalesce(F.col("__carry"), F.lit(0))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], total.alias(name))


def group_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``row_number`` per key that stays spread out when one key holds most rows."""
    return running_sum(df, F.lit(1).cast("bigint"), order, name, by=keys)
