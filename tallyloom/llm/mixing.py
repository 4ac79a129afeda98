"""Mixing sources to target weights: budgets flow down a tree, each leaf takes a prefix of its seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.common import stored
from tallyloom.session import checkpointed

BUCKET_DIGITS = 3  # hex digits of the shuffle key: a leaf's epoch is summed in 4096 ranges
MISSING = "(none)"


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _share(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Adds ``quota``: the parent's ``budget`` by ``weight``, no child above its ``capacity``.

    Water filling in whole tokens. Children are visited by capacity per weight; one whose fair share of what is
    left covers its capacity is filled, the others divide the remainder by weight. What a full child leaves over
    so goes to its siblings; only when all of them are full does the parent itself stay short, which its own
    siblings then had taken over one level up, because a parent's capacity is the sum of its children's.
    """
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products go up to 38 digits
    by = Window.partitionBy(*parents)
    order = by.orderBy(F.col("capacity") / F.col("weight"), name)
    nodes = (
        nodes.withColumn("before", F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("ahead", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("left", F.col("budget") - F.col("before"))
        .withColumn("full", wide("capacity") * wide("ahead") <= wide("left") * wide("weight"))
        .withColumn("rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(by), F.lit(0)))
        .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(by))
    )
    part = F.call_function("div", wide("rest") * wide("weight"), wide("open"))
    return nodes.withColumn("quota", F.when(F.col("full"), F.col("capacity")).otherwise(part).cast("long")).drop(
        "before", "ahead", "left", "full", "rest", "open"
    )


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str | None, int]], budget: Column, max_epochs: int) -> DataFrame:
    """``leaves`` (levels, ``tokens``) with the ``quota`` of tokens each leaf gets.

    ``weights`` maps a level to the whole-number weights of its values; a value not listed weighs what the level
    gives for None, and without that 1 where the level lists none, else 0.
    """
    nodes = leaves.select(*levels, "tokens", (F.col("tokens") * max_epochs).alias("capacity"))
    for level in levels:
        listed = weights.get(level)
        weight = F.lit(1)
        if listed:
            cases = [F.when(F.col(level) == v, F.lit(w)) for v, w in listed.items() if v is not None]
            weight = F.coalesce(*cases, F.lit(listed.get(None, 0)))
        nodes = nodes.withColumn(f"w_{level}", weight.cast("long"))
    # What no weight reaches can take nothing and must not count as an ancestor's capacity.
    nodes = nodes.filter(" AND ".join(f"w_{level} > 0" for level in levels))
    above = None
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        child = nodes.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.max(f"w_{level}").alias("weight"))
        if above is None:
            child = child.withColumn("budget", budget).withColumn("root", F.lit(0))
        else:
            child = child.join(above.select(*path[:-1], F.col("quota").alias("budget")), path[:-1])
        above = _share(child, path[:-1] or ["root"], level)
    return leaves.join(above.select(*levels, "quota"), levels, "left").fillna(0, ["quota"])


def mix(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, dict[str | None, int]],
    share: tuple[int, int] = (1, 2),
    max_epochs: int = 4,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """How often each row goes into the mixture: id, the levels, ``tokens``, ``quota`` of its leaf, ``copies``.

    The total budget is ``share`` (numerator, denominator) of all words; a leaf is a path of ``levels``. A leaf's
    sequence is epoch after epoch of its documents, each epoch in the order of md5(seed:epoch:id); it takes the
    longest prefix that fits its quota, so whole epochs and the head of one more. The head is found from token
    sums over 4096 key ranges, and only the range where the quota ends is ordered row by row: a leaf with a third
    of all rows is never in one task. The table of leaves is broadcast up to ``broadcast_rows``.

    A null level value is the leaf "(none)", a null text has no tokens. Rows without tokens come along in a leaf
    that takes something and lie before its end. Equal rows tie and are cut off one by one. Rows with a null id
    are ordered as one id "null". Other columns are not read; an empty table gives no rows.
    """
    names = list(levels)
    keys = stored(
        docs.select(
            F.col(f"`{id_col}`").alias("__id"),
            *[F.coalesce(c.cast("string"), F.lit(MISSING)).alias(k) for k, c in levels.items()],
            count_words(F.col(f"`{text_col}`")).alias("tokens"),
        ),
        "mix-keys",
    )
    leaves = checkpointed(keys.groupBy(*names).agg(F.sum("tokens").alias("tokens")))
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]  # one number
    short = leaves.count() <= broadcast_rows
    if short:  # the tree fits one task: its windows and joins then need no shuffle
        leaves = leaves.coalesce(1)
    leaves = budgets(leaves, names, weights, F.lit(total * share[0] // share[1]).cast("long"), max_epochs)
    leaves = leaves.withColumn("epochs", F.when(F.col("tokens") > 0, F.call_function("div", F.col("quota"), F.col("tokens"))).otherwise(0).cast("long"))
    leaves = checkpointed(leaves.withColumn("head", F.col("quota") - F.col("epochs") * F.col("tokens")).withColumnRenamed("tokens", "leaf_tokens"))
    sized = F.broadcast(leaves) if short else leaves

    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("__id").cast("string"), F.lit("null"))))
    dealt = keys.join(sized, names).withColumn("key", order).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = dealt.groupBy(*names, "bucket").agg(F.sum("tokens").alias("sum"), F.max("head").alias("head"))
    upto = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = sums.withColumn("through", F.sum("sum").over(upto)).filter("through > head")
    ends = ends.groupBy(*names).agg(F.min(F.struct("bucket", (F.col("through") - F.col("sum")).alias("before"))).alias("end"))
    ends = checkpointed(ends.select(*names, F.col("end.bucket").alias("cut"), F.col("end.before").alias("before")))
    dealt = dealt.join(F.broadcast(ends) if short else ends, names, "left")

    out = [F.col("__id").alias(id_col), *names, "tokens", "quota"]
    whole = dealt.filter("cut IS NULL OR bucket <> cut")
    taken = (F.col("head") > 0) & (F.col("cut").isNull() | (F.col("bucket") < F.col("cut")))
    whole = whole.select(*out, (F.col("epochs") + taken.cast("long")).alias("copies"))
    inside = Window.partitionBy(*names, "bucket").orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    edge = dealt.filter("bucket = cut").withColumn("through", F.col("before") + F.sum("tokens").over(inside))
    fits = (F.col("head") > 0) & (F.col("through") <= F.col("head"))
    edge = edge.select(*out, (F.col("epochs") + fits.cast("long")).alias("copies"))
    return whole.unionByName(edge)
