"""Joins and lookups.

Whether a side is broadcast is decided from its size: by Spark's threshold and run-time statistics, or by a count
(``measured``). A side beyond it is shuffled. A hot key on the row-preserving or inner
side is split by adaptive execution; a hot key on the *other* side of an outer join cannot be, so
such joins can salt their hot keys (``join_hot``, ``split_hot=True``).
"""

from __future__ import annotations

import string
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import StringType

from tallyloom.operators.quality import require_unique
from tallyloom.session import checkpointed

JOIN_TYPES = ("inner", "left", "right", "outer", "left_semi", "left_anti")


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def join_dfs(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", split_hot: bool = False
) -> DataFrame:
    """Equi-join on equally named columns; ``split_hot``: an outer join by ``join_hot``."""
    how = {"full": "outer", "semi": "left_semi", "anti": "left_anti"}.get(how, how)
    if how not in JOIN_TYPES:
        raise ValueError(f"unknown join type {how!r}; choose one of {', '.join(JOIN_TYPES)}")
    on = _keys(on)
    if not split_hot or how not in ("left", "right", "outer"):
        return left.join(right, on, how)
    return join_hot(left, right, on, how)


def join_hot(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str, hot_rows: int = 1_000_000, salts: int = 64
) -> DataFrame:
    """Outer join (``left``, ``right``, ``outer``) that spreads the hot keys of the padded side, each side scanned once.

    Adaptive execution splits a hot key only on the side whose rows are all kept. Here keys with ``hot_rows`` rows or
    more on a padded side are counted first (a job over the key columns, whose result is at most one key per
    ``hot_rows`` rows). Their rows there get one of ``salts`` salts by a hash of the row, the other side's rows of
    these keys are repeated for every salt, all other rows meet as ever. A repeated row that finds nothing under its
    salt is no unmatched row, for a hot key has rows on the hot side: such rows are dropped. A key that is hot on both
    sides of a full join is split on the right. Rows with a null key match nothing and are spread by their hash.
    Equal rows of a hot key share a salt.
    """
    on = _keys(on)
    every = [F.col(f"`{c}`") for c in on]

    def hot(df: DataFrame, side: str) -> DataFrame:
        counts = df.select(*every).dropna().groupBy(*every).agg(F.count(F.lit(1)).alias("__n"))
        return counts.filter(F.col("__n") >= hot_rows).select(*every, F.lit(side).alias("__hot"))

    marks = [hot(df, side) for df, side, kinds in ((right, "right", ("left", "outer")), (left, "left", ("right", "outer"))) if how in kinds]
    marked = marks[0].unionByName(marks[1]) if len(marks) == 2 else marks[0]
    marked = checkpointed(marked.groupBy(*every).agg(F.max("__hot").alias("__hot")))
    found = marked.count()
    if not found:
        return left.join(right, on, how)
    marked = F.broadcast(marked) if found <= 100_000 else marked

    def salted(df: DataFrame, side: str) -> DataFrame:
        own = F.array(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int"))
        no_key = reduce(lambda a, b: a | b, [c.isNull() for c in every])
        # What the hash spreads must be the row, so it is taken before the marks come in.
        df = df.withColumn("__own", own).join(marked, on, "left")
        salt = F.when((F.col("__hot") == side) | no_key, F.col("__own"))
        salt = salt.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        df = df.withColumn("__salt", F.explode(salt)).withColumn(f"__{side}", F.lit(True))
        return df.drop("__own").withColumnRenamed("__hot", f"__hot_{side}")

    joined = salted(left, "left").join(salted(right, "right"), [*on, "__salt"], how)
    alone_left = F.col("__right").isNull() & F.col("__hot_left").eqNullSafe("right")
    alone_right = F.col("__left").isNull() & F.col("__hot_right").eqNullSafe("left")
    kept = joined.filter(~(alone_left | alone_right))
    return kept.drop("__salt", "__left", "__right", "__hot_left", "__hot_right")


def join_streams(
    left: DataFrame, right: DataFrame, on: str | Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched, left rows without a match, right rows without a match)."""
    on = _keys(on)
    known_left = left.select(*on).distinct()
    known_right = right.select(*on).distinct()
    return (
        left.join(right, on, "inner"),
        left.join(known_right, on, "left_anti"),
        right.join(known_left, on, "left_anti"),
    )


def measured(dim: DataFrame, rows: int = 200_000) -> DataFrame:
    """A small dimension that was built by joins, marked for broadcast once it is known to be small.

    The optimizer multiplies the sizes of joined inputs, so it takes a table of 25 rows for gigabytes and would shuffle
    the fact for it. One job reads at most ``rows`` rows and one more; a longer table is left as it is, to be
    shuffled or broadcast by its size.
    """
    return F.broadcast(dim) if dim.limit(rows + 1).count() <= rows else dim


def coded(dim: DataFrame, keys: Sequence[str], values: int = 256) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """A dimension with one number in place of its columns of few different texts, and what spells them out again.

    For a wide dimension whose columns pass through several shuffles with the fact. Two jobs over the dimension look for
    the columns: their distinct texts are estimated, and read where there are at most some ``values``; all other columns
    and the ``keys`` stay. The second result, for any table joined to the first, brings the columns back at the end; a row
    that found no match has none. The texts are written into the plan.
    """
    texts = [f.name for f in dim.schema if f.dataType == StringType() and f.name not in keys]
    if not texts:
        return dim, lambda df: df
    found = dim.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"n{k}") for k, c in enumerate(texts)]).first()
    texts = [c for c, n in zip(texts, found) if 0 < n <= values]
    if not texts:
        return dim, lambda df: df
    sets = dim.agg(*[F.sort_array(F.collect_set(F.col(f"`{c}`"))).alias(f"s{k}") for k, c in enumerate(texts)]).first()
    name = "__texts_" + "_".join(keys)
    number, size, spelt = F.lit(0).cast("bigint"), 1, {}
    for c, known in zip(texts, sets):
        if size * (len(known) + 1) >= 2**63:
            break
        # Place 0 is the null.
        lookup, text = F.array(*[F.lit(v) for v in known]), F.col(f"`{c}`")
        place = F.array_position(lookup, text)
        place = F.when(text.isNull(), 0).when(place > 0, place).otherwise(F.raise_error(F.lit(f"{c} has changed")))
        number = number + place * F.lit(size).cast("bigint")
        at = F.expr(f"`{name}` div {size}L") % F.lit(len(known) + 1)
        spelt[c] = F.get(lookup, (at - 1).cast("int"))
        size *= len(known) + 1
    narrow = dim.select(*[F.col(f"`{c}`") for c in dim.columns if c not in spelt], number.alias(name))
    return narrow, lambda df: df.withColumns(spelt).drop(name)


def left_keep(left: DataFrame, right: DataFrame, on: str | Sequence[str], split_hot: bool = False) -> DataFrame:
    """Matched and unmatched left rows together, that is a left outer join."""
    return join_dfs(left, right, on, "left", split_hot)


def join_on(
    left: DataFrame,
    right: DataFrame,
    keys: Mapping[str, str],
    how: str = "inner",
    right_cols: Sequence[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """Equi-join on differently named keys ``{left: right}``; the right keys go away unless listed."""
    wanted = list(right_cols) if right_cols is not None else [c for c in right.columns if c not in keys.values()]
    side = right.select(
        *[F.col(f"`{rk}`").alias(f"__k{i}") for i, rk in enumerate(keys.values())],
        *[F.col(f"`{c}`").alias(prefix + c) for c in wanted],
    )
    cond = reduce(lambda a, b: a & b, [F.col(f"`{lk}`") == F.col(f"__k{i}") for i, lk in enumerate(keys)])
    return left.join(side, cond, how).drop(*[f"__k{i}" for i in range(len(keys))])


def join_dim(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], cols: Sequence[str] | None = None, check: bool = False
) -> DataFrame:
    """Left join to a dimension; ``check`` first verifies that the join cannot multiply fact rows."""
    on = _keys(on)
    slim = dim.select(*on, *[c for c in cols if c not in on]) if cols is not None else dim
    if check:
        require_unique(slim, on, "dimension")
    return fact.join(slim, on, "left")


def lookup_replace(
    df: DataFrame, col: str, pairs: Mapping[str, str], mode: str = "exact", name: str | None = None
) -> DataFrame:
    """Replace text by a small, written-down lookup; what is not found stays.

    ``exact``: the trimmed value, in any case, equals a key. ``substring``: every occurrence of a key
    inside the text, in any case, found in a single left-to-right pass (a replacement is not searched
    again). For a lookup that is itself a table use ``lookup_replace_table`` or ``lookup_replace_inside``.
    """
    text = F.col(f"`{col}`")
    found = F.create_map(*[F.lit(x) for k, v in pairs.items() for x in (k.upper(), v)])
    if mode == "exact":
        out = F.coalesce(F.try_element_at(found, F.upper(F.trim(text))), text)
    elif mode == "substring":
        longest_first = sorted(pairs, key=len, reverse=True)
        quoted = "|".join("\\Q" + k + "\\E" for k in longest_first)
        # The text as the runs between matches, and the matches themselves.
        runs = F.split(text, f"(?is){quoted}")
        hits = F.transform(F.regexp_extract_all(text, F.lit(f"(?is)({quoted})"), F.lit(1)), lambda p: found[F.upper(p)])
        out = F.array_join(F.zip_with(runs, hits, lambda run, hit: F.concat(run, F.coalesce(hit, F.lit("")))), "")
    else:
        raise ValueError("mode must be 'exact' or 'substring'")
    return df.withColumn(name or col, out)


def lookup_replace_table(
    df: DataFrame, col: str, dim: DataFrame, key: str, value: str, name: str | None = None
) -> DataFrame:
    """Exact lookup in a table of any size, on the trimmed, upper-cased text; a miss keeps the text."""
    side = dim.select(F.upper(F.trim(F.col(key))).alias("__key"), F.col(value).alias("__value"))
    joined = df.join(side, F.upper(F.trim(F.col(f"`{col}`"))) == F.col("__key"), "left")
    out = F.coalesce(F.col("__value"), F.col(f"`{col}`"))
    return joined.withColumn(name or col, out).drop("__key", "__value")


def _folded(text: Column) -> Column:
    """A-Z in lower case: the length stays, so positions hold in the original too."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _text_of(chars: Column, start, length) -> Column:
    return F.array_join(F.slice(chars, start, length), "")


def lookup_replace_inside(
    df: DataFrame, col: str, dim: DataFrame, key: str, value: str, name: str | None = None, gram: int = 8
) -> DataFrame:
    """Replace every occurrence of a key inside the text, for a lookup table of any size; A-Z match in any case.

    Of the occurrences the leftmost goes first, of those at one place the longest; what was put in is not searched
    again. Null and empty keys are left out, a null value takes the occurrence away, of keys that differ in case only
    the smallest value counts. A null text stays null.

    The lookup table is read three times (it should be stored). Each key is filed under the rarest of its pieces of ``gram`` characters (a shorter key under itself), so a piece
    that most keys share leads to few of them. The pieces of every distinct text meet that index in an equality join,
    the keys found are compared in full, and a row gets its text back by a 128-bit hash: texts that many rows
    share are searched once, and a hot text is a skewed join partition on the side whose rows are kept, which
    adaptive execution splits. The lengths of the pieces (at most ``gram`` numbers) are read while the plan is built.
    """
    if gram < 1:
        raise ValueError("gram must be 1 or more")
    keys = dim.select(_folded(F.col(f"`{key}`").cast("string")).alias("__key"), F.col(f"`{value}`").cast("string").alias("__value"))
    keys = keys.filter("__key <> ''").groupBy("__key").agg(F.coalesce(F.min("__value"), F.lit("")).alias("__value"))
    size = F.least(F.length("__key"), F.lit(gram))
    sizes = sorted(r[0] for r in keys.select(size).distinct().collect())
    if not sizes:
        return df.withColumn(name or col, F.col(f"`{col}`").cast("string"))

    def pieces(chars: str, n: int) -> Column:
        """Every run of ``n`` characters with the place it starts at, from 1."""
        at = F.sequence(F.lit(1), F.size(chars) - F.lit(n - 1))
        every = F.transform(at, lambda i: F.struct(_text_of(F.col(chars), i, F.lit(n)).alias("__gram"), i.alias("__at")))
        return F.when(F.size(chars) >= n, every).otherwise(F.array().cast("array<struct<__gram:string,__at:int>>"))

    spelt = keys.withColumn("__chars", F.split("__key", ""))
    by_size = F.coalesce(*[F.when(size == n, pieces("__chars", n)) for n in sizes])
    filed = spelt.select("__key", "__value", F.inline(by_size))
    shared = filed.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    rarest = F.min(F.struct("__n", "__gram", "__at")).alias("__rare")
    index = filed.join(shared, "__gram").groupBy("__key", "__value").agg(rarest)
    index = index.select("__key", "__value", "__rare.__gram", F.col("__rare.__at").alias("__offset"))

    texts = df.select(F.col(f"`{col}`").cast("string").alias("__text")).filter("__text <> ''").distinct()
    texts = texts.select(F.md5("__text").alias("__id"), F.split("__text", "").alias("__own"), F.split(_folded(F.col("__text")), "").alias("__chars"))
    grams = texts.select("__id", F.inline(F.concat(*[pieces("__chars", n) for n in sizes])))
    start = (F.col("__at") - F.col("__offset") + 1).alias("start")
    found = grams.join(index, "__gram").select(
        "__id", F.struct(start, F.length("__key").alias("length"), F.col("__key").alias("key"), F.col("__value").alias("value")).alias("__hit")
    )
    found = found.filter("__hit.start >= 1").groupBy("__id").agg(F.collect_list("__hit").alias("__hits"))

    true = F.filter("__hits", lambda h: _text_of(F.col("__chars"), h["start"], h["length"]) == h["key"])
    true = found.join(texts, "__id").select("__id", F.inline(true))
    hit = F.struct("start", (F.col("start") + F.col("length")).alias("end"), "value").alias("hit")
    # Hits that overlap, directly or through others, are settled together: by place, the longer first, and a hit
    # counts if it starts behind the one before. Most stand alone, so these lists are short.
    ordered = W.partitionBy("__id").orderBy("start", F.desc("length"))
    reach = F.max("hit.end").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.when(F.col("start") < F.col("__reach"), 0).otherwise(1)
    runs = true.select("__id", "start", "length", hit).withColumn("__reach", reach)
    runs = runs.withColumn("__run", F.sum(fresh).over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow)))
    runs = runs.groupBy("__id", "__run").agg(F.collect_list(F.struct("start", (-F.col("length")).alias("short"), "hit")).alias("hits"))
    by_place = F.transform(F.array_sort("hits"), lambda h: h["hit"])

    def settle(taken, h):
        behind = (F.size(taken) == 0) | (h["start"] >= F.try_element_at(taken, F.lit(-1))["end"])
        return F.when(behind, F.concat(taken, F.array(h))).otherwise(taken)

    none = F.filter(by_place, lambda h: F.lit(False))
    runs = runs.select("__id", F.when(F.size("hits") == 1, by_place).otherwise(F.aggregate(by_place, none, settle)).alias("__picks"))
    picked = runs.groupBy("__id").agg(F.array_sort(F.flatten(F.collect_list("__picks"))).alias("__picks"))

    def before(p, i):
        last = F.when(i > 0, F.col("__picks")[F.greatest(i - 1, F.lit(0))]["end"]).otherwise(F.lit(1))
        return F.concat(_text_of(F.col("__own"), last, p["start"] - last), p["value"])

    end = F.element_at("__picks", -1)["end"]
    tail = _text_of(F.col("__own"), end, F.greatest(F.size("__own") - end + 1, F.lit(0)))
    put = F.concat(F.array_join(F.transform("__picks", before), ""), tail)
    changed = picked.join(texts, "__id").select("__id", put.alias("__put"))
    joined = df.withColumn("__id", F.md5(F.col(f"`{col}`").cast("string"))).join(changed, "__id", "left")
    out = F.coalesce(F.col("__put"), F.col(f"`{col}`").cast("string"))
    return joined.withColumn(name or col, out).drop("__id", "__put")


def append_fields(target: DataFrame, source: DataFrame, max_rows: int = 1) -> DataFrame:
    """Put the fields of a small table on every row; a table of several rows repeats the target's rows for each.

    The rows arrive as a scalar subquery: no join at all. The table has at most ``max_rows`` rows: more stop the
    query, and an empty one gives an empty result. At most ``max_rows + 1`` rows ever reach one task.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be 1 or more")
    fields = [F.col("__row")[f"f{k}"].alias(c) for k, c in enumerate(source.columns)]
    packed = F.struct(*[F.col(f"`{c}`").alias(f"f{k}") for k, c in enumerate(source.columns)]).alias("__row")
    own = [F.col(f"`{c}`") for c in target.columns]
    if max_rows == 1:
        return target.withColumn("__row", source.select(packed).scalar()).filter("__row IS NOT NULL").select(*own, *fields)
    rows = source.select(packed).limit(max_rows + 1).agg(F.collect_list("__row").alias("rows"))
    message = F.lit(f"more than {max_rows} rows to append")
    rows = rows.select(F.when(F.size("rows") > max_rows, F.raise_error(message)).otherwise(F.col("rows")))
    return target.select("*", F.explode(rows.scalar()).alias("__row")).select(*own, *fields)


def join_multiple(tables: Mapping[str, DataFrame], on: str) -> DataFrame:
    """Inner join of all tables on one key; other columns get their table's prefix."""

    def prefixed(prefix: str, df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({c: prefix + c for c in df.columns if c != on})

    return reduce(lambda a, b: a.join(b, on, "inner"), [prefixed(p, df) for p, df in tables.items()])


def union_by_name(*tables: DataFrame) -> DataFrame:
    """All rows, columns matched by name; a column that a table lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def customer_review_join(
    customers: DataFrame, reviews: DataFrame, states: Mapping[str, str], split_hot: bool = False
) -> DataFrame:
    """Every customer with each of their reviews (or none), state spelled out.

    ``split_hot`` is for reviews of which one customer has a very large share: that side of an outer
    join cannot be split, so it is then put together from an inner and an anti join.
    """
    joined = left_keep(customers, reviews, "customerid", split_hot)
    return lookup_replace(joined, "state", states)

