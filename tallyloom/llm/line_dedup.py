"""Line dedup: normalised lines are hashed, documents counted per hash, and frequent lines cut out by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.common import lower_ascii, stored

EDGES = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashed(text: Column, least_length: int) -> Column:
    """Per line the 128-bit hash of its key, null for a key of fewer than ``least_length`` code points."""
    keys = F.transform(_lines(lower_ascii(text)), lambda s: F.btrim(s, F.lit(EDGES)))
    # As text: array_distinct compares structs and binaries pair by pair, but looks strings up in a hash table.
    return F.transform(keys, lambda s: F.when(F.char_length(s) >= least_length, F.md5(s.cast("binary"))))


def frequent_lines(docs: DataFrame, text_col: str, least_length: int, least_docs: int) -> DataFrame:
    """``key`` (hash) of the lines found in at least ``least_docs`` rows. A row counts once however often it repeats a line."""
    own = F.array_distinct(_hashed(F.col(f"`{text_col}`"), least_length))
    # explode_outer: a plain explode gets a filter on the array's size, which computes the array a second time.
    found = docs.select(F.explode_outer(own).alias("key")).filter("key IS NOT NULL")
    return found.groupBy(F.unhex("key").alias("key")).count().filter(F.col("count") >= least_docs).select("key")


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 1,
    least_docs: int = 10,
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``: lines that many documents share are gone everywhere.

    A line's key is the line without ASCII white space at both ends, A-Z lower-cased. Keys of ``least_length`` code
    points found in ``least_docs`` documents lose all their lines; the others stay as they are, joined by line feeds.
    Counting sends one hash per distinct line of a document and combines before the shuffle; then hashes and positions
    meet the frequent hashes, which are stored, so that adaptive execution can split the join at a line that a third
    of all documents hold. The text moves once, when the positions to drop come back to it. They are looked up in an
    array of flags, in constant time, so that a document of a million lines takes linear time.

    A null or empty text is one empty line; shorter keys than ``least_length`` never drop, so with 1 blank lines stay.
    Every row counts as a document of its own, also where ids repeat or are null or rows are equal; rows are told apart
    by a 128-bit hash of id and text, and equal rows lose the same lines. All columns pass through, one named like an
    added column with the suffix "_in"; an empty table gives no rows.
    """
    # Under neutral names no column of the input clashes, and unused ones are still pruned.
    names = {c: f"__{k}" for k, c in enumerate(docs.columns)}
    ident, text = names[id_col], F.col(names[text_col])
    rows = docs.toDF(*names.values())
    row = F.struct(F.xxhash64(F.lit(1), ident, text).alias("a"), F.xxhash64(F.lit(2), ident, text).alias("b"))
    frequent = stored(frequent_lines(rows, names[text_col], least_length, least_docs), "frequent-lines")
    # In two steps: what stands beside a generator is computed once per row that it makes.
    places = rows.select(row.alias("row"), _hashed(text, least_length).alias("keys"))
    places = places.select("row", F.posexplode_outer("keys").alias("at", "key")).filter("key IS NOT NULL")
    places = places.withColumn("key", F.unhex("key"))
    drops = places.join(frequent, "key").groupBy("row").agg(F.array_sort(F.collect_set("at")).alias("drops"))
    # Nothing but its own arguments inside a lambda: an outer expression would be computed once per element. The flags
    # are made before the join for the same reason: behind it they are a plain column.
    before = F.slice(F.concat(F.array(F.lit(-1)), "drops"), F.lit(1), F.size("drops"))
    flags = F.flatten(F.zip_with("drops", before, lambda at, last: F.concat(F.array_repeat(F.lit(False), at - last - 1), F.array(F.lit(True)))))
    drops = drops.select("row", F.size("drops").alias("n"), flags.alias("flags"))
    whole = rows.withColumn("row", row).join(drops, "row", "left")
    lines = _lines(text)
    kept = F.filter(lines, lambda s, k: ~F.coalesce(F.get(F.col("flags"), k), F.lit(False)))
    out = {
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce("n", F.lit(0)).cast("long"),
        "kept_text": F.when(F.col("n").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(kept, "\n")),
    }
    own = [F.col(n).alias(f"{c}_in" if c in out else c) for c, n in names.items()]
    return whole.select(*own, *[c.alias(n) for n, c in out.items()])
