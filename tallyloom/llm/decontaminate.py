"""Benchmark decontamination: containment MinHash over size-partitioned items, verified on full shingle sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.common import row_key, without
from tallyloom.session import checkpointed

SEPARATORS = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _shingles(words: Column, width: int) -> Column:
    """The distinct hashed runs of ``width`` words; empty when there are fewer."""
    at = F.sequence(F.lit(1), F.size(words) - (width - 1))
    runs = F.transform(at, lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(width)]))
    return F.when(F.size(words) >= width, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))


def item_sets(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """``item_id``, ``width`` of its shingles and the set; an item of fewer words is one shingle, one without words is left out."""
    words = items.select(F.col(f"`{item_col}`").alias("item_id"), _words(F.col(f"`{text_col}`")).alias("words"))
    own = F.least(F.lit(width), F.size("words"))
    cases = F.coalesce(*[F.when(own == w, _shingles(F.col("words"), w)) for w in range(1, width + 1)])
    return words.filter(F.size("words") > 0).select("item_id", own.alias("width"), cases.alias("shingles"))


def minima(sets: DataFrame, hashes: int) -> DataFrame:
    """The MinHash signature as shingles: for each hash function the member with the least hash.

    Items are partitioned by size, in powers of two; a partition of small sets needs no more hash functions than
    twice its size bound. ``least`` is the number of minima a document has to hold.
    """
    bound = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("shingles")))).cast("int")
    sized = sets.withColumn("slots", F.least(F.lit(hashes), 2 * bound))
    slot = F.transform(
        F.sequence(F.lit(1), F.col("slots")),
        lambda k: F.array_min(F.transform("shingles", lambda x: F.struct(F.xxhash64(x, k).alias("h"), x.alias("v"))))["v"],
    )
    return sized.select(
        "item_id", F.size("shingles").alias("size"), F.col("slots"), F.posexplode(slot).alias("slot", "shingle")
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    hashes: int = 32,
    broadcast_rows: int = 2_000_000,
) -> DataFrame:
    """Documents that hold at least ``percent`` of an item's shingles: id, ``item_id``, ``n_item``, ``n_shared``, ``containment``.

    Words are lower-cased runs of letters and digits. Jaccard similarity says little about a short item inside a
    long document, so the search is asymmetric: an item's MinHash minima are themselves shingles, each is in a
    document with the probability of the containment, and the share of minima found estimates it. Pairs where at
    least a quarter of the expected minima are found, and where the document is large enough to hold the item, are
    confirmed on the full sets. At the threshold itself a pair is missed with a probability below 1e-9.

    The minima are broadcast up to ``broadcast_rows`` of them, the ids of candidate documents likewise; beyond
    that both joins shuffle. An item of fewer words than a shingle counts as one shorter shingle; items and
    documents without words or with null text match nothing. Rows that repeat an id are tested one by one and
    reported once with their largest overlap; a null id is reported as null. Columns other than those named are
    not read. Empty tables give no rows.
    """
    sets = checkpointed(item_sets(items, item_col, item_text_col, width))
    widths = sorted(r[0] for r in sets.select("width").distinct().collect()) or [width]  # at most `width` values
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))

    def shingled(frame: DataFrame) -> DataFrame:
        words = frame.select("doc", _words(F.col("text")).alias("words"))
        every = [_shingles(F.col("words"), w) for w in widths]
        return words.select("doc", F.concat(*every).alias("shingles"))

    probes = minima(sets, hashes)
    probes = checkpointed(probes.withColumn("least", F.greatest(F.lit(1), F.floor(F.col("slots") * percent / 400))))
    if probes.count() <= broadcast_rows:
        probes = F.broadcast(probes)
    # explode_outer: a plain explode gets a filter on the array's size, which computes the words once per shingle.
    stream = shingled(texts).select("doc", F.size("shingles").alias("n_doc"), F.explode_outer("shingles").alias("shingle"))
    found = (
        stream.join(probes, "shingle")
        .filter(F.col("n_doc") * 100 >= F.col("size") * percent)
        .groupBy("doc", "item_id", "least")
        .agg(F.count_distinct("slot").alias("hits"))
        .filter("hits >= least")
    )
    pairs = checkpointed(found.select("doc", "item_id"))
    ids = pairs.select(F.col("doc").alias("hit")).distinct()
    if pairs.count() <= broadcast_rows:
        ids = F.broadcast(ids)
    suspects = shingled(texts.join(ids, F.col("doc").eqNullSafe(F.col("hit")), "left_semi"))
    right = pairs.select(F.col("doc").alias("hit"), "item_id")
    checked = (
        suspects.join(right, F.col("doc").eqNullSafe(F.col("hit")))
        .join(sets.withColumnsRenamed({"item_id": "item", "shingles": "wanted"}), F.col("item_id").eqNullSafe(F.col("item")))
        .select("doc", "item_id", F.size("wanted").cast("long").alias("n_item"), F.size(F.array_intersect("wanted", "shingles")).cast("long").alias("n_shared"))
        .filter(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    )
    best = checked.groupBy("doc", "item_id").agg(F.max(F.struct("n_shared", "n_item")).alias("best"))
    return best.select(
        F.col("doc").alias(id_col),
        F.col("item_id").alias(item_col),
        F.col("best.n_item").alias("n_item"),
        F.col("best.n_shared").alias("n_shared"),
        (F.col("best.n_shared") / F.col("best.n_item")).alias("containment"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without its contaminated rows; all columns stay as they are.

    Rows are told apart by id and text: one contaminated text takes no other row with it that has its id, or has none.
    """
    key = row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    texts = docs.select(key.alias("row"), F.col(f"`{text_col}`").alias("text"))
    return without(docs, contaminated(texts, items, id_col="row", text_col="text", **options), {"row": key})
