"""Exact dedup: a Bloom filter of repeated hashes, counted by a shuffle of positions, picks the digests that have to meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.common import lower_ascii, stored
from tallyloom.session import checkpointed

BITMAP_BITS = 32768  # per row of Spark's bitmap functions


def _positions(bits: int) -> list[Column]:
    """Where the two hash functions put a digest; the second one has its own half of the filter."""
    return [F.pmod(F.xxhash64("digest", F.lit(k)), F.lit(bits)) + k * bits + 1 for k in range(2)]


def _bit(bitmap: Column, position: Column) -> Column:
    at = F.bitmap_bit_position(position)
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, F.pmod(at, F.lit(8)).cast("int")).bitwiseAND(1) == 1


def repeat_filter(keys: DataFrame, bits: int) -> DataFrame:
    """First pass: the filter positions that two or more rows hit, as bitmaps of 32768 bits (``part``, ``bitmap``)."""
    hits = keys.select(F.explode(F.array(*_positions(bits))).alias("position"))
    twice = hits.groupBy("position").count().filter("count > 1")
    return twice.groupBy(F.bitmap_bucket_number("position").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bitmap")
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = 32,
    broadcast_bytes: int = 256 * 2**20,
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the largest id
    stays. Texts are hashed where they are read and never move. The first pass counts filter positions and keeps
    those hit twice: two (position, count) rows a document shuffle, nearly all distinct, so that combining them
    beforehand saves little; the second tests each row and
    shuffles only the digests that may be repeated, a superset of those that are. A filter of more than
    ``broadcast_bytes`` is joined by shuffle instead of broadcast.

    Rows with the same text and the same id share their fate. A null id is smaller than any other: it is kept
    only in a group without other ids. Other columns of ``docs`` are not read; an empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keys = stored(
        docs.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.sha2(lower_ascii(text), 256)).alias("digest")), "digests"
    )
    rows = keys.count()
    bits = BITMAP_BITS * max(1, -(-rows * bits_per_row // (2 * BITMAP_BITS)))
    repeats = checkpointed(repeat_filter(keys, bits))
    if 2 * bits // 8 <= broadcast_bytes:
        repeats = F.broadcast(repeats)

    tested = keys
    for k, position in enumerate(_positions(bits)):
        part = repeats.select(F.col("part").alias(f"part{k}"), F.col("bitmap").alias(f"bitmap{k}"))
        tested = tested.withColumn(f"position{k}", position)
        tested = tested.join(part, F.bitmap_bucket_number(f"position{k}") == F.col(f"part{k}"), "left")
        tested = tested.withColumn(f"hit{k}", F.coalesce(_bit(F.col(f"bitmap{k}"), F.col(f"position{k}")), F.lit(False)))
    maybe = F.col("hit0") & F.col("hit1")

    single = tested.filter(~maybe).select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest")
    shuffled = stored(tested.filter(maybe).select("id", "digest"), "maybe-repeated")
    groups = checkpointed(shuffled.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")))
    grouped = shuffled.join(groups, "digest").select("id", "keep_id", "group_size", "digest")
    return single.unionByName(grouped).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
