"""MinHash near-dedup: universal hash minima, banding, signature check, full-set check, connected components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.common import sized, stored
from tallyloom.llm.components import connected_components
from tallyloom.llm.text_arrays import U64, shingle_sets, slices

HASH_BLOCK = 1 << 15  # shingles hashed at a time: stays in the processor's cache


def hash_functions(count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add-shift: h(x) = (a x + b mod 2^64) >> 32, a universal family for 32-bit x."""
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(1, 2**64, count, dtype=U64) | U64(1), rng.integers(0, 2**64, count, dtype=U64)


def signatures(shingles: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """(sets, count) uint32: the least hash of each set under each function; empty sets get the largest value."""
    a, b = hash_functions(count)
    full = np.flatnonzero(np.diff(bounds))
    out = np.full((len(bounds) - 1, count), 0xFFFFFFFF, np.uint32)
    if not len(full):
        return out
    folded = shingles >> U64(32)
    first = 0
    while first < len(full):
        # whole sets, about HASH_BLOCK shingles
        last = max(first + 1, int(np.searchsorted(bounds[full], bounds[full[first]] + HASH_BLOCK)))
        at, end = bounds[full[first]], bounds[full[last - 1] + 1]
        x, starts = folded[at:end], bounds[full[first:last]] - at
        for k in range(count):
            h = x * a[k]
            h += b[k]
            out[full[first:last], k] = np.minimum.reduceat(h, starts) >> U64(32)
        first = last
    return out


def _sign(width: int, count: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices(batch["text"].tolist()):
                rows = batch.iloc[part]
                sets, bounds = shingle_sets(rows["text"].tolist(), width)
                signed = signatures(sets, bounds, count)
                keys = [
                    hashlib.blake2b(sets[i:j].tobytes(), digest_size=16).digest() if j > i else None
                    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                ]
                yield pd.DataFrame(
                    {"id": rows["id"].tolist(), "text_hash": rows["text_hash"].tolist(), "n_shingles": np.diff(bounds), "key": keys, "signature": [s.tobytes() for s in signed]}
                )

    return run


def _alike(count: int, least: float):
    """Signature check: the pairs whose signatures agree in at least ``least`` of the places."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[c]), np.uint32).reshape(-1, count) for c in ("signature_a", "signature_b"))
            yield batch.loc[(a == b).sum(axis=1) >= least * count, ["a", "b"]]

    return run


def _linked(width: int, percent: int):
    """Full check: the pairs with 100 * intersection >= percent * union of their shingle sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in slices((batch["text_a"] + batch["text_b"]).tolist()):
                rows = batch.iloc[part]
                a, ends_a = shingle_sets(rows["text_a"].tolist(), width)
                b, ends_b = shingle_sets(rows["text_b"].tolist(), width)
                keep = []
                for i in range(len(rows)):
                    x, y = a[ends_a[i] : ends_a[i + 1]], b[ends_b[i] : ends_b[i + 1]]
                    both = np.sort(np.concatenate((x, y)))
                    shared = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * shared >= percent * (len(both) - shared))
                yield rows.loc[keep, ["a", "b"]].set_axis(["u", "v"], axis=1)

    return run


def _groups(batches: Iterator[pd.DataFrame], by: int) -> Iterator[list[list]]:
    """The columns of each run of rows that agree in the first ``by`` columns, of batches sorted by them."""
    current, held = None, None
    for batch in batches:
        columns = [batch[c].tolist() for c in batch.columns]
        keys = list(zip(*columns[:by], strict=True))
        cuts = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)] if keys else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if keys[a] != current:
                if held is not None:
                    yield held
                current, held = keys[a], [[] for _ in columns]
            for own, column in zip(held, columns, strict=True):
                own.extend(column[a:b])
    if held is not None:
        yield held


BLOCK = "band long, i int, j int, key binary, comp binary, centre boolean"


def _possible(count: int, least: float):
    """Of each block the rows whose signature agrees well enough with one on the other side, of another component."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for group in _groups(batches, 3):
            band, i, j, key, comp, centre, signature = group
            signed = np.frombuffer(b"".join(signature), np.uint32).reshape(-1, count)
            _, kind = np.unique(np.array(comp, dtype=object), return_inverse=True)
            centre = np.array(centre, bool)
            ours, theirs = np.flatnonzero(centre), np.flatnonzero(~centre)
            hit = np.zeros(len(key), bool)
            for c in ours.tolist():
                likely = ((signed[theirs] == signed[c]).sum(axis=1) >= least * count) & (kind[theirs] != kind[c])
                hit[theirs[likely]] = True
                hit[c] = likely.any()
            rows += [(band[k], i[k], j[k], key[k], comp[k], bool(centre[k])) for k in np.flatnonzero(hit).tolist()]
            if len(rows) >= 5000:
                yield pd.DataFrame(rows, columns=["band", "i", "j", "key", "comp", "centre"])
                rows = []
        yield pd.DataFrame(rows, columns=["band", "i", "j", "key", "comp", "centre"])

    return run


def _links_of_blocks(width: int, percent: int):
    """Links between the centres and the other rows of a block that join different components, at most one less than its rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches, 3):
            _, _, _, key, comp, centre, text = group
            sets, ends = shingle_sets(text, width)
            sizes, centre = np.diff(ends), np.array(centre, bool)
            owner = np.repeat(np.arange(len(key)), sizes)
            inside = ~centre[owner]
            order = np.argsort(sets[inside], kind="stable")
            values, owners = sets[inside][order], owner[inside][order]
            root = {c: c for c in comp}

            def find(c, root=root):
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            edges = []
            for c in np.flatnonzero(centre).tolist():
                own = sets[ends[c] : ends[c + 1]]
                low, high = np.searchsorted(values, own), np.searchsorted(values, own, side="right")
                many = high - low
                at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                shared = np.bincount(owners[at], minlength=len(key))
                linked = (shared > 0) & (100 * shared >= percent * (sizes + sizes[c] - shared))
                for m in np.flatnonzero(linked).tolist():
                    a, b = find(comp[c]), find(comp[m])
                    if a != b:
                        root[a] = b
                        edges.append((key[c], key[m]))
            yield pd.DataFrame(edges, columns=["u", "v"])

    return run


def _pivot_blocks(members: DataFrame, pivots: int | None, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The open buckets in blocks (``BLOCK``), and the buckets that this leaves open.

    Every pair across components has an end outside the bucket's largest component, so the centres are taken from
    there: all rows where there are at most ``pivots``, else a hashed share. Centres (``i``) and members (``j``) are
    dealt into blocks of ``block_rows``; block (i, j) holds one of each kind, so no task gets a whole bucket, and
    pairs are compared inside blocks and never become rows. A bucket is done once all were centres.
    """
    sizes = members.groupBy("band", "comp").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("band").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"))
    others = F.col("n") - F.col("main.n")
    open_ = sizes.filter("main.n < n").select("band", F.col("main.comp").alias("main"), "n", others.alias("others"))
    open_ = sized(stored(open_, "open-buckets"))
    inside = members.join(open_, "band")
    centres, chosen = F.col("others"), F.col("comp") != F.col("main")
    if pivots is not None:
        draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / (1 << 30)
        chosen = chosen & ((F.col("others") <= pivots) | (draw * F.col("others") < pivots))
        centres = F.least(centres, F.lit(2 * pivots))
    blocks = lambda n: F.ceil(n / block_rows).cast("int")
    place = lambda seed, n: F.pmod(F.xxhash64("key", F.lit(seed)), blocks(n)).cast("int")
    each = lambda n: F.sequence(F.lit(0), blocks(n) - 1)
    rows = inside.select("band", F.explode(each(centres)).alias("i"), place(1, F.col("n")).alias("j"), "key", "comp", F.lit(False).alias("centre"))
    centre = inside.filter(chosen).select(
        "band", place(2, centres).alias("i"), F.explode(each(F.col("n"))).alias("j"), "key", "comp", F.lit(True).alias("centre")
    )
    left = open_.filter(F.col("others") > pivots) if pivots is not None else open_.filter("false")
    return rows.unionByName(centre), left.select("band")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = 25,
    rows: int = 4,
    block_rows: int = 1024,
    broadcast_rows: int = 2_000_000,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``, ``text_hash`` (MD5 of the text, null for null).

    Words are runs without ASCII white space, A-Z lower-cased; a set holds the distinct hashed runs of ``width``
    words, or the whole sequence of a shorter text. Two texts are linked from ``percent`` similarity of the full
    sets on; ``component_id`` is the least id reachable, and that row is ``kept``. A pair at the threshold shares
    no band with a probability of (1 - (percent/100)^rows)^bands, 2e-6 at 80 and 5e-9 at 85 percent.

    Equal sets are one node. Pairs inside a bucket are not listed. First all members of a bucket are compared with
    one of them, which is a pair a member. Where several components are left, pivots from outside the largest one
    are compared with all members, at last all rows outside it, in blocks of ``block_rows`` by ``block_rows``: so
    every cross pair of every bucket is tested, a block returns no more links than it has rows, and no task holds
    a whole bucket. Candidates pass the signature check (six standard deviations of slack), then the check on full
    sets. Texts move only for those that pass the first; the ids to fetch are broadcast up to ``broadcast_rows``.

    A text that is null or has no words has an empty set and is its own component. Rows that share an id are
    separate texts, which ``text_hash`` tells apart; a null id counts as larger than any other and only names a component of null ids. Other
    columns are not read; an empty table gives no rows.
    """
    count, t = bands * rows, percent / 100
    least = t - 6 * math.sqrt(t * (1 - t) / count)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.withColumn("text_hash", F.unhex(F.md5(F.col("text").cast("binary"))))
    # The id travels as a string: as a pandas integer a null would turn the column into floats.
    signed = texts.withColumn("id", F.col("id").cast("string")).mapInPandas(
        _sign(width, count), "id string, text_hash binary, n_shingles long, key binary, signature binary"
    )
    signed = stored(signed.withColumn("id", F.col("id").cast("long")), "signatures")
    nodes = signed.filter("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct("id", "text_hash")).alias("source"), F.first("signature").alias("signature")
    )
    nodes = stored(nodes, "nodes")
    band = [F.xxhash64(F.lit(k), F.substring("signature", 4 * rows * k + 1, 4 * rows)) for k in range(bands)]
    placed = nodes.select("key", F.explode(F.array(*band)).alias("band"))
    shared = stored(placed.groupBy("band").count().filter("count > 1").select("band"), "bands")
    members = stored(placed.join(shared, "band"), "buckets")

    source = nodes.select("key", "source")
    centre = members.groupBy("band").agg(F.min(F.struct(F.xxhash64("key"), "key")).alias("p"), F.count("*").alias("n"))
    centre = stored(centre, "first-pivots")
    pairs = members.join(centre.select("band", F.col("p.key").alias("b")), "band").filter("key <> b")
    pairs = pairs.select(F.greatest("key", "b").alias("a"), F.least("key", "b").alias("b")).distinct()
    signature = lambda end: nodes.select(F.col("key").alias(end), F.col("signature").alias(f"signature_{end}"))
    likely = pairs.join(signature("a"), "a").join(signature("b"), "b").mapInPandas(_alike(count, least), "a binary, b binary")
    likely = sized(stored(likely, "likely"))
    found = _texts(likely.select(F.explode(F.array("a", "b")).alias("key")), source, texts, broadcast_rows)
    text = lambda end: found.select(F.col("key").alias(end), F.col("text").alias(f"text_{end}"))
    linked = likely.join(text("a"), "a").join(text("b"), "b").mapInPandas(_linked(width, percent), "u binary, v binary")
    labels = sized(stored(connected_components(linked), "labels"))

    open_ = centre.filter("n > 2").select("band")
    for pivots in (16, None):
        members = stored(members.join(open_, "band"), "open-members")
        now = members.join(labels, F.col("key") == F.col("node"), "left").select("band", "key", F.coalesce("root", "key").alias("comp"))
        blocks, open_ = _pivot_blocks(stored(now, "placed"), pivots, block_rows)
        signed_blocks = blocks.join(nodes.select("key", "signature"), "key").select("band", "i", "j", "key", "comp", "centre", "signature")
        signed_blocks = signed_blocks.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
        possible = stored(signed_blocks.mapInPandas(_possible(count, least), BLOCK), "possible")
        if possible.isEmpty():
            continue
        found = _texts(possible.select("key"), source, texts, broadcast_rows)
        full = possible.join(found, "key").select("band", "i", "j", "key", "comp", "centre", "text")
        full = full.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
        labels = _relabelled(labels, stored(full.mapInPandas(_links_of_blocks(width, percent), "u binary, v binary"), "links"))
    return _named(signed, labels, id_col)


def _texts(keys: DataFrame, source: DataFrame, texts: DataFrame, broadcast_rows: int) -> DataFrame:
    """``key``, ``text``: one text for each set in ``keys``, from the row that ``source`` names."""
    wanted = keys.distinct().join(source, "key")
    wanted = stored(wanted.select("key", F.col("source.id").alias("want_id"), F.col("source.text_hash").alias("want_hash")), "wanted")
    few = wanted.count() <= broadcast_rows
    same = F.col("id").eqNullSafe(F.col("want_id")) & F.col("text_hash").eqNullSafe(F.col("want_hash"))
    return texts.join(F.broadcast(wanted) if few else wanted, same).select("key", "text").dropDuplicates(["key"])


def _relabelled(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, root) after adding ``edges``: the old components are contracted to their roots first."""
    end = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    lifted = edges.join(end("u"), "u", "left").join(end("v"), "v", "left")
    lifted = lifted.select(F.coalesce("root_u", "u").alias("u"), F.coalesce("root_v", "v").alias("v"))
    merged = sized(stored(connected_components(lifted), "merged")).select(F.col("node").alias("old"), F.col("root").alias("new"))
    moved = labels.join(merged, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
    known = labels.select(F.col("node").alias("old"))
    added = merged.join(known, "old", "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
    return sized(stored(moved.unionByName(added), "labels"))


def _named(signed: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """The rows with the least id of their component."""
    full = signed.filter("key IS NOT NULL").select("id", "text_hash", "n_shingles", "key")
    full = full.join(labels, F.col("key") == F.col("node"), "left").select("id", "text_hash", "n_shingles", F.coalesce("root", "key").alias("comp"))
    full = stored(full, "labelled")
    least = stored(full.groupBy("comp").agg(F.min("id").alias("component_id")), "least-ids")
    rows = full.join(least, "comp").select("id", "text_hash", "n_shingles", "component_id")
    empty = signed.filter("key IS NULL").select("id", "text_hash", "n_shingles", F.col("id").alias("component_id"))
    return rows.unionByName(empty).select(
        F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash"
    )
