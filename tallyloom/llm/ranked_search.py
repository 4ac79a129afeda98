"""Ranked lexical search: exact best-first search in ball trees over sparse term vectors."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyloom.llm.common import stored

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
VECTORS = "id long, n long, term array<int>, tf array<long>"
WEIGHED = "id long, key int, term array<int>, value array<long>"


def terms(text: bytes | None, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text (runs of ASCII letters and digits and of all bytes from 0x80, A-Z lower-cased) piece by piece."""
    data, at = (text or b"").lower(), 0
    while at < len(data):
        cut = GAP.search(data, at + piece) if at + piece < len(data) else None
        end = cut.start() if cut else len(data)
        yield TERM.findall(data, at, end)
        at = end


def _count_terms(vocabulary: dict[bytes, int]):
    """Per text its length in terms and, of the vocabulary, the terms it holds with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, term, tf = [], [], []
            for text in batch.column("text"):
                found, size = Counter(), 0
                for part in terms(text.as_py()):
                    size += len(part)
                    found.update(map(vocabulary.get, part))
                found.pop(None, None)
                n.append(size)
                term.append(sorted(found))
                tf.append([found[t] for t in term[-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(term, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))],
                ["id", "n", "term", "tf"],
            )

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bounds and values of a list column without nulls."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    return bounds - bounds[0], column.flatten().to_numpy()


def _weigh(weights: np.ndarray, total: int, docs: int):
    """Term counts to integer values: weight times saturated frequency. ``key``: the term of the largest value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, term = _lists(batch.column("term"))
            tf = _lists(batch.column("tf"))[1]
            # Python integers: 90 n N passes 64 bits in a large corpus.
            m = np.array([10 + 90 * n * docs // total for n in batch.column("n").to_pylist()], np.int64)
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(bounds))))
            key = [int(term[a + np.argmax(value[a:b])]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x)) for x in (term.astype(np.int32), value)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(key, pa.int32()), *lists], ["id", "key", "term", "value"])

    return run


class BallTree:
    """Sparse non-negative integer vectors in a binary tree of balls, each with its centroid and radius.

    A node is cut at the median along the line between two far points, so the depth is logarithmic whatever the data.
    ``bounds`` adds a margin to every radius and product that is far above the rounding of doubles: a bound is never
    below the exact inner product of a vector under the node.
    """

    def __init__(self, bounds: np.ndarray, dims: np.ndarray, values: np.ndarray, width: int, leaf: int):
        self.dims, self.values, self.width = dims, values, width
        self.starts, self.sizes = bounds[:-1], np.diff(bounds)
        floats = values.astype(np.float64)
        self.squares = np.add.reduceat(np.append(floats * floats, 0.0), np.minimum(self.starts, len(floats))) * (self.sizes > 0)
        self.floats = floats
        self.centroids, self.radii, self.children, self.rows = [], [], [], []
        self._leaves: dict[int, np.ndarray] = {}
        todo = [(np.arange(len(self.sizes)), -1)]
        while todo:
            rows, parent = todo.pop()
            node = len(self.rows)
            if parent >= 0:
                self.children[parent].append(node)
            ends, at = self._entries(rows)
            centre = np.bincount(dims[at], floats[at], width) / len(rows)
            away = self._away(rows, ends, at, centre)
            self.centroids.append(centre)
            slack = 4e-16 * (width + 16) * (self.squares[rows].max() + centre @ centre)
            self.radii.append(math.sqrt(max(0.0, float(away.max())) + slack) * (1 + 1e-9))
            self.children.append([])
            self.rows.append(rows)
            if len(rows) > leaf:
                one = self._dense(rows[np.argmax(away)])
                two = self._dense(rows[np.argmax(self._away(rows, ends, at, one))])
                order = np.argsort(self._dot(ends, at, one - two), kind="stable")
                half = len(rows) // 2
                todo += [(rows[order[:half]], node), (rows[order[half:]], node)]
        self.centroids, self.radii = np.array(self.centroids), np.array(self.radii)

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        return ends, np.repeat(self.starts[rows] - ends + sizes, sizes) + np.arange(ends[-1])

    def _dot(self, ends: np.ndarray, at: np.ndarray, dense: np.ndarray) -> np.ndarray:
        sums = np.append(0.0, np.cumsum(self.floats[at] * dense[self.dims[at]]))
        return np.diff(sums[ends], prepend=0.0)

    def _away(self, rows: np.ndarray, ends: np.ndarray, at: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Squared distances, by sums over each row alone: running sums over all rows would round too much."""
        product = np.add.reduceat(np.append(self.floats[at] * dense[self.dims[at]], 0.0), np.append(0, ends[:-1]))
        return self.squares[rows] - 2 * product + dense @ dense

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.width)
        part = slice(self.starts[row], self.starts[row] + self.sizes[row])
        out[self.dims[part]] = self.floats[part]
        return out

    def bounds(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(nodes, queries): no vector under a node has a larger inner product; a query is a set of dimensions."""
        product = np.add.reduceat(self.centroids[:, flat], starts, axis=1)
        reach = np.sqrt(np.diff(np.append(starts, len(flat))))
        return (product + self.radii[:, None] * reach) * (1 + 1e-9) + 1

    def scores(self, node: int, dims: np.ndarray) -> np.ndarray:
        """The exact integer inner products of a leaf's vectors with a query."""
        if node not in self._leaves:
            rows = self.rows[node]
            ends, at = self._entries(rows)
            block = np.zeros((self.width, len(rows)), np.int64)
            block[self.dims[at], np.repeat(np.arange(len(rows)), self.sizes[rows])] = self.values[at]
            self._leaves[node] = block
        return self._leaves[node][dims].sum(axis=0)


def best_first(tree: BallTree, bounds: np.ndarray, dims: np.ndarray, ids: list, top: list, k: int) -> None:
    """Adds a tree's vectors to ``top``, a query's heap of the ``k`` best (score, -id); ``bounds`` has one entry per node.

    The node of the largest bound is opened next. The search ends when that bound lies below the k-th score; an equal
    one is still opened, for a smaller id may be under it. Scores below 1 never count.
    """
    queue = [(-bounds[0], 0)]
    while queue:
        bound, node = heapq.heappop(queue)
        if -bound < (top[0][0] if len(top) == k else 1):
            return
        if tree.children[node]:
            for child in tree.children[node]:
                heapq.heappush(queue, (-bounds[child], child))
            continue
        found = tree.scores(node, dims)
        least = top[0][0] if len(top) == k else 1
        for i in np.flatnonzero(found >= least).tolist():
            entry = (int(found[i]), -ids[tree.rows[node][i]])
            if len(top) < k:
                heapq.heappush(top, entry)
            else:
                heapq.heappushpop(top, entry)


NO_ID = 2**63  # a null id ranks behind every other


def _search(queries: list[np.ndarray], width: int, k: int, leaf: int, tree_rows: int, tree_entries: int, terms_at_once: int = 1 << 14):
    """The best ``k`` rows of a partition for every query, from one ball tree after the other."""
    blocks, size = [[]], 0
    for q, dims in enumerate(queries):
        if size + len(dims) > terms_at_once and blocks[-1]:
            blocks.append([])
            size = 0
        if len(dims):
            blocks[-1].append(q)
            size += len(dims)
    blocks = [b for b in blocks if b]

    def look(parts: list[pa.RecordBatch], best: list[list]) -> None:
        ids = [NO_ID if i is None else i for p in parts for i in p.column("id").to_pylist()]
        sizes = np.concatenate([np.diff(_lists(p.column("term"))[0]) for p in parts])
        term, value = (np.concatenate([_lists(p.column(c))[1] for p in parts]) for c in ("term", "value"))
        used, dims = np.unique(term, return_inverse=True)
        place = np.full(width, len(used))  # a term that no vector here holds gets a dimension of zeros
        place[used] = np.arange(len(used))
        tree = BallTree(np.append(0, np.cumsum(sizes)), dims, value.astype(np.int64), len(used) + 1, leaf)
        for block in blocks:
            own = [place[queries[q]] for q in block]
            bounds = tree.bounds(np.concatenate(own), np.append(0, np.cumsum([len(d) for d in own])[:-1]))
            for at, q in enumerate(block):
                best_first(tree, bounds[:, at], own[at], ids, best[q], k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[] for _ in queries]
        held, rows, entries = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, tree_rows):
                part = batch.slice(at, tree_rows)
                held.append(part)
                rows, entries = rows + part.num_rows, entries + len(_lists(part.column("term"))[1])
                if rows >= tree_rows or entries >= tree_entries:
                    look(held, best)
                    held, rows, entries = [], 0, 0
        if held:
            look(held, best)
        found = [(q, None if -i == NO_ID else -i, s) for q, heap in enumerate(best) for s, i in heap]
        for at in range(0, len(found), 10_000):
            columns = zip(*found[at : at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["query", "id", "score"]
            )

    return run


def _ranked_block(texts: DataFrame, queries: list[list[bytes]], k: int, leaf: int, tree_rows: int, tree_entries: int, rows_per_task: int) -> DataFrame:
    """``query`` (place in ``queries``), ``rank``, ``id``, ``score``."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for q in queries for t in q}))}
    counted = stored(texts.mapInArrow(_count_terms(vocabulary), VECTORS), "term-counts")
    docs, total = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = counted.filter(F.size("term") > 0)
    # One number per term of this block of queries.
    df = dict(held.select(F.explode("term").alias("t")).groupBy("t").count().collect())
    weight = [math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocabulary))]
    vectors = stored(held.mapInArrow(_weigh(np.array(weight, np.int64), max(total, 1), docs), WEIGHED), "term-vectors")
    rows, shuffles = vectors.count(), int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-rows // rows_per_task), min(shuffles, -(-rows // tree_rows)))
    # Texts with the same strongest term lie in the same trees; equal keys may spread over several partitions.
    near = vectors.repartitionByRange(parts, "key", F.xxhash64("id", "value"))
    dims = [np.array([vocabulary[t] for t in q], np.int64) for q in queries]
    best = near.mapInArrow(_search(dims, len(vocabulary), k, leaf, tree_rows, tree_entries), "query int, id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 10,
    leaf: int = 32,
    tree_rows: int = 2048,
    tree_entries: int = 500_000,
    rows_per_task: int = 50_000,
    block_bytes: int = 4 * 2**20,
) -> DataFrame:
    """The ``k`` best documents for every item by a saturated term score: item, ``rank``, id, ``score``.

    With N documents that hold a term, L terms in all, n in one document and df documents for a term, a term weighs
    floor(1000 ln((2N+2) / (2df+1))), a document's m is 10 + (90 n N div L), and the score sums
    weight * ((10^9 tf) div (1000 tf + 8 m)) over the item's distinct terms, in whole numbers.

    The statistics and the scores cover all documents. The items are taken in blocks of ``block_bytes`` of text, so
    what a task holds of them is bounded; a block reads the corpus once and keeps of each document only the terms of
    the block. These sparse vectors are dealt by their strongest term, and each task puts them into ball trees of
    ``tree_rows`` vectors or ``tree_entries`` entries and searches every tree best-first with the k-th scores it has so far.
    A task returns k rows an item at most, from which the ranks are taken.

    Equal scores rank by ascending id, null ids last; documents with score 0 are left out, so an item may have fewer
    rows or none. Null and empty texts have no terms. Rows that repeat an id are separate documents and separate items.
    A long text is read piece by piece. Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    wanted = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").cast("binary").alias("text"))
    found = []
    for block in _blocks(wanted.toLocalIterator(), block_bytes):
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], f"query int, item {wanted.schema['item'].dataType.simpleString()}")
        ranked = _ranked_block(texts, [t for _, t in block], k, leaf, tree_rows, tree_entries, rows_per_task)
        found.append(stored(ranked.join(names, "query").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"), "ranked"))
    if not found:
        return _none(spark, wanted, item_col, id_col)
    return reduce(DataFrame.unionByName, found)


def _blocks(rows: Iterator, block_bytes: int) -> Iterator[list[tuple]]:
    """(item, its distinct terms) in lists of about ``block_bytes`` of text."""
    block, size = [], 0
    for item, text in rows:
        block.append((item, sorted({t for part in terms(bytes(text or b"")) for t in part})))
        size += len(text or b"") + 64
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _none(spark: SparkSession, wanted: DataFrame, item_col: str, id_col: str) -> DataFrame:
    kind = wanted.schema["item"].dataType.simpleString()
    return spark.createDataFrame([], f"`{item_col}` {kind}, rank int, `{id_col}` long, score long")
