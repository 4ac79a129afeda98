"""Substring dedup: runs of several consecutive sentences are hashed, joined globally, and later copies cut out of the text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructType
from xxhash import xxh3_128_digest

from tallyloom.llm.common import stored
from tallyloom.session import checkpointed

SPACES = b" \t\n\r\x0b\x0c"
# A word with the blanks after it; words and blanks are ASCII-separated, so the work is done on UTF-8 bytes.
TOKEN = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
WORD_START = re.compile(rb"[\x20\x09-\x0D](?=[^\x20\x09-\x0D])")
SENTENCE_END = re.compile(rb"""[.!?]['")\]]*[\x20\x09-\x0D]*\Z|[\x0A-\x0D]""")
# Words scanned, runs sent on, and ranks remembered at a time.
STEP_BYTES, BATCH_RUNS, MOST_RANKS = 4 * 2**20, 20_000, 100_000
CUT = StructType().add("kept", StringType()).add("n_removed", LongType()).add("n_spans", LongType())


class _Ranks(dict):
    """Rank of a word as a place to end a sentence: words at sentence and line ends first, then by digest."""

    def __missing__(self, token: bytes) -> int:
        rank = int.from_bytes(hashlib.md5(token.rstrip(SPACES)).digest()[:7], "big")
        if not SENTENCE_END.search(token):
            rank |= 1 << 56
        if len(self) < MOST_RANKS and len(token) <= 64:
            self[token] = rank
        return rank


def sentences(text: bytes, ranks: _Ranks, reach: int, most_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset of every word (and the text's length), and the number of each sentence's first word (and of all words).

    A sentence ends after a word that ranks before the ``reach`` words on either side. So ends depend on the words
    near them only: a passage is cut alike wherever it stands, a long sentence is cut inside, and lines of a word or
    two are joined. Where words repeat so evenly that none ranks first, a cut falls every ``most_words`` words.
    """
    at = len(text) - len(text.lstrip(SPACES))
    starts, values = [], []
    while at < len(text):
        gap = WORD_START.search(text, at + STEP_BYTES)
        end = gap.end() if gap else len(text)
        tokens = TOKEN.findall(text, at, end)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        starts.append(at + np.cumsum(sizes) - sizes)
        values.append(np.fromiter(map(ranks.__getitem__, tokens), np.int64, len(tokens)))
        at = end
    if not starts:
        return np.array([len(text)]), np.array([0])
    offsets, value = np.concatenate([*starts, [len(text)]]), np.concatenate(values)
    ends = np.ones(len(value), bool)
    for k in range(1, min(reach, len(value) - 1) + 1):
        ends[k:] &= value[k:] < value[:-k]
        ends[:-k] &= value[:-k] <= value[k:]
    edges = np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1, [len(value)]])
    long = np.flatnonzero(np.diff(edges) > most_words)
    more = [np.arange(edges[i] + most_words, edges[i + 1], most_words) for i in long]
    return offsets, np.sort(np.concatenate([edges, *more])) if more else edges


def run_places(edges: np.ndarray, length: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last sentence of every run: ``length`` sentences, or more until they hold ``least_words`` words."""
    count = len(edges) - 1
    first = np.arange(max(1, count - length + 1))
    last = np.maximum(first + min(length, count), np.searchsorted(edges, edges[first] + least_words))
    return first[last <= count], last[last <= count]


def _hashed_runs(length: int, least_words: int, reach: int, most_words: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, doc = _Ranks(), TaskContext.get().partitionId() << 33
        for batch in batches:
            owners = [batch.column(c) for c in ("id", "r1", "r2")]
            held, digests, count = [], [], 0

            def out() -> pa.RecordBatch:
                rows, docs, at = (np.concatenate(c) for c in zip(*held))
                hashes = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
                taken = [c.take(pa.array(rows)) for c in owners]
                numbers = [pa.array(c, pa.int64()) for c in (docs, at, hashes[:, 0], hashes[:, 1])]
                return pa.RecordBatch.from_arrays([*taken, *numbers], ["id", "r1", "r2", "doc", "at", "h1", "h2"])

            for row, cell in enumerate(batch.column("text")):
                text, doc = cell.as_py() or b"", doc + 1
                _, edges = sentences(text, ranks, reach, most_words)
                first, last = run_places(edges, length, least_words)
                words = text.split() if len(first) else []
                joined = b" ".join(words)
                begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
                for k in range(0, len(first), BATCH_RUNS):
                    a, b = first[k : k + BATCH_RUNS], last[k : k + BATCH_RUNS]
                    held.append((np.full(len(a), row), np.full(len(a), doc), a))
                    places = zip(begin[edges[a]].tolist(), (begin[edges[b]] - 1).tolist())
                    digests += [xxh3_128_digest(joined[s:e]) for s, e in places]
                    count += len(a)
                    if count >= BATCH_RUNS:
                        yield out()
                        held, digests, count = [], [], 0
            if held:
                yield out()

    return hashed


def repeated_spans(rows: DataFrame, length: int, least_words: int, reach: int, most_words: int) -> DataFrame:
    """``r1, r2, at`` of every run in ``rows`` (id, r1, r2, text in bytes) that is not the first of its kind.

    The first has the least (id, row, position), a null id last. Half the hash is counted first; only runs whose half
    occurs again go on with their owner's id and keys, under a number of the document until then.
    """
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, r1 long, r2 long, doc long, at long, h1 long, h2 long"
    spans = stored(rows.mapInArrow(_hashed_runs(length, least_words, reach, most_words), schema), "spans")
    twice = checkpointed(spans.groupBy("h1").agg(F.count("*").alias("n")).filter("n > 1").select("h1"))
    owners = spans.select("doc", "id", "r1", "r2").distinct()
    spans = stored(spans.select("doc", "at", "h1", "h2").join(twice, "h1").join(owners, "doc").drop("doc"), "spans")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "r1", "r2", "at")
    first = spans.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = checkpointed(first.select("h1", "h2", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("r1", "r2", "at")]))
    again = spans.drop("id").join(first, ["h1", "h2"])
    return again.filter("r1 <> first_r1 OR r2 <> first_r2 OR at <> first_at").select("r1", "r2", "at")


def _cutter(length: int, least_words: int, reach: int, most_words: int):
    ranks = _Ranks()

    @F.pandas_udf(CUT)
    def cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        """The text without the union of the runs that begin at the given sentences; null where there are none."""
        out = []
        for whole, found in zip(text, spans):
            if whole is None or found is None:
                out.append((None, 0, 0))
                continue
            offsets, edges = sentences(whole, ranks, reach, most_words)
            first, last = run_places(edges, length, least_words)
            depth = np.zeros(len(edges), np.int64)
            chosen = np.searchsorted(first, np.sort(found))
            np.add.at(depth, first[chosen], 1)
            np.add.at(depth, last[chosen], -1)
            gone = np.cumsum(depth) > 0
            turns = np.flatnonzero(np.diff(gone, prepend=False))
            bounds = [0, *offsets[edges[turns]].tolist(), len(whole)]
            kept = b"".join(whole[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
            out.append((kept.decode("utf-8"), int(gone.sum()), len(turns) // 2))
        return pd.DataFrame(out, columns=["kept", "n_removed", "n_spans"])

    return cut


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 3,
    least_words: int = 10,
    reach: int = 3,
    most_words: int = 64,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """``docs`` with ``n_removed``, ``n_spans`` and ``kept_text``: what any non-first repeated span covers is cut out.

    A span is a run of ``length`` consecutive sentences, of more where those hold fewer than ``least_words`` words;
    spans overlap, and a document of fewer sentences is one span if it has the words. Sentences are cut by
    ``sentences``. Spans are equal if their words are (blanks may differ; 128-bit digests). All spans are hashed and
    meet by hash: the first keeps its place, every other one goes, copies inside one document included. What is
    first is judged on the input. Only hashes and places shuffle before the last join; repeated halves and first
    places are stored, so that adaptive execution can split the joins at a span that a third of all documents share.
    Texts move only where something goes: the keys of those rows are broadcast, 16 bytes each, up to
    ``broadcast_rows`` of them; beyond that all texts meet their spans by shuffle.

    ``kept_text`` is the text itself where nothing was removed, and otherwise the text without the bytes from each
    removed sentence's first word to the next kept one's. ``n_removed`` counts sentences, ``n_spans`` maximal runs of them.

    A null text stays null, an empty one empty. Ids may repeat or be null (null comes last); rows are told apart
    by two 64-bit hashes of id and text, so that equal rows share the fate of the first. All columns pass through, one
    named like an added column with the suffix "_in"; an empty table gives no rows.
    """
    # Under neutral names no column of the input clashes, and unused ones are still pruned.
    names = {c: f"__{k}" for k, c in enumerate(docs.columns)}
    ident, text = names[id_col], names[text_col]
    rows = docs.toDF(*names.values())
    rows = rows.withColumns({r: F.xxhash64(F.lit(seed), ident, text) for r, seed in (("r1", 3), ("r2", 5))})
    source = rows.select(F.col(ident).alias("id"), "r1", "r2", F.col(text).cast("binary").alias("text"))
    rules = (length, least_words, reach, most_words)
    cover = repeated_spans(source, *rules).groupBy("r1", "r2").agg(F.collect_set("at").alias("spans"))
    cover = checkpointed(cover)
    if cover.count() <= broadcast_rows:
        keys = F.broadcast(cover.select("r1", "r2"))
        whole = rows.join(keys, ["r1", "r2"], "left_semi").join(cover, ["r1", "r2"])
        whole = whole.unionByName(rows.join(keys, ["r1", "r2"], "left_anti"), allowMissingColumns=True)
    else:
        whole = rows.join(cover, ["r1", "r2"], "left")
    text_bytes = F.when(F.col("spans").isNotNull(), F.col(text).cast("binary"))
    whole = whole.withColumn("cut", _cutter(*rules)(text_bytes, F.col("spans")))
    out = {
        "n_removed": F.col("cut.n_removed"),
        "n_spans": F.col("cut.n_spans"),
        "kept_text": F.coalesce("cut.kept", F.col(text)),
    }
    own = [F.col(n).alias(f"{c}_in" if c in out else c) for c, n in names.items()]
    return whole.select(*own, *[c.alias(n) for n, c in out.items()])
