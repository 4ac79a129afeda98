"""Phrase collocation mining: phrases grow best-first, as long as their prefix counts let them reach the best scores."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.common import LOWER, UPPER, stored
from tallyloom.llm.text_arrays import U64, mixed

# A-Z lowered, what ends a piece to a full stop, the tabulator to a blank.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(UPPER.encode() + _ENDS + b"\t", LOWER.encode() + b"." * len(_ENDS) + b" ")
_GAP = re.compile(rb"[ .]")
STOP = b"."  # stands between pieces; no word holds one
LONGEST = 4
SCALE = 2_000_000
GRAMS = "lang string, gram binary, n long"
FEWEST_BITS, MOST_BITS = 23, 28  # of a filter: 1 to 32 MB; phrases beyond that only make it let more through
BITMAP_BITS = 32768  # per row of Spark's bitmap functions


def _words(data: bytes) -> pa.Array:
    """The words of plain bytes, in their order, with a STOP for every end of a piece."""
    text = np.frombuffer(data.replace(STOP, b" . "), np.uint8)
    blank = text == 32
    edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    offsets = np.append(0, np.cumsum(edges[1::2] - edges[::2])).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text[~blank])])


def word_runs(texts: list[bytes | None], most: int = 1 << 20) -> Iterator[tuple[pa.Array, int]]:
    """Words with a STOP between pieces, some ``most`` bytes at a time, and how many of them were in the run before.

    A longer text is cut between words; its next run begins with the last words of the one before, so that every
    phrase lies inside a run. A phrase counts in the run in which its last word is new.
    """
    held, size = [], 0
    for text in texts:
        data = (text or b"").translate(_PLAIN)
        if len(data) <= most:
            held.append(data)
            size += len(data)
            if size >= most:
                yield _words(STOP.join(held)), 0
                held, size = [], 0
            continue
        at, known = 0, _words(b"")
        while at < len(data):
            cut = _GAP.search(data, at + most) if at + most < len(data) else None
            end = cut.start() if cut else len(data)
            words = pa.concat_arrays([known, _words(data[at:end])])
            yield words, len(known)
            known, at = words[max(0, len(words) - LONGEST + 1) :], end
    if held:
        yield _words(STOP.join(held)), 0


def _phrases(words: list[pa.Array]) -> pa.Array:
    """The words of each place joined by blanks."""
    return words[0] if len(words) == 1 else pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary()))


def _by_language(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    texts = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        texts.setdefault(lang, []).append(text)
    return texts


def _batch(lang: str, grams: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([lang] * len(grams), pa.string()), grams.cast(pa.binary()), pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])


def _numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array, int]:
    """Each word's place in a list of the kinds, the list, and the place of STOP."""
    coded = words.dictionary_encode()
    stop = pc.index(coded.dictionary, pa.scalar(STOP, pa.large_binary())).as_py()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, stop


def _count_words_and_pairs(most: int):
    """Partial counts of words and pairs, of some ``most`` words at a time; the empty phrase counts all words."""

    def counted(lang: str, runs: list[tuple[pa.Array, int]]) -> Iterator[pa.RecordBatch]:
        at, kinds, stop = _numbered(pa.concat_arrays([words for words, _ in runs]))
        ends = np.cumsum([len(words) for words, _ in runs])
        parts = [(at[end - len(words) : end], known) for end, (words, known) in zip(ends, runs, strict=True)]
        new = np.concatenate([ids[known:] for ids, known in parts])
        sums = np.bincount(new[new != stop], minlength=len(kinds))
        seen = np.flatnonzero(sums)
        yield _batch(lang, pa.array([b""], pa.binary()), sums.sum(keepdims=True))
        yield _batch(lang, kinds.take(pa.array(seen)), sums[seen])
        starts = [ids[max(0, known - 1) :] for ids, known in parts]
        first, second = np.concatenate([i[:-1] for i in starts]), np.concatenate([i[1:] for i in starts])
        inside = (first != stop) & (second != stop)
        pairs, sums = np.unique(first[inside] * len(kinds) + second[inside], return_counts=True)
        for at in range(0, len(pairs), 100_000):
            ends = np.divmod(pairs[at : at + 100_000], len(kinds))
            yield _batch(lang, _phrases([kinds.take(pa.array(e)) for e in ends]), sums[at : at + 100_000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for lang, texts in _by_language(batch).items():
                for words, known in word_runs(texts):
                    held.setdefault(lang, []).append((words, known))
                    size += len(words)
                    if size >= most:
                        for key, runs in held.items():
                            yield from counted(key, runs)
                        held, size = {}, 0
        for key, runs in held.items():
            yield from counted(key, runs)

    return run


def _hashes(lang: str, hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` words, from those of the words."""
    n = max(0, len(hashes) - width + 1)
    acc = np.full(n, xxhash.xxh64_intdigest(lang.encode(), seed=width), U64)
    for k in range(width):
        acc = mixed(acc ^ hashes[k : k + n])
    return acc


def _places(hashes: np.ndarray, flags_or_bits: np.ndarray | int) -> np.ndarray:
    bits = flags_or_bits if isinstance(flags_or_bits, int) else (8 * len(flags_or_bits)).bit_length() - 1
    return (hashes >> U64(64 - bits)).astype(np.int64)


def _place_rows(width: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, gram in zip(batch.column("lang").to_pylist(), batch.column("gram").to_pylist(), strict=True):
                hashes = np.array([xxhash.xxh64_intdigest(w) for w in gram.split(b" ")], U64)
                found.append(int(_places(_hashes(lang, hashes, width), bits)[0]) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["place"])

    return run


def phrase_filter(grams: DataFrame, width: int) -> np.ndarray:
    """Flags for the phrases (lang, gram) of ``width`` words: bits that are set where one of them falls."""
    bits = min(MOST_BITS, max(FEWEST_BITS, (16 * grams.count()).bit_length()))
    places = grams.select("lang", F.col("gram").cast("binary").alias("gram")).mapInArrow(_place_rows(width, bits), "place long")
    parts = places.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    flags = np.zeros((1 << bits) // 8, np.uint8)
    for part, found in parts.collect():  # 32 MB at most
        at = (part - 1) * BITMAP_BITS // 8
        flags[at : at + BITMAP_BITS // 8] = np.frombuffer(bytes(found), np.uint8)
    return flags


def _count_flagged(length: int, width: int, tests: list[tuple[int, np.ndarray]], most: int):
    """Partial counts of the phrases of ``length`` words for which a test (place in the phrase, flags) holds for ``width`` of its words.

    The tests look at the phrase alone, so it is counted at all its places or at none.
    """

    def counted(found: dict[str, list[pa.Array]]) -> Iterator[pa.RecordBatch]:
        for lang, grams in found.items():
            sums = pa.concat_arrays(grams).value_counts()
            yield _batch(lang, sums.field("values"), sums.field("counts").to_numpy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = {}, 0
        for batch in batches:
            for lang, texts in _by_language(batch).items():
                for words, known in word_runs(texts):
                    n = len(words) - length + 1
                    if n <= 0:
                        continue
                    at, kinds, stop = _numbered(words)
                    hashes = np.fromiter(map(xxhash.xxh64_intdigest, kinds.to_numpy(zero_copy_only=False)), U64, len(kinds))
                    hashes = _hashes(lang, hashes[at], width)
                    chosen = np.zeros(n, bool)
                    for first, flags in tests:
                        own = _places(hashes[first : first + n], flags)
                        chosen |= (flags[own >> 3] >> (own & 7).astype(np.uint8)) & 1 == 1
                    stops = np.cumsum(np.append(0, at == stop))
                    chosen &= stops[length:] == stops[:n]
                    chosen[: max(0, known - length + 1)] = False
                    starts = np.flatnonzero(chosen)
                    found.setdefault(lang, []).append(_phrases([kinds.take(pa.array(at[starts + k])) for k in range(length)]))
                    size += len(starts)
            if size > most:
                yield from counted(found)
                found, size = {}, 0
        yield from counted(found)

    return run


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def _rate(a: Column, below: Column) -> Column:
    """floor(SCALE * a / below), exact beyond 64 bits."""
    return F.call_function("div", _wide(a) * F.lit(SCALE).cast("decimal(7,0)"), _wide(below))


def _part(first: Column | int, length: Column) -> Column:
    return F.array_join(F.slice("words", first if isinstance(first, Column) else F.lit(first), length), " ")


def _scored(phrases: DataFrame, counts: DataFrame, length: int) -> DataFrame:
    """``phrases`` (lang, gram, a) of ``length`` words with the lowest-scoring cut (``score``, ``l``, ``r``) and ``bound``.

    ``bound`` is what no longer phrase with this prefix can pass: cut after its first word, a phrase that begins with
    x1 ... xk and is found a' <= a times scores SCALE a' / (f(x1) + r) at most, where r >= a', and that grows with a'.
    """
    words = phrases.withColumn("words", F.split("gram", " "))
    cuts = words.select("lang", "gram", "a", "words", F.explode(F.sequence(F.lit(1), F.lit(length - 1))).alias("k"))
    cuts = cuts.select("lang", "gram", "a", "k", _part(1, F.col("k")).alias("first"), _part(F.col("k") + 1, length - F.col("k")).alias("rest"))
    for part, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("gram").alias(part), F.col("a").alias(count)), ["lang", part])
    cut = F.struct(_rate(F.col("a"), F.col("l") + F.col("r")).alias("score"), "k", "l", "r")
    best = cuts.groupBy("lang", "gram", "a").agg(F.min(cut).alias("cut"), F.max("l").alias("head"))
    # f(x1) is the largest first part.
    bound = _rate(F.col("a"), F.col("head") + F.col("a"))
    return best.select("lang", "gram", "a", "cut.l", "cut.r", "cut.score", bound.alias("bound"))


def _inside(longer: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``longest``: how often the most frequent phrase one word longer is found."""
    words = longer.withColumn("words", F.split("gram", " "))
    less = F.size("words") - 1
    parts = words.select("lang", "a", F.explode(F.array(_part(1, less), _part(2, less))).alias("gram"))
    return parts.groupBy("lang", "gram").agg(F.max("a").alias("longest"))


def _floors(pairs: DataFrame, rank: int) -> DataFrame:
    """``lang``, ``floor``: a score that about ``rank`` pairs reach, 0 where there are fewer.

    Read from counts per thousandth of the largest score: a table of at most 1001 rows a language.
    """
    steps = pairs.groupBy("lang", F.expr("score div 1000").alias("step")).count()
    reached = F.sum("count").over(Window.partitionBy("lang").orderBy(F.col("step").desc()))
    steps = steps.withColumn("reached", reached)
    return steps.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("reached") >= rank, F.col("step") * 1000)), F.lit(0).cast("long")).alias("floor"))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    best: int = 2000,
    least_count: int = 30,
    covered: int = 80,
    held_words: int = 1_000_000,
    held_phrases: int = 500_000,
) -> DataFrame:
    """The ``best`` phrases of 2 to 4 words of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z are lowered, texts split into pieces at ``.,;:!?`` and line ends and into words at blanks and tabulators. n is
    the number of words of the language, a = f(phrase) counts all contiguous places inside pieces. A phrase found
    ``least_count`` times is a candidate; cut in two, with l and r the counts of the parts, it scores
    floor(2000000 a / (l + r)), and the lowest cut counts (ties: the shortest first part). One that lies inside a longer
    candidate found at least ``covered`` percent as often is dropped. Ranked by score and count, descending, then by the phrase.

    Words and pairs are counted at first. Longer phrases are grown best-first: a phrase's counts bound the score of
    everything it is the beginning of, and only phrases whose bound reaches the floor, a score that more than ``best``
    pairs reach, are grown, together with the one-word extensions that can drop a phrase above the floor. All
    phrases at or above the floor are then known with their exact scores, ties included. Languages in which fewer than ``best``
    of them survive go on with a lower floor, at last with 0.

    Tasks count ``held_words`` words at a time, or ``held_phrases`` places of grown phrases, and Spark adds them up. Which phrases to grow is told to
    the tasks by a filter of 1 to 32 MB; what it lets through by chance is counted too and can drop a phrase inside it, but is not
    scored: its prefix keeps it below the floor, and not all of its cuts are counted.

    Null texts are empty, a null language is "und"; words may be of any length, long texts are read in stretches. Equal
    rows count each. Other columns are not read; empty tables and languages without candidates give no rows.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("binary").alias("text")
    )

    def counted(run) -> DataFrame:
        found = texts.mapInArrow(run, GRAMS).groupBy("lang", "gram").agg(F.sum("n").alias("a"))
        return found.filter((F.col("a") >= least_count) | (F.octet_length("gram") == 0)).select("lang", F.col("gram").cast("string").alias("gram"), "a")

    first = stored(counted(_count_words_and_pairs(held_words)), "words-and-pairs")
    counts = first.filter("gram <> ''")
    pairs = stored(_scored(counts.filter("contains(gram, ' ')"), counts, 2), "pairs")
    settled, rank = [], 2 * best
    floors = stored(_floors(pairs, rank), "floors")
    while not floors.isEmpty():
        top = stored(_above(pairs, counts, floors, counted, held_phrases, covered), "survivors")
        enough = top.groupBy("lang").count().filter(F.col("count") >= best).select("lang", F.lit(True).alias("enough"))
        state = stored(floors.join(enough, "lang", "left"), "settled-languages")
        settled.append(top.join(state.filter("floor = 0 OR enough").select("lang"), "lang", "left_semi"))
        rank *= 8
        left = state.filter("floor > 0 AND enough IS NULL").select("lang")
        floors = stored(_floors(pairs.join(left, "lang", "left_semi"), rank), "floors")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("gram")]
    if not settled:
        settled = [_above(pairs, counts, floors, counted, held_phrases, covered)]
    rows = reduce(DataFrame.unionByName, settled).withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(64)))
    # A language's first ranks are among the first of its parts.
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= best)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= best)
    words = first.filter("gram = ''").select("lang", F.col("a").alias("n"))
    return rows.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), F.col("gram").alias("phrase"), "a", "l", "r", "n", "score")


def _above(pairs: DataFrame, counts: DataFrame, floors: DataFrame, counted, held: int, covered: int) -> DataFrame:
    """All phrases of the languages in ``floors`` that score ``floor`` or more and are not dropped: ``lang``, ``gram``, ``a``, ``l``, ``r``, ``score``."""
    level, found, extensions = pairs.join(floors, "lang"), [], []
    for length in range(3, LONGEST + 1):
        found.append(level.filter("score >= floor"))
        # Grown: what can reach the floor. Tested: the extensions to the left of what has reached it.
        grown = phrase_filter(level.filter("bound >= floor"), length - 1)
        tested = phrase_filter(level.filter("score >= floor"), length - 1)
        longer = counted(_count_flagged(length, length - 1, [(0, grown), (1, tested)], held))
        longer = stored(longer, f"phrases-{length}")
        extensions.append(longer)
        if length > 3:
            counts = _with_rests(longer, counts, level, counted, length, held)
        counts = stored(counts.unionByName(longer), "counts") if length < LONGEST else counts
        # Only what the grown ones begin has the counts of all its cuts; all others score below the floor.
        reach = level.filter("bound >= floor").select("lang", F.col("gram").alias("first"))
        first = longer.withColumn("words", F.split("gram", " ")).withColumn("first", _part(1, F.lit(length - 1)))
        level = _scored(first.join(reach, ["lang", "first"], "left_semi").select("lang", "gram", "a"), counts, length)
        level = stored(level.join(floors, "lang"), f"scored-{length}")
    found.append(level.filter("score >= floor"))
    longest = reduce(DataFrame.unionByName, [_inside(e) for e in extensions])
    kept = reduce(DataFrame.unionByName, found).join(longest, ["lang", "gram"], "left")
    return kept.filter(f"longest IS NULL OR 100 * longest < {covered} * a").select("lang", "gram", "a", "l", "r", "score")


def _with_rests(longer: DataFrame, counts: DataFrame, level: DataFrame, counted, length: int, held: int) -> DataFrame:
    """``counts`` with those of the phrases that are left without the first word, where they were not grown themselves."""
    words = longer.withColumn("words", F.split("gram", " "))
    less = F.lit(length - 1)
    rests = words.select("lang", _part(1, less).alias("first"), _part(2, less).alias("gram"))
    rests = rests.join(level.filter("bound >= floor").select("lang", F.col("gram").alias("first")), ["lang", "first"], "left_semi")
    missing = stored(rests.select("lang", "gram").distinct().join(counts, ["lang", "gram"], "left_anti"), "missing-rests")
    if missing.isEmpty():
        return counts
    flags = phrase_filter(missing, length - 1)
    more = counted(_count_flagged(length - 1, length - 1, [(0, flags)], held)).join(counts, ["lang", "gram"], "left_anti")
    return stored(counts.unionByName(more), "counts")
