"""Language ID: a byte-level bidirectional GRU labels every position, a document's probabilities are their mean."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.gru import ByteGru

WINDOW = 128  # bytes the network reads at a time, from a fresh state
TRAIN_WINDOW = 64
WINDOWS_AT_ONCE = 1024
UNKNOWN = "und"


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def _windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (time, windows), the mask of real bytes, and the first window of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts) + bytes(width), np.uint8)
    counts = np.maximum(1, -(-lengths // width))
    firsts = np.concatenate(([0], np.cumsum(counts)))
    nth = np.arange(firsts[-1]) - np.repeat(firsts[:-1], counts)
    starts = np.repeat(np.cumsum(lengths) - lengths, counts) + nth * width
    sizes = np.clip(np.repeat(lengths, counts) - nth * width, 0, width)
    mask = np.arange(width)[:, None] < sizes[None, :]
    return np.where(mask, data[starts[None, :] + np.arange(width)[:, None]], 0).astype(np.uint8), mask, firsts


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, seed: int) -> list[tuple[str, bytes]]:
    """(language, bytes) of a hashed sample: of each language the ``per_language`` documents with the least draws.

    Only draws below a bound that ``per_language`` documents stay under but for odds of a billion to one are compared.

    From each document four stretches of ``TRAIN_WINDOW`` characters, spread over its whole length.
    """
    ident, text, lang = F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.col(f"`{lang_col}`")
    usable = docs.filter(ident.isNotNull() & ~held_out(ident) & lang.isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(lang.alias("lang")).agg(F.count("*")).limit(1001).collect()}
    if len(counts) > 1000:
        raise ValueError("more than 1000 languages")
    if not counts:
        return []
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), ident), 1)
    most = per_language + 6 * math.isqrt(per_language) + 40
    share = F.coalesce(*[F.when(lang == k, F.lit(min(2**63 - 1, 2**63 * most // n))) for k, n in counts.items()])
    picked = usable.filter((draw < share) & text.rlike(r"\p{L}"))
    at = [(F.floor((F.char_length(text) - TRAIN_WINDOW) * k / 3) + 1).cast("int") for k in range(4)]
    cuts = F.array_distinct(F.array(*[F.substring(text, F.greatest(a, F.lit(1)), F.lit(TRAIN_WINDOW)) for a in at]))
    picked = picked.select(lang.alias("lang"), cuts.alias("cuts"), draw.alias("draw"))
    order = Window.partitionBy("lang").orderBy("draw", "cuts")
    rows = picked.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_language).collect()
    return [(r["lang"], c.encode()) for r in sorted(rows, key=lambda r: (r["lang"], r["draw"], r["cuts"])) for c in r["cuts"] if c]


def train(rows: list[tuple[str, bytes]], hidden: int = 8, steps: int = 300, seed: int = 0) -> tuple[list[str], ByteGru] | None:
    """The languages and the network; None without rows."""
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    x, mask, firsts = _windows([t for _, t in rows], TRAIN_WINDOW)
    y = np.repeat([languages.index(lang) for lang, _ in rows], np.diff(firsts))
    model = ByteGru(len(languages), hidden, seed)
    model.fit(x, y, mask, steps, seed=seed)
    return languages, model


def classify(model: ByteGru, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: the label, its pooled probability and the share of positions that carry the label."""
    x, mask, firsts = _windows(texts, WINDOW)
    pooled, votes = np.zeros((x.shape[1], model.labels)), np.zeros((x.shape[1], model.labels))
    for at in range(0, x.shape[1], WINDOWS_AT_ONCE):
        part = slice(at, at + WINDOWS_AT_ONCE)
        probs, _ = model.probabilities(np.ascontiguousarray(x[:, part]))
        inside = mask[:, part]
        pooled[part] = np.einsum("tln,tn->nl", probs, inside.astype(np.float32))
        best = probs.argmax(axis=1)
        for label in range(model.labels):
            votes[part, label] = ((best == label) & inside).sum(axis=0)
    by_text = lambda a: np.add.reduceat(a, firsts[:-1], axis=0)
    pooled, votes = by_text(pooled), by_text(votes)
    total = np.maximum(1, by_text(mask.sum(axis=0).astype(float)))
    label = pooled.argmax(axis=1)
    at = np.arange(len(label))
    return label, np.clip(pooled[at, label] / total, 0, 1), votes[at, label] / total


def identify_language(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    hidden: int = 8,
    steps: int = 300,
    seed: int = 0,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score``, ``agreement`` and the columns in ``keep``.

    The network learns from text and label of rows that are not held out: a hashed sample of ``per_language``
    documents a language. A prediction sees the text's bytes only, all of them, in windows of
    128. ``score`` is the mean probability of the winning language over all positions, ``agreement`` the share of
    positions that name it.

    Null text, empty text and text without a letter are "und" with score 0, as is everything when no row is
    labelled. A null id is not held out and not learned from; rows that repeat are each labelled. Ties go to
    the language that sorts first. A kept column named like one of these gets the suffix "_in". Other columns are
    not read; an empty table gives no rows.
    """
    found = train(training_rows(docs, id_col, text_col, lang_col, per_language, seed), hidden, steps, seed)
    text = F.col(f"`{text_col}`")
    own = {"held_out", "lang_pred", "score", "agreement", "__id", "__bytes"}
    renamed = [f"{c}_in" if c in own else c for c in keep]
    rows = docs.select(
        F.to_json(F.struct(F.col(f"`{id_col}`").alias("v"))).alias("__id"),
        held_out(F.col(f"`{id_col}`")).alias("held_out"),
        F.when(text.rlike(r"\p{L}"), text.cast("binary")).alias("__bytes"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, renamed, strict=True)],
    )
    names = ["__id", "held_out", *renamed]
    types = ", ".join(f"`{n}` {t}" for n, t in rows.select(*names).dtypes)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["__bytes"].tolist()
            out = batch[names].copy()
            langs, scores, agreed = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if t] if found else []
            first = 0
            while first < len(at):  # about half a MB of text at a time
                last, size = first, 0
                while last < len(at) and size < 2**19:
                    size += len(texts[at[last]])
                    last += 1
                part = at[first:last]
                best, score, share = classify(found[1], [texts[i] for i in part])
                for i, b in zip(part, best, strict=True):
                    langs[i] = found[0][b]
                scores[part], agreed[part] = np.round(score, 6), np.round(share, 6)
                first = last
            out["lang_pred"], out["score"], out["agreement"] = langs, scores, agreed
            yield out

    labelled = rows.mapInPandas(label, f"{types}, lang_pred string, score double, agreement double")
    kind = docs.schema[id_col].dataType.simpleString()
    restored = F.from_json("__id", f"v {kind}")["v"].alias(id_col)
    return labelled.select(restored, *labelled.columns[1:])
