"""Words and shingles of many texts at once, as numpy arrays."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=U64)
BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(int(BASE), -1, 2**64))
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, *range(9, 14)]] = True
_POWERS = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS[kind]
    if len(have) < n:
        step = np.full(max(n, 2 * len(have)), BASE if kind == "up" else _INVERSE, U64)
        step[0] = 1
        _POWERS[kind] = have = np.multiply.accumulate(step)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one line feed after each, and where each text begins (one more entry at the end)."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b"\n".join(parts) + b"\n", np.uint8), starts


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash per word (A-Z lower-cased) and how many words come before each text.

    A word's hash is the polynomial of its bytes, taken from running sums, so no word is cut out one by one.
    """
    space = IS_SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    first, last = edge[0::2], edge[1::2]
    codes = BYTE_CODES[_LOWERED[data]]
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(codes * _powers("up", len(data)), out=sums[1:])
    words = mixed((sums[last] - sums[first]) * _powers("down", len(data) + 1)[first] + (last - first).astype(U64))
    return words, np.searchsorted(first, starts)


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, concatenated, and where each set begins.

    A text of fewer words than ``width`` has its whole sequence as one shingle, one without words an empty set.
    """
    data, starts = joined(texts)
    words, bounds = word_hashes(data, starts)
    counts = np.diff(bounds)
    runs = np.zeros(max(0, len(words) - width + 1), U64)
    for k in range(width):
        runs = runs * BASE + words[k : k + len(runs)]
    runs = mixed(runs)
    sets, sizes = [], np.zeros(len(counts) + 1, np.int64)
    for i, (at, n) in enumerate(zip(bounds[:-1].tolist(), counts.tolist(), strict=True)):
        if n >= width:
            found = np.sort(runs[at : at + n - width + 1])
            found = found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif n:
            found = np.array([n], U64)
            for k in range(at, at + n):
                found = found * BASE + words[k : k + 1]
            found = mixed(found)
        else:
            found = words[:0]
        sets.append(found)
        sizes[i + 1] = len(found)
    return np.concatenate(sets) if sets else runs[:0], np.cumsum(sizes)


def slices(texts: list[str | None], most: int = 500_000) -> list[slice]:
    """Cuts a batch so that each part holds about ``most`` characters, or one longer text."""
    cuts, size = [0], 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            cuts.append(i + 1)
            size = 0
    if cuts[-1] < len(texts):
        cuts.append(len(texts))
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
