"""Words, shingles, signatures, the byte network and the difference cover against plain Python."""

import random
import re

import numpy as np
import pytest

from tallyloom.llm import cover_sort, text_arrays as ta
from tallyloom.llm.gru import ByteGru
from tallyloom.llm.near_dedup import signatures
from tallyloom.llm.suffix_dedup import GRAM, Block

TEXTS = ["", None, "one", "One TWO", "a b c d a b c", " \t lead and trail \n", "Ünï cödé Ünï cödé", "x" * 5000, "\x0bvt\x0bvt\x0bvt", "a b c d a b c"]


def _sets(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


@pytest.mark.parametrize("width", [1, 3, 5])
def test_shingles(width):
    sets, bounds = ta.shingle_sets(TEXTS, width)
    got = [set(sets[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    want = [_sets(t, width) for t in TEXTS]
    assert [len(g) for g in got] == [len(w) for w in want]
    for i in range(len(TEXTS)):
        for j in range(len(TEXTS)):
            assert len(got[i] & got[j]) == len(want[i] & want[j])


def test_shingles_do_not_depend_on_the_batch():
    whole, bounds = ta.shingle_sets(TEXTS, 3)
    for i, text in enumerate(TEXTS):
        alone, _ = ta.shingle_sets([text], 3)
        assert alone.tolist() == whole[bounds[i] : bounds[i + 1]].tolist()


def test_signature_estimates_similarity():
    a = [f"w{k}" for k in range(400)]
    b = a[:350] + [f"v{k}" for k in range(50)]
    sets, bounds = ta.shingle_sets([" ".join(a), " ".join(b), ""], 3)
    signed = signatures(sets, bounds, 400)
    x, y = set(sets[: bounds[1]].tolist()), set(sets[bounds[1] : bounds[2]].tolist())
    assert abs((signed[0] == signed[1]).mean() - len(x & y) / len(x | y)) < 0.1
    assert (signed[2] == 0xFFFFFFFF).all()


def test_slices_cover_everything():
    parts = ta.slices(["ab"] * 7 + ["c" * 50], most=4)
    assert [i for p in parts for i in range(8)[p]] == list(range(8))
    assert ta.slices([]) == []


def test_gradients():
    """Backpropagation through time against finite differences."""
    rng = np.random.default_rng(0)
    model = ByteGru(3, hidden=3, seed=1)
    x, y, mask = rng.integers(97, 110, (6, 4)).astype(np.uint8), np.array([0, 1, 2, 1]), np.ones((6, 4), bool)
    mask[4:, 1] = False
    _, grads = model.gradients(x, y, mask)
    for name, value in model.params.items():
        for _ in range(6):
            at = tuple(int(rng.integers(0, n)) for n in value.shape)
            if name.startswith("in_"):
                at = (at[0], int(x.ravel()[rng.integers(0, x.size)]))
            old, sides = value[at], []
            for step in (1e-2, -1e-2):
                value[at] = old + step
                sides.append(model.gradients(x, y, mask)[0])
            value[at] = old
            assert abs((sides[0] - sides[1]) / 2e-2 - grads[name][at]) < 2e-3


def test_cover_is_complete():
    period = cover_sort.PERIOD
    assert {(a - b) % period for a in cover_sort.COVER for b in cover_sort.COVER} == set(range(period))


@pytest.mark.parametrize("seed", range(6))
def test_equal_windows(seed):
    rng = random.Random(seed)
    n, width, length = rng.randint(1, 40), 93, 50
    base = [bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(3)]
    rows, first, last = np.zeros((n, width), np.uint8), np.zeros(n, int), np.zeros(n, int)
    for i in range(n):
        at = rng.randint(0, 30)
        rows[i, :74] = np.frombuffer((rng.choice(base) * 3)[at : at + 74], np.uint8)
        first[i], last[i] = rng.randint(0, 10), rng.randint(10, 24)
    got = {}
    for k, (at, group) in enumerate(cover_sort.equal_windows(rows, first, last, length, most=50)):
        got |= {int(a): (k, int(g)) for a, g in zip(at, group, strict=True)}
    flat, want = rows.tobytes(), {}
    for i in range(n):
        for c in range(first[i], last[i] + 1):
            want.setdefault(flat[i * width + c : i * width + c + length], set()).add(i * width + c)
    assert {frozenset(v) for v in want.values()} == {frozenset(a for a in got if got[a] == g) for g in set(got.values())}


def test_suffix_ranks_are_suffix_order():
    rng = random.Random(5)
    rows = np.array([[rng.choice(b"ab") for _ in range(93)] for _ in range(12)], np.uint8)
    words = cover_sort._words(rows)
    ranks = cover_sort.cover_ranks(rows, words)
    at = [p for p in range(rows.size) if ranks[p] >= 0]
    assert all(cover_sort.IN_COVER[p % 93 % 31] for p in at)
    suffix = lambda p: rows[p // 93, p % 93 :].tobytes()
    order = sorted(at, key=lambda p: (suffix(p), p))
    values = [ranks[p] for p in order]
    assert values == sorted(values)
    assert all((ranks[a] == ranks[b]) == (suffix(a) == suffix(b)) for a, b in zip(order, order[1:], strict=False))


@pytest.mark.parametrize("texts", [
    [b"", b"a" * 49, b"a" * 50, b"a" * 200, b"ab" * 90],
    [b"abcdefghijklmnopqrstuvwxyz0123456789" * 4, b"xy" * 10, b"abcdefghijklmnopqrstuvwxyz0123456789" * 4 + b"!"],
])
def test_every_window_has_one_anchor_that_its_content_decides(texts):
    block = Block(np.arange(len(texts)), texts, 50)
    seen, where = {}, {}
    for anchor, first, last, gram in zip(block.anchor, block.first, block.last, block.gram, strict=True):
        for p in range(first, last + 1):
            assert p not in seen and 0 <= anchor - p <= 50 - GRAM
            seen[p] = (int(anchor - p), int(gram))
            assert where.setdefault(block.data[p : p + 50].tobytes(), seen[p]) == seen[p]
    want = [a + k for a, t in zip(block.bounds, texts, strict=False) for k in range(len(t) - 49)]
    assert sorted(seen) == want
