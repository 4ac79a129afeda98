"""Collocations, ranked search and line dedup against brute force, with odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyloom.llm import collocations as phrases
from tallyloom.llm.collocations import collocations
from tallyloom.llm.common import ready
from tallyloom.llm.line_dedup import line_dedup
from tallyloom.llm.ranked_search import BallTree, best_first, ranked_search, terms

LOWERED = {k: k + 32 for k in range(65, 91)}
# Names that the operators use for columns of their own.
SCHEMA = "doc_id long, text string, lang string, n long, term string, key string, rank int, drops int"


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    ready(spark)


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0, "x", "y", 1, 2) for i, t, lang in rows], SCHEMA)


# Collocations


def _collocations(rows, best, least):
    counts, out = defaultdict(Counter), []
    for text, lang in rows:
        own = counts[lang or "und"]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWERED)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, own in counts.items():
        n = sum(c for g, c in own.items() if len(g) == 1)
        candidates = {g: a for g, a in own.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in candidates.items():
            score, _, left, right = min((2_000_000 * a // (own[g[:k]] + own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g)))
            inside = lambda h, g=g: any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
            if not any(len(h) > len(g) and 100 * b >= 80 * a and inside(h) for h, b in candidates.items()):
                rows.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, g, left, right) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n, -score))
    return sorted(out)


def _prose(rng, n, words=12):
    vocabulary = [f"{c}{d}" for c in "abcdefghijkl" for d in "xyz"][:words] + ["É", "ü", "É-é"]
    return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(n))


@pytest.mark.parametrize("best,least", [(2000, 3), (5, 3), (3, 8), (1, 2)])
def test_collocations(spark, best, least):
    rng = random.Random(best)
    rows = [(_prose(rng, rng.randint(0, 120)), rng.choice(["en", "de", None])) for _ in range(60)]
    rows += [("New York City Council met", "en")] * 9 + [("new york city", "en")] * 2 + [("again and again and again and again", "fr")] * 3
    rows += [(None, "en"), ("", None), ("...,,", "de"), ("one", "it")]
    got = collocations(_frame(spark, [(k, t, lang) for k, (t, lang) in enumerate(rows)]), best=best, least_count=least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == _collocations(rows, best, least)


def test_collocations_go_on_with_a_lower_floor(spark):
    """Most pairs above the first floor are dropped for longer phrases, so the floor has to sink."""
    rng = random.Random(4)
    rows = [(" ".join(f"{k}{c}" for c in "abcd"), "en") for k in range(40) for _ in range(4)]
    rows += [(_prose(rng, 80, 30), "en") for _ in range(20)]
    got = collocations(_frame(spark, [(k, t, lang) for k, (t, lang) in enumerate(rows)]), best=60, least_count=3)
    assert sorted(tuple(r) for r in got.collect()) == _collocations(rows, 60, 3)


def test_collocations_of_nothing(spark):
    assert collocations(_frame(spark, [])).collect() == []
    assert collocations(_frame(spark, [(1, None, None), (2, "", "en"), (3, "a b", "en")])).collect() == []


def test_collocations_small_counters(spark):
    rng = random.Random(9)
    rows = [(_prose(rng, 90), "en") for _ in range(40)]
    got = collocations(_frame(spark, [(k, t, lang) for k, (t, lang) in enumerate(rows)]), least_count=3, held_words=50, held_phrases=10)
    assert sorted(tuple(r) for r in got.collect()) == _collocations(rows, 2000, 3)


def test_collocations_that_a_full_filter_lets_through(spark, monkeypatch):
    """Four-word phrases grown by chance, of whose cuts some are not counted, must not enter the list."""
    plain, rng = phrases.phrase_filter, np.random.default_rng(1)
    monkeypatch.setattr(
        phrases, "phrase_filter", lambda grams, width: plain(grams, width) | (rng.integers(0, 256, 1 << 20, np.uint8) & rng.integers(0, 256, 1 << 20, np.uint8))
    )
    rows = [(f"u{k} v{k}", "en") for k in range(30)] * 3
    for k in range(60):
        rows += [(f"a{k} b{k} c{k} d{k}", "en")] * 4 + [(f"a{k}, b{k}, c{k}, d{k}, " * 50, "en")]
    got = collocations(_frame(spark, [(k, t, lang) for k, (t, lang) in enumerate(rows)]), best=12, least_count=3)
    assert sorted(tuple(r) for r in got.collect()) == _collocations(rows, 12, 3)


@pytest.mark.parametrize("most", [1, 7, 40, 1000])
def test_long_texts_are_cut_without_losing_a_phrase(most):
    text = ("ab cd. ef gh ij kl mn, op  qr\tst " + "x" * 50 + " uv " * 9).encode()
    found = Counter()
    for words, known in phrases.word_runs([text, b"yz", None], most):
        words = words.to_pylist()
        for k in range(1, 5):
            grams = [tuple(words[i : i + k]) for i in range(len(words) - k + 1) if i + k > known]
            found.update(g for g in grams if phrases.STOP not in g)
    want = Counter()
    for piece in re.split(rb"[.,]", text) + [b"yz"]:
        words = piece.split()
        for k in range(1, 5):
            want.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    assert found == want


def test_scores_are_exact_beyond_64_bits(spark):
    a = 9_000_000_000_000_017
    one = spark.createDataFrame([(a, 2 * a + 1)], "a long, s long")
    assert one.select(phrases._rate(one.a, one.s)).first()[0] == 2_000_000 * a // (2 * a + 1)


# Ranked search


def _ranked(docs, items, k=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    split = lambda t: pattern.findall((t or "").translate(LOWERED))
    bags = [(i, Counter(split(t))) for i, t in docs]
    df = Counter(t for _, bag in bags for t in bag)
    full = sum(bool(bag) for _, bag in bags)
    total = sum(sum(bag.values()) for _, bag in bags)
    out = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            score = 0
            for t in set(split(text)) & set(bag):
                m = 10 + 90 * sum(bag.values()) * full // total
                score += math.floor(1000 * math.log((2 * full + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def _search(spark, docs, items, **options):
    frame = _frame(spark, [(i, t, "x") for i, t in docs])
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, id int, query string")
    got = ranked_search(frame, asked, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"leaf": 2, "tree_rows": 16}, {"tree_entries": 40, "leaf": 1}, {"block_bytes": 100}])
def test_ranked_search(spark, options):
    rng = random.Random(3)
    docs = [(k, _prose(rng, rng.randint(0, 60), 30)) for k in range(150)]
    docs += [(1000 - k, "same words, same score") for k in range(25)] + [(7, "same words"), (7, "same words")]
    docs += [(None, "same words, same score"), (None, None), (2000, None), (2001, ""), (2002, "..!"), (2003, "unique")]
    items = [(k, _prose(rng, 8, 30)) for k in range(12)]
    items += [(50, "Same WORDS"), (51, "unique same"), (52, None), (53, ""), (54, "nowhere"), (None, "ax"), (50, "ax by")]
    assert _search(spark, docs, items, **options) == _ranked(docs, items)


def test_ranked_search_of_nothing(spark):
    assert _search(spark, [], [(1, "a")]) == []
    assert _search(spark, [(1, "a")], []) == []
    assert _search(spark, [(1, None), (2, "")], [(1, "a")]) == []


def test_ranked_search_long_text(spark):
    long = "word " * 400_000 + "needle " + "é" * 1_500_000 + " tail"
    docs = [(1, long), (2, "needle in a haystack"), (3, "word word")]
    assert _search(spark, docs, [(1, "needle word tail")]) == _ranked(docs, [(1, "needle word tail")])


@pytest.mark.parametrize("piece", [1, 5, 1000])
def test_terms_piece_by_piece(piece):
    text = "Ab c9-éÉ_x\x7fy ÄÖ zz".encode()
    assert [t for part in terms(text, piece) for t in part] == ["ab", "c9", "éÉ", "x", "y", "ÄÖ", "zz"] or [
        t.decode() for part in terms(text, piece) for t in part
    ] == ["ab", "c9", "éÉ", "x", "y", "ÄÖ", "zz"]


@pytest.mark.parametrize("seed", range(8))
def test_bounds_are_never_below_a_score(seed):
    """Large, equal, tiny and zero values: each ball's bound covers every vector in it, and the search equals a scan."""
    rng = np.random.default_rng(seed)
    n, width = int(rng.integers(1, 120)), int(rng.integers(1, 40))
    sizes = rng.integers(1, width + 1, n)
    dims = np.concatenate([np.sort(rng.permutation(width)[:s]) for s in sizes])
    high = int(rng.choice([2, 1000, 30_000_000_000]))
    values = rng.integers(0, high, len(dims))
    if seed % 2:  # many equal vectors
        sizes, dims, values = np.repeat(sizes[:1], n), np.tile(dims[: sizes[0]], n), np.tile(values[: sizes[0]], n)
    tree = BallTree(np.append(0, np.cumsum(sizes)), dims, values, width + 1, leaf=int(rng.integers(1, 9)))
    full = np.zeros((n, width + 1), np.int64)
    full[np.repeat(np.arange(n), sizes), dims] = values
    queries = [np.sort(rng.permutation(width + 1)[: rng.integers(1, width + 1)]) for _ in range(9)]
    bounds = tree.bounds(np.concatenate(queries), np.append(0, np.cumsum([len(q) for q in queries])[:-1]))
    for q, own in enumerate(queries):
        scores = full[:, own].sum(axis=1)
        assert all(bounds[node, q] >= scores[rows].max() for node, rows in enumerate(tree.rows))
        top = []
        best_first(tree, bounds[:, q], own, list(range(n)), top, 5)
        assert sorted(top, reverse=True) == sorted(((int(s), -i) for i, s in enumerate(scores) if s > 0), reverse=True)[:5]


# Line dedup


def _line_dedup(rows, least_docs=10, least_length=1):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWERED)
    texts = [(i, (t or "").split("\n")) for i, t in rows]
    found = Counter(k for _, lines in texts for k in {key(line) for line in lines})
    gone = lambda line: len(key(line)) >= least_length and found[key(line)] >= least_docs
    return sorted(((i, len(lines), sum(map(gone, lines)), "\n".join(x for x in lines if not gone(x))) for i, lines in texts), key=str)


@pytest.mark.parametrize("least_docs,least_length", [(10, 1), (2, 1), (3, 4), (3, 0)])
def test_line_dedup(spark, least_docs, least_length):
    rng = random.Random(least_docs)
    pool = ["Header", "  header\t", "FOOTER\r", "footer", "é", "É", "abc", "", "  ", "unique {}", "x\x0by", "0", "1", "٣", "a "]
    rows = [(k, "\n".join(rng.choice(pool).format(rng.random()) for _ in range(rng.randint(0, 9)))) for k in range(40)]
    rows += [(None, "header\nmine"), (None, "header\nother"), (None, None), (5, ""), (5, "\n\n"), (6, "header"), (6, "header"), (7, "own\nown\nown")]
    got = line_dedup(_frame(spark, [(i, t, "x") for i, t in rows]), least_docs=least_docs, least_length=least_length)
    assert got.columns == ["doc_id", "text", "lang", "n", "term", "key", "rank", "drops", "n_lines", "n_dropped", "kept_text"]
    found = sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str)
    assert found == _line_dedup(rows, least_docs, least_length)


def test_line_dedup_leaves_rare_lines_alone(spark):
    """One document repeating a line does not make it frequent."""
    text = "\n".join(["same"] * 50)
    got = line_dedup(_frame(spark, [(1, text, "x"), (2, "same", "x")])).collect()
    assert [(r["n_dropped"], r["kept_text"]) for r in sorted(got)] == [(0, text), (0, "same")]


def test_line_dedup_of_nothing(spark):
    assert line_dedup(_frame(spark, [])).collect() == []


def test_line_dedup_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a", 5, 6, "k")], "doc_id int, text string, n_lines int, row int, kept_text string")
    row = line_dedup(docs).first().asDict()
    assert row == {"doc_id": 1, "text": "a", "n_lines_in": 5, "row": 6, "kept_text_in": "k", "n_lines": 1, "n_dropped": 0, "kept_text": "a"}


def test_line_dedup_of_a_very_long_document(spark):
    """Looking a position up takes constant time: 300 000 lines, half of them dropped."""
    lines = [f"line {k}" for k in range(150_000)]
    rows = [(1, "\n".join(x for pair in zip(lines, [f"own {k}" for k in range(150_000)]) for x in pair)), (2, "\n".join(lines))]
    got = {r["doc_id"]: r for r in line_dedup(_frame(spark, [(i, t, "x") for i, t in rows]), least_docs=2).collect()}
    assert got[1]["n_dropped"] == got[2]["n_dropped"] == 150_000
    assert got[2]["kept_text"] == "" and got[1]["kept_text"].split("\n") == [f"own {k}" for k in range(150_000)]
