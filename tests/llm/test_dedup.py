"""Exact, near, sentence and suffix dedup, components and decontamination against brute force, with odd rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import suffix_dedup as suffix_module
from tallyloom.llm.common import ready, without
from tallyloom.llm.components import connected_components
from tallyloom.llm.decontaminate import contaminated, decontaminate
from tallyloom.llm.exact_dedup import exact_dedup
from tallyloom.llm.near_dedup import near_duplicates
from tallyloom.llm.sentence_spans import substring_dedup
from tallyloom.llm.suffix_dedup import suffix_dedup

SCHEMA = "doc_id long, text string, digest string, key string, n_shingles int"
WORDS = "the of and to in is was for on that with as by at from it his her an be".split()


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    ready(spark)


def _frame(spark, pairs):
    """Documents with further columns named like those the operators use."""
    return spark.createDataFrame([(i, t, "x", "y", 0) for i, t in pairs], SCHEMA)


def _text(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


def _near_copies(seed, groups=4, copies=6):
    """Texts around common originals, edited so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    out, ident = [], 1
    for _ in range(groups):
        words = _text(rng, 120).split()
        for _ in range(copies):
            changed = list(words)
            for _ in range(rng.randint(0, 6)):
                changed[rng.randrange(len(changed))] = rng.choice(WORDS)
            out.append((ident, " ".join(changed)))
            ident += 1
    return out


def _shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def _components(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


ODD = [(90, None), (91, ""), (92, "   "), (93, "One two"), (94, "one TWO"), (95, "x" * 300), (None, "one two"), (None, None), (96, "É é"), (96, "other words")]


def test_exact_dedup(spark):
    pairs = ODD + [(k, "Hot text") for k in range(200)] + [(300, "Hot text"), (300, "Hot text"), (97, "é É")]
    got = exact_dedup(_frame(spark, pairs)).collect()
    norm = lambda t: (t or "").translate({k: k + 32 for k in range(65, 91)})
    assert len(got) == len(pairs)
    want = []
    for i, t in pairs:
        ids = [j for j, u in pairs if norm(u) == norm(t)]
        keep = max((j for j in ids if j is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    order = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)


def test_exact_dedup_beyond_the_broadcast_bound(spark):
    pairs = [(k, f"text {k % 7}" if k % 3 else f"own {k}") for k in range(300)]
    docs = _frame(spark, pairs)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(exact_dedup(docs, broadcast_bytes=0, bits_per_row=1)) == key(exact_dedup(docs))


@pytest.mark.parametrize("seed", [1])
def test_near_duplicates(spark, seed):
    pairs = _near_copies(seed) + [p for p in ODD if p[0] is not None and p[0] != 96] + [(200 + k, _text(random.Random(9), 100)) for k in range(30)]
    got = {r["doc_id"]: r for r in near_duplicates(_frame(spark, pairs), width=3, percent=85).collect()}
    sets = {i: _shingles(t, 3) for i, t in pairs}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = _components(sets, edges)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in got.items())


@pytest.mark.parametrize("block_rows", [7])
def test_near_duplicates_in_one_large_bucket(spark, block_rows):
    """Many different texts that share bands: links that do not touch the first pivot are found too."""
    rng = random.Random(4)
    core = _text(rng, 60).split()
    pairs = []
    for k in range(90):  # a chain: neighbours are similar, the ends are not
        core = list(core)
        core[(k * 7) % len(core)] = f"n{k}"
        pairs.append((k, " ".join(core)))
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(_frame(spark, pairs), width=1, percent=80, block_rows=block_rows).collect()}
    sets = {i: _shingles(t, 1) for i, t in pairs}
    edges = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert got == _components(sets, edges)


def test_near_duplicates_null_and_repeated_ids(spark):
    got = near_duplicates(_frame(spark, ODD), broadcast_rows=0).collect()
    assert len(got) == len(ODD)
    by_text = sorted(((r["doc_id"], r["component_id"]) for r in got), key=str)
    assert (None, 93) in by_text and (94, 93) in by_text and (90, 90) in by_text and (None, None) in by_text


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 30)],
    [(random.Random(k).randrange(60), random.Random(k + 500).randrange(60)) for k in range(45)],
])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == _components({n for e in real for n in e}, real)


def _brute_suffix(pairs, length):
    texts = [(2**63 if i is None else i, (t or "").encode()) for i, t in pairs]
    least = {}
    for i, t in texts:
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if least[t[p : p + length]] < i:
                gone[p : p + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((None if i == 2**63 else i, len(t), spans, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_suffix_dedup(spark, seed):
    rng = random.Random(seed)
    passages = [_text(rng, 30) for _ in range(4)] + ["ab" * 60, "é" * 80, "\x00" * 70]
    pairs = list(ODD)
    for k in range(40):
        parts = [rng.choice(passages) if rng.random() < 0.5 else _text(rng, rng.randint(1, 25)) for _ in range(rng.randint(0, 5))]
        parts = [p[rng.randint(0, 20) :] for p in parts]
        pairs.append((rng.randint(100, 130), " ".join(parts)))
    docs = _frame(spark, pairs).repartition(5)
    got = suffix_dedup(docs, block_bytes=2000, bucket_names=50, shard_entries=40).collect()
    rows = sorted(((r["doc_id"], r["n_bytes"], len(r["starts"]), bytes(r["kept"])) for r in got), key=str)
    assert rows == _brute_suffix(pairs, 50)


def test_suffix_dedup_hot_phrase(spark, tmp_path, monkeypatch):
    """A phrase in all documents with other text around it: right cuts, and no shard gets all its surroundings."""
    rng = random.Random(8)
    phrase, tails = "a phrase that everybody has used somewhere", [_text(rng, 3) for _ in range(20)]
    pairs = [(k % 500, f"{_text(rng, 12)} {phrase} {rng.choice(tails)} {_text(rng, 4)}") for k in range(600)]
    sizes, original = str(tmp_path), suffix_module._earliest

    def counting(length):
        run = original(length)

        def counted(rows):
            n = sum(len(i) // 8 for i in rows["ids"])
            with open(f"{sizes}/{rows['shard'].iloc[0]}-{n}", "w"):
                return run(rows)

        return counted

    monkeypatch.setattr(suffix_module, "_earliest", counting)
    got = suffix_dedup(_frame(spark, pairs), block_bytes=5000, shard_entries=200).collect()
    rows = sorted(((r["doc_id"], r["n_bytes"], len(r["starts"]), bytes(r["kept"])) for r in got), key=str)
    assert rows == _brute_suffix(pairs, 50) and sum(r[2] > 0 for r in rows) > 300
    assert 0 < max(int(f.name.split("-")[1]) for f in tmp_path.iterdir()) <= 400


def test_suffix_dedup_equal_blocks(spark):
    """A table united with itself, and equal rows that are blocks of several partitions: one row per row."""
    rng = random.Random(6)
    shared = _text(rng, 40)
    pairs = [(k, _text(rng, 5) + shared * (k % 2) + _text(rng, 15)) for k in range(12)]
    docs = _frame(spark, pairs)
    nulls = _frame(spark, [(None, None)])
    same = _frame(spark, [(50, "before " + shared)])
    every = docs.union(docs).union(nulls).union(nulls).union(same).union(same)
    got = suffix_dedup(every, block_bytes=10**6).collect()
    rows = sorted(((r["doc_id"], r["n_bytes"], len(r["starts"]), bytes(r["kept"])) for r in got), key=str)
    assert rows == _brute_suffix(pairs * 2 + [(None, None)] * 2 + [(50, "before " + shared)] * 2, 50)


def test_suffix_dedup_refuses_short_strings(spark):
    with pytest.raises(ValueError):
        suffix_dedup(_frame(spark, ODD), length=20)


def _span_pieces(text, reach=3, most=64):
    """Words with their blanks, and the sentences as (first, past last) word numbers, one word at a time."""
    tokens = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text or "")
    rank = []
    for t in tokens:
        ends = re.search(r"""[.!?]['")\]]*[\x20\x09-\x0D]*\Z""", t) or re.search(r"[\x0A-\x0D]", t)
        rank.append((0 if ends else 1, hashlib.md5(re.sub(r"[\x20\x09-\x0D]+\Z", "", t).encode()).hexdigest()[:14]))
    pieces, start = [], 0
    for i in range(len(tokens)):
        lowest = all(rank[i] < rank[j] for j in range(max(0, i - reach), i)) and all(rank[i] <= r for r in rank[i + 1 : i + 1 + reach])
        if lowest or i + 1 - start == most or i + 1 == len(tokens):
            pieces.append((start, i + 1))
            start = i + 1
    return tokens, pieces


def _brute_spans(pairs, length=3, least=10):
    """(n_removed, n_spans, kept text) by id, of documents with different ids."""
    seen, out = set(), {}
    for i, t in sorted(pairs):
        tokens, pieces = _span_pieces(t)
        gone = set()
        for k in range(len(pieces) - length + 1) if len(pieces) >= length else [0] if pieces else []:
            last = min(k + length, len(pieces))
            while last < len(pieces) and pieces[last - 1][1] - pieces[k][0] < least:
                last += 1
            if pieces[last - 1][1] - pieces[k][0] >= least:
                run = tuple(w.strip(" \t\n\r\x0b\x0c") for w in tokens[pieces[k][0] : pieces[last - 1][1]])
                gone |= set(range(k, last)) if run in seen else set()
                seen.add(run)
        blanks = re.match(r"[\x20\x09-\x0D]*", t or "").group()
        kept = blanks + "".join("".join(tokens[a:b]) for k, (a, b) in enumerate(pieces) if k not in gone)
        out[i] = (len(gone), sum(k - 1 not in gone for k in gone), kept)
    return out


def test_sentence_spans(spark):
    rng = random.Random(7)
    passages = [" ".join(_text(rng, rng.randint(3, 20)).capitalize() + "." for _ in range(5)) for _ in range(3)]
    passages += [_text(rng, 60), "\n".join(_text(rng, 2) for _ in range(40)), "same words " * 100]
    pairs = [p for p in ODD if p[0] not in (None, 96)]
    for k in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else _text(rng, rng.randint(1, 30)) + "!" for _ in range(rng.randint(1, 5))]
        pairs.append((100 + k, rng.choice(["", "\n \t"]) + rng.choice([" ", "\n", "\r\n\n", "\x0b\t"]).join(parts)))
    texts, want = dict(pairs), _brute_spans(pairs)
    got = {r["doc_id"]: r for r in substring_dedup(_frame(spark, pairs)).collect()}
    assert sorted(substring_dedup(_frame(spark, pairs), broadcast_rows=0).collect(), key=str) == sorted(got.values(), key=str)
    assert set(got) == set(want) and any(w[1] > 1 for w in want.values())
    for i, r in got.items():
        assert (r["n_removed"], r["n_spans"], r["kept_text"] or "") == want[i], i
        assert r["n_removed"] or r["kept_text"] == texts[i]
        assert r["digest"] == "x" and r["key"] == "y"


def test_sentence_spans_find_passages_however_they_stand(spark):
    """Passages that begin inside a sentence, and in lines of two words, go for the most part; the text around them stays."""
    rng = random.Random(11)
    pairs, passages = [], []
    for k in range(120):
        sep = [" ", "\n"][k % 2]
        words = _text(rng, 80).split()
        passage = sep.join(" ".join(words[j : j + 2]) for j in range(0, 80, 2)) if k % 2 else " ".join(words)
        around = [_text(rng, 7), _text(rng, 9), _text(rng, 12), _text(rng, 5)]
        passages.append((words, around))
        pairs += [(k, f"{around[0]} {passage} {around[1]}"), (1000 + k, f"{around[2]} {passage} {around[3]}")]
    pairs += [(5000, "\n".join(f"line {k}" for k in range(60))), (5001, "\n".join(f"line {k}" for k in range(60)))]
    got = {r["doc_id"]: r for r in substring_dedup(_frame(spark, pairs)).collect()}
    left = []
    for k, (words, around) in enumerate(passages):
        assert got[k]["n_removed"] == 0 and got[k]["kept_text"] == dict(pairs)[k]
        kept = got[1000 + k]["kept_text"].split()
        assert kept[:12] == around[2].split() and kept[-5:] == around[3].split()
        left.append(len(kept) - 17)
    assert sum(left) <= 0.3 * 80 * len(left) and sum(x > 40 for x in left) <= 2
    assert got[5001]["kept_text"] == "" and got[5000]["n_removed"] == 0


def test_sentence_spans_of_one_text_with_many_sentences(spark):
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(50_000)} is said of {rng.randrange(10**6)} here today." for _ in range(100_000))
    got = {r["doc_id"]: r for r in substring_dedup(_frame(spark, [(1, text), (2, "Before it all. " + text)])).collect()}
    assert got[1]["kept_text"] == text and len(got[2]["kept_text"]) < 200


def test_sentence_spans_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "r", "t")], "doc_id long, text string, n_removed int, row string, doc string")
    assert substring_dedup(docs).first().asDict() == {
        "doc_id": 1, "text": "a b", "n_removed_in": 5, "row": "r", "doc": "t", "n_removed": 0, "n_spans": 0, "kept_text": "a b",
    }


def test_very_long_texts(spark):
    """Ten million characters, with and without blanks."""
    docs = _frame(spark, [(1, "word " * 500_000), (2, "x" * 2_500_000), (3, "word " * 500_000), (4, "é" * 100_000 + ". " * 100_000)])
    assert exact_dedup(docs).filter("kept").count() == 3
    assert near_duplicates(docs).filter("kept").count() == 3
    assert {r["doc_id"]: len(r["kept"]) > 0 for r in suffix_dedup(docs).collect()} == {1: True, 2: True, 3: False, 4: True}
    assert {r["doc_id"]: r["n_spans"] for r in substring_dedup(docs).collect()}[3] == 1
    items = spark.createDataFrame([(1, "word word word word word word")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in contaminated(docs, items).collect()) == [1, 3]


def test_sentence_spans_null_ids(spark):
    passage = "One short sentence stands here. Another short one follows it. And the third one ends it all."
    got = substring_dedup(_frame(spark, [(None, passage), (5, passage), (5, passage), (None, None)])).collect()
    assert sorted((str(r["doc_id"]), str(r["kept_text"])) for r in got) == [("5", passage), ("5", passage), ("None", ""), ("None", "None")]


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "Short, one here"), (3, None), (4, ""), (5, "q w e r t y u i o p a s d f g h j k l z"), (None, "a null item id has words as well")]


def _holds(words, item):
    n = min(5, len(item))
    own, other = ({tuple(x[k : k + n]) for k in range(len(x) - n + 1)} for x in (item, words))
    return n > 0 and 100 * len(own & other) >= 80 * len(own)


def test_decontaminate_leaves_clean_rows_of_the_same_id(spark):
    docs = spark.createDataFrame([(None, ITEMS[0][1]), (None, "clean"), (None, None), (7, ITEMS[0][1]), (7, "clean too")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    left = decontaminate(docs, items).collect()
    assert sorted((tuple(r) for r in left), key=str) == sorted([(None, "clean"), (None, None), (7, "clean too")], key=str)


def test_contaminated(spark):
    rng = random.Random(3)
    pad = lambda n: _text(rng, n)
    near = "alpha beta gamma delta epsilon zeta eta theta iota kappa other"
    pairs = ODD + [
        (1, pad(2000) + " " + ITEMS[0][1].upper() + ". " + pad(500)), (2, pad(20) + " " + near), (3, "alpha beta gamma delta epsilon other"),
        (4, pad(9) + " short -- one, here! " + pad(9)), (5, ITEMS[4][1] + " " + ITEMS[0][1]), (6, pad(300)), (7, ITEMS[5][1]),
        (None, ITEMS[0][1]), (8, ITEMS[0][1]), (8, ITEMS[0][1]),
    ]
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, shingles int")
    docs = _frame(spark, pairs)
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = set()
    for i, t in pairs:
        for j, u in ITEMS:
            w, v = words(t), words(u)
            n = min(5, len(v))
            if n:
                own, other = ({tuple(x[k : k + n]) for k in range(len(x) - n + 1)} for x in (v, w))
                if 100 * len(own & other) >= 80 * len(own):
                    want.add((i, j, len(own), len(own & other)))
    got = [(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in contaminated(docs, items).collect()]
    assert len(got) == len(set(got)) and set(got) == want and (2, 1) in {w[:2] for w in want}
    assert {(r[0], r[1]) for r in contaminated(docs, items, broadcast_rows=0).select("doc_id", "item_id").collect()} == {w[:2] for w in want}
    left = decontaminate(docs, items)
    clean = [(i, t) for i, t in pairs if not any(_holds(words(t), words(u)) for _, u in ITEMS)]
    assert left.columns == docs.columns and {i for i, _ in clean} & {w[0] for w in want}
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(clean, key=str)


@pytest.mark.parametrize("run", [
    exact_dedup, near_duplicates, suffix_dedup, substring_dedup, lambda d: contaminated(d, d.select(F.col("doc_id").alias("item_id"), "text")),
])
def test_empty_table(spark, run):
    assert run(_frame(spark, [])).collect() == []


def test_without(spark):
    docs = _frame(spark, [(1, "a"), (None, "b"), (2, "c")])
    for bound in (10, 0):
        left = without(docs, docs.filter("doc_id IS NULL OR doc_id = 1"), {"doc_id": F.col("doc_id")}, bound)
        assert [r["text"] for r in left.collect()] == ["c"]
