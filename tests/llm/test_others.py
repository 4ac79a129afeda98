"""Mixing, WARC, licence scans, tool calls and language ID on small and odd inputs."""

import hashlib
import json
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import licenses
from tallyloom.llm.common import ready
from tallyloom.llm.language_id import identify_language
from tallyloom.llm.mixing import mix
from tallyloom.llm.tool_calls import EVENT, conversation_events, link_tool_calls
from tallyloom.llm.warc import _header_text, _plain_text, archive_pages, lookup, parse_record, read_tasks, record, url_key, write_archives, build_index
from tallyloom.session import fresh_path


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    ready(spark)


# --- mixing


def _fill(nodes, budget):
    """Water filling by definition: nodes name -> (weight, capacity)."""
    open_, quota = {n: wc for n, wc in nodes.items() if wc[0] > 0}, dict.fromkeys(nodes, 0)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if c * total <= budget * w]
        if not full:
            return quota | {n: budget * w // total for n, (w, _) in open_.items()}
        for n in full:
            quota[n] = open_.pop(n)[1]
            budget -= quota[n]
    return quota


def _brute_mix(rows, weights, share, epochs, seed):
    leaves = defaultdict(list)
    for i, domain, lang, text in rows:
        leaves[(domain or "(none)", lang or "(none)")].append((i, len((text or "").split())))
    tokens = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()}
    weight = lambda level, v: weights[level].get(v, weights[level].get(None, 0)) if level in weights else 1
    usable = {leaf: n * epochs for leaf, n in tokens.items() if weight("domain", leaf[0]) and weight("lang", leaf[1])}
    top = defaultdict(int)
    for leaf, cap in usable.items():
        top[leaf[0]] += cap
    by_domain = _fill({d: (weight("domain", d), c) for d, c in top.items()}, sum(tokens.values()) * share[0] // share[1])
    out = []
    for d, quota in by_domain.items():
        by_lang = _fill({leaf[1]: (weight("lang", leaf[1]), c) for leaf, c in usable.items() if leaf[0] == d}, quota)
        for lang, q in by_lang.items():
            usable[(d, lang)] = q
    for leaf, docs in leaves.items():
        q = usable.get(leaf, 0)
        full = q // tokens[leaf] if tokens[leaf] else 0
        head, through = q - full * tokens[leaf], 0
        key = lambda r: (hashlib.md5(f"{seed}:{full}:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])  # noqa: B023,E731
        for i, n in sorted(docs, key=key):
            through += n
            out.append((i, *leaf, n, q, full + (head > 0 and through <= head)))
    return sorted(out, key=str)


MIX_ROWS = [(k, "web" if k % 3 else "books", ["en", "de", "fr"][k % 5 % 3], "w " * (k % 11)) for k in range(120)] + [
    (500, None, "en", "a b"), (501, "web", None, "a"), (None, "web", "en", "a b c"), (502, "web", "en", None), (502, "web", "en", ""), (503, "rare", "en", "x " * 4000),
]


@pytest.mark.parametrize("share, epochs", [((1, 2), 4), ((3, 1), 2), ((1, 100), 1), ((0, 1), 3), ((50, 1), 2)])
@pytest.mark.parametrize("weights", [{"domain": {"web": 70, "books": 30}, "lang": {"en": 5, "de": 3, "fr": 1}}, {}, {"lang": {"xx": 1}}, {"lang": {"en": 6, None: 2}, "domain": {None: 1}}])
def test_mix(spark, share, epochs, weights):
    docs = spark.createDataFrame([(*r, 1) for r in MIX_ROWS], "doc_id long, domain string, lang string, text string, tokens int")
    levels = {"domain": F.col("domain"), "lang": F.col("lang")}
    got = mix(docs, levels, weights, share, epochs, seed=5).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute_mix(MIX_ROWS, weights, share, epochs, 5)


def test_mix_without_broadcast(spark):
    docs = spark.createDataFrame(MIX_ROWS, "doc_id long, domain string, lang string, text string")
    levels = {"domain": F.col("domain"), "lang": F.col("lang")}
    got = mix(docs, levels, {}, (1, 2), 2, broadcast_rows=0).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute_mix(MIX_ROWS, {}, (1, 2), 2, 0)


def test_mix_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, domain string, lang string, text string")
    assert mix(docs, {"domain": F.col("domain")}, {}).collect() == []


# --- WARC


def test_url_key():
    assert url_key("https://www.Example.com:443/a/b?x=1#frag") == "com,example)/a/b?x=1"
    assert url_key("http://blog.example.org") == "org,example,blog)/"
    assert url_key("http://example.org:8080/") == "org,example:8080)/"
    assert url_key(None) == url_key("") == "" and url_key("no url") == ")no url" and url_key("http://[bad") == ")http://[bad"


@pytest.mark.parametrize("url", ["http://x/a\r\nInjected: 1", "http://x/100%25", None, "", "é\x00"])
def test_record_round_trip(url):
    payload = b"\r\n\r\nWARC/1.1\r\n" + bytes(range(256))
    digest = hashlib.sha1(payload).hexdigest()
    full, again = parse_record(record(7, url, payload, digest, None)), parse_record(record(8, url, payload, digest, 7))
    assert full["payload"] == payload and full["intact"] and full["uri"] == url and full["record_type"] == "response"
    assert again["payload"] is None and again["refers_to"] == 7 and again["payload_bytes"] == len(payload) and again["payload_digest"] == digest
    assert parse_record(record(None, url, b"", "00", None))["intact"] is False
    assert _plain_text(_header_text("a%0D\n")) == "a%0D\n"


PAGES = [(k, f"http://h{k % 3}.example.com/p{k % 7}", ("copy " * 300) if k % 4 == 0 else f"page {k} é") for k in range(60)] + [
    (100, None, "a" * 1000), (101, "", "a" * 1000), (101, "", "a" * 1000), (102, "x", None), (103, "x", ""), (None, "http://n/", "a" * 1000), (None, "y", "b" * 2000), (104, "z", "a" * 999),
]


def test_archive_pages(spark):
    pages = spark.createDataFrame([(*p, "key") for p in PAGES], "page_id long, url string, html string, digest string")
    got = archive_pages(pages, parts=3).collect()
    want = []
    for i, url, html in PAGES:
        data = (html or "").encode()
        ids = [j for j, _, h in PAGES if (h or "").encode() == data and j is not None]
        latest = max(ids, default=None) if len(data) >= 1000 else None
        refers = latest if latest is not None and latest != i else None
        want.append((url, i, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers, None if refers is not None else data, True))
    rows = [(r["uri"], r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"]), r["intact"]) for r in got]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_lookup_finds_only_what_was_asked(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    archives, index = fresh_path(spark, "warc"), fresh_path(spark, "cdx")
    entries = write_archives(pages, archives, archive_bytes=2000, broadcast_rows=0)
    directory = build_index(entries, index, 4, block_entries=5)
    assert directory.agg(F.sum("entries")).first()[0] == len(PAGES) and directory.count() > 8
    asked = spark.createDataFrame([("http://www.h1.example.com/p1",), ("http://nowhere/",), (None,), ("http://h1.example.com/p1",)], "url string")
    found = {r["page_id"] for r in lookup(spark, asked, directory, index, archives).collect()}
    assert found == {i for i, u, _ in PAGES if url_key(u) in (url_key("http://h1.example.com/p1"), "")}
    with pytest.raises(ValueError):
        lookup(spark, asked, directory, index, archives, most_parts=1)


def test_record_reads_are_dealt_by_bytes(spark):
    hits = spark.range(1000).select(F.lit("a").alias("archive"), (F.col("id") * 10**6).alias("offset"), F.lit(10**6).cast("long").alias("length"))
    assert read_tasks(hits) == 15 and read_tasks(hits, 10**8) == 10 and read_tasks(hits.limit(0)) == 1


def test_archive_empty(spark):
    assert archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# --- licences


def _brute_licenses(files, least):
    tokens = lambda t: re.findall(r"[^\W\d_]+|[0-9]+(?:\.[0-9]+)*", (t or "").lower())
    known = {w for texts in licenses.TEMPLATES.values() for t in texts for w in tokens(t)}
    counts = Counter(w for _, t in files for w in set(tokens(t)) & known)
    idf = lambda w: math.log((len(files) + 1) / (counts[w] + 1)) + 1
    vectors = []
    for name, texts in licenses.TEMPLATES.items():
        for t in texts:
            v = {w: n * idf(w) for w, n in Counter(tokens(t)).items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            vectors.append((name, {w: x / norm for w, x in v.items()}))
    own = []
    for _, text in files:
        best = None
        for unit in set((text or "").split("\n")) | set(re.split(r"\n[ \t\r]*\n", text or "")):
            tf = Counter(tokens(unit))
            norm = math.sqrt(sum((n * idf(w)) ** 2 if w in known else n * (math.log(len(files) + 1) + 1) ** 2 for w, n in tf.items()))
            for name, v in vectors:
                score = round(sum(n * idf(w) * v.get(w, 0) for w, n in tf.items()) / norm, 6) if norm else 0
                if score >= least and (best is None or (-score, name) < best):
                    best = (-score, name)
        own.append(best)
    dirs = {}
    for (path, _), best in zip(files, own, strict=True):
        folder, _, base = (path or "").rpartition("/")
        if best and re.match(licenses.LICENCE_FILE, base) and (folder not in dirs or best < dirs[folder]):
            dirs[folder] = best
    out = []
    for (path, _), best in zip(files, own, strict=True):
        folder, _, base = (path or "").rpartition("/")
        if best:
            out.append((path, best[1], "file" if path and re.match(licenses.LICENCE_FILE, base) else "header"))
            continue
        at = folder if path is not None else None
        while at is not None and at not in dirs:
            at = at.rpartition("/")[0] if "/" in at else ("" if at else None)
        out.append((path, dirs[at][1], "inherited") if at is not None else (path, None, None))
    return out


FILES = [
    ("LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("a/x.py", "# Licensed under the Apache License, Version 2.0.\nprint(1)"), ("a/y.py", "nothing here"), ("a/b/COPYING.txt", "some words\nThis work is licensed under the GNU General Public License, version 3.\nmore"),
    ("a/b/c/d/z.py", "the of and this"), ("a/b/c/e.py", None), ("top.py", ""), ("c/LICENSE", "no licence at all"), ("c/f.py", "x"), (None, "Released under the MIT License."), (None, None),
    ("a/y.py", "nothing here"), ("d/LICENSE", "Licensed under CC BY-NC 4.0."), ("d/COPYING", "Released under the MIT License."), ("d/g", "the license"), ("e/h.py", "Released under the terms of some other license by somebody else entirely."),
]


def test_license_scan(spark):
    files = spark.createDataFrame([(p, t, 1, "x") for p, t in FILES], "path string, text string, score int, license string")
    got = licenses.license_scan(files).collect()
    assert sorted(((r["path"], r["license"], r["origin"]) for r in got), key=str) == sorted(_brute_licenses(FILES, 0.75), key=str)
    by_path = {r["path"]: r for r in got}
    assert by_path["a/b/c/d/z.py"]["licence_dir"] == "a/b" and by_path["c/f.py"]["license"] == "MIT"


def test_license_scan_empty(spark):
    files = spark.createDataFrame([], "path string, text string")
    assert licenses.license_scan(files).collect() == []


GPL = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {} License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n{}"
STATED = [
    (GPL.format("General Public", 2), "GPL-2.0"), (GPL.format("General Public", 3), "GPL-3.0"), (GPL.format("Affero General Public", 3), "AGPL-3.0"), (GPL.format("Lesser General Public", "2.1"), "LGPL-2.1"),
    ("SPDX-License-Identifier: GPL-2.0", "GPL-2.0"), ("SPDX-License-Identifier: LGPL-3.0", "LGPL-3.0"), ("SPDX-License-Identifier: AGPL-3.0", "AGPL-3.0"), ("SPDX-License-Identifier: ISC", "ISC"),
    ("SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"), ("SPDX-License-Identifier: EUPL-1.2", None),
    (BSD.format("Redistributions of source code must retain the above notice."), "BSD-2-Clause"), (BSD.format("Neither the name of the holder may be used to endorse or promote products."), "BSD-3-Clause"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-SA 3.0.", "CC-BY-SA-3.0"),
    ("This work is licensed under the GNU General Public License, version 1.", None), ("Licensed under the Apache License, Version 1.1.", None),
    ("A tool for many uses and for many users. Released under the MIT License. It was written long ago, and it has been in use at several places since.", "MIT"),
]


# What ordinary statements say; an expression with an unknown identifier says nothing.
ORDINARY = [
    ("This library is licensed under GPLv3.", "GPL-3.0"), ("License: MIT", "MIT"), ("MIT licensed", "MIT"), ("SPDX-License-Identifier: EPL-2.0", "EPL-2.0"),
    ("SPDX-License-Identifier: Zlib", "Zlib"), ("// SPDX-License-Identifier: BSL-1.0", "BSL-1.0"), ("Licensed under CC BY 2.0.", "CC-BY-2.0"),
    ("Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no Invariant Sections.", "GFDL-1.3"),
    ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", "Apache-2.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone is permitted to copy and distribute verbatim copies", "GPL-3.0"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0-only WITH Classpath-exception-2.0"), ("MIT OR Apache-2.0", "MIT OR Apache-2.0"),
    ("/* SPDX-License-Identifier: (MIT  AND BSD-3-Clause) OR GPL-2.0+ */\nint x;", "(MIT AND BSD-3-Clause) OR GPL-2.0+"), ("SPDX-License-Identifier: MIT OR Other-9", None),
    ("License: Apache-2.0", "Apache-2.0"), ("The code is MIT licensed.", "MIT"), ("Distributed under the Boost Software License, Version 1.0. (See accompanying file)", "BSL-1.0"),
    ("This program is licensed under the GNU Library General Public License, version 2.", "LGPL-2.0"), ("mit", None), ("Es geht mit ihm OR mit ihr.", None), ("(MIT OR Apache-2.0", None),
]


def test_license_scan_of_ordinary_wordings(spark):
    files = spark.createDataFrame([(f"{k}/x", t) for k, (t, _) in enumerate(ORDINARY)], "path string, text string")
    got = {r["path"]: r["license"] for r in licenses.license_scan(files).collect()}
    wrong = [(t, want, got[f"{k}/x"]) for k, (t, want) in enumerate(ORDINARY) if got[f"{k}/x"] != want]
    stated = [t for t, want in ORDINARY if want]
    assert len(wrong) <= 0.1 * len(stated) and all(found is None for _, _, found in wrong), wrong


def test_license_scan_near_relatives(spark):
    files = spark.createDataFrame([(f"{k}/x", t) for k, (t, _) in enumerate(STATED)], "path string, text string")
    got = {r["path"]: r["license"] for r in licenses.license_scan(files).collect()}
    assert [(t, got[f"{k}/x"]) for k, (t, _) in enumerate(STATED)] == STATED


# --- tool calls

SCHEMAS = {
    "add": {"a": {"type": "integer", "required": True, "minimum": 0}, "b": {"type": "number"}, "how": {"type": "string", "enum": ["fast", "slow"]}},
    "list": {"items": {"type": "array", "required": True}, "flag": {"type": "boolean"}, "more": {"type": "object"}},
}


def _link(spark, events):
    rows = [(*e, *[None] * (7 - len(e))) for e in events]
    schema = "conv_id long, turn long, kind string, call_id string, name string, payload string, needs array<string>"
    frame = spark.createDataFrame(rows, schema).select(*EVENT, F.lit(1).alias("row"), F.lit("x").alias("status"))
    return link_tool_calls(frame, SCHEMAS)


@pytest.mark.parametrize("name, payload, errors", [
    ("add", '{"b": 1.5, "a": 3}', ""), ("add", '{"b": 1}', "missing:a"), ("add", '{"a": "3"}', "type:a"), ("add", '{"a": -1, "how": "odd"}', "minimum:a,enum:how"),
    ("add", '{"a": 1, "z": 2}', "unknown:z"), ("add", "[1]", "arguments"), ("add", "no json", "arguments"), ("add", None, "arguments"), ("other", "{}", "tool"), (None, "{}", "tool"),
    ("list", '{"items": [1, "2"], "flag": true, "more": {}}', ""), ("list", '{"items": {}, "flag": 1, "more": []}', "type:items,type:flag,type:more"), ("add", '{"a": null}', "type:a"),
])
def test_arguments(spark, name, payload, errors):
    got = _link(spark, [(1, 0, "call", "c", name, payload), (1, 1, "result", "c", None, "done")]).collect()
    call = next(r for r in got if r["kind"] == "call")
    assert call["errors"] == errors and call["status"] == ("invalid" if errors else "ok")


def test_canonical_json(spark):
    got = _link(spark, [(1, 0, "call", "c", "add", '{ "b": {"y": [1, 2 ], "x": "é\\n\\"" } , "a": 1 }'), (1, 1, "result", "c", None, 'say "é"')])
    text = {r["kind"]: r["json"] for r in got.collect()}
    assert text["call"] == '{"arguments":{"a":1,"b":{"x":"é\\n\\"","y":[1,2]}},"call_id":"c","kind":"call","name":"add"}'
    assert text["result"] == '{"call_id":"c","content":"say \\"é\\"","kind":"result"}'


def test_links_and_order(spark):
    events = [
        (1, 0, "message", None, None, "hello"), (1, 5, "call", "a", "add", '{"a":1}'), (1, 2, "result", "a", None, "late"), (1, 3, "call", "b", "add", '{"a":1}', ["a"]),
        (1, 4, "result", "b", None, "x"), (1, 6, "result", "b", None, "again"), (1, 7, "result", "zz", None, "lost"), (1, 8, "call", "d", "add", '{"a":1}', ["nope"]),
        (2, 0, "call", "a", "add", '{"a":1}'), (2, 1, "call", "a", "add", '{"a":2}'), (2, 2, "call", "e", "add", '{"a":1}'), (2, 2, "call", "e", "add", '{"a":1}'),
        (3, 0, "call", "p", "add", '{"a":1}', ["q"]), (3, 1, "call", "q", "add", '{"a":1}', ["p"]), (3, 2, "message", None, None, None), (3, 9, "result", "q", None, "r"),
        (None, 0, "call", "n", "add", '{"a":1}'), (None, None, "result", "n", None, "r"), (None, 3, "call", None, "add", '{"a":1}'),
    ]
    rows = _link(spark, events).collect()
    assert len(rows) == len(events) - 1
    status = lambda conv: {(r["turn"], r["call_id"], r["status"]) for r in rows if r["conv_id"] == conv}
    assert status(1) == {(0, None, "ok"), (5, "a", "ok"), (2, "a", "ok"), (3, "b", "ok"), (4, "b", "ok"), (6, "b", "duplicate"), (7, "zz", "orphan"), (8, "d", "invalid")}
    assert status(2) >= {(0, "a", "unanswered"), (1, "a", "duplicate"), (2, "e", "unanswered")}
    assert {r["status"] for r in rows if r["conv_id"] == 3 and r["call_id"]} == {"cycle"}
    order = [(r["kind"], r["call_id"]) for r in sorted((r for r in rows if r["conv_id"] == 1), key=lambda r: (r["step"], r["turn"]))]
    assert order.index(("call", "a")) < order.index(("result", "a")) < order.index(("call", "b")) < order.index(("result", "b"))
    assert [r["step"] for r in rows if r["conv_id"] == 2] == [r["turn"] for r in rows if r["conv_id"] == 2]


def test_ties_go_to_the_least_payload(spark):
    call = lambda n, conv=1, turn=0, name="add": (conv, turn, "call", "a", name, f'{{"a":{n}}}')
    # In turn: least arguments, least name, null arguments first, a hot id; a null in another field is another event.
    events = [call(3), call(2), call(1), call(1), call(0, turn=1)]
    events += [call(1, 2, name="list"), call(9, 2), call(5, 3), (3, 0, "call", "a", "add", None), (3, 1, "result", "a", None, "z"), (3, 1, "result", "a", None, "y")]
    events += [call(n, 4) for n in range(10, 80)] + [(5, 0, "message", None, "x", "p"), (5, 0, "message", "x", None, "p"), (None, None, "call", "n", None, "2"), (None, None, "call", "n", None, "1")]
    got = _link(spark, events).collect()
    assert len(got) == len(set(events))
    first = sorted((r["conv_id"] or 0, r["kind"], r["json"]) for r in got if r["status"] in ("unanswered", "ok", "invalid") and r["kind"] != "message")
    begins = lambda n: f'{{"arguments":{{"a":{n}}},"call_id":"a","kind":"call","name":"add"}}'
    want = [
        (0, "call", '{"arguments":1,"call_id":"n","kind":"call"}'), (1, "call", begins(1)), (2, "call", begins(9)),
        (3, "call", '{"call_id":"a","kind":"call","name":"add"}'), (3, "result", '{"call_id":"a","content":"y","kind":"result"}'), (4, "call", begins(10)),
    ]
    assert first == want
    assert {r["json"] for r in got if r["conv_id"] == 5} == {'{"content":"p","kind":"message","name":"x"}', '{"call_id":"x","content":"p","kind":"message"}'}


def test_tool_calls_empty(spark):
    assert _link(spark, []).collect() == []


def test_conversation_events(spark):
    talk = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "short answer"), (1, 2, "user", None), (1, 3, "assistant", None), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r for r in conversation_events(talk).collect()}
    assert got[1]["kind"] == "call" and json.loads(got[1]["payload"]) == {"limit": 2, "query": "short answer"}
    assert got[2]["call_id"] == got[1]["call_id"] == "1:1" and got[3]["needs"] == ["1:1"] and got[None]["kind"] == "message"


# --- language ID


def _languages(spark, extra=()):
    rows = []
    for k in range(160):
        lang, words = [("aa", "ba lo mi ta nu"), ("bb", "schr tzung ßen ähl oft")][k % 2]
        rows.append((k, " ".join(words.split()[(k * 7 + j * j) % 5] for j in range(12)), lang))
    return spark.createDataFrame([(*r, 0.5, "y") for r in [*rows, *extra]], "doc_id long, text string, lang string, score double, lang_pred string")


def test_language(spark):
    odd = [(900, None, "aa"), (901, "", "bb"), (902, "123 !? 4²", "aa"), (903, "ba lo mi " * 4000, None), (None, "schr tzung ßen", None), (904, "ba", None), (904, "ba", None)]
    docs = _languages(spark, odd)
    got = identify_language(docs, keep=("score", "lang")).collect()
    assert len(got) == docs.count()
    assert {(r["doc_id"], r["lang_pred"]) for r in got if r["doc_id"] is None or r["doc_id"] >= 900} == {
        (900, "und"), (901, "und"), (902, "und"), (903, "aa"), (None, "bb"), (904, "aa"),
    }
    right = [r["lang_pred"] == r["lang"] for r in got if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert sum(right) >= 0.95 * len(right) > 10
    assert all(0 <= r["score"] <= 1 and r["score_in"] == 0.5 for r in got)


def test_language_is_blind_to_label_source_and_id(spark):
    docs = _languages(spark)
    first = {r["doc_id"]: r["score"] for r in identify_language(docs, steps=30).collect()}
    hidden = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.col("lang")))
    assert {r["doc_id"]: r["score"] for r in identify_language(hidden, steps=30).collect()} == first


def test_language_without_labels(spark):
    docs = _languages(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in identify_language(docs).collect()} == {("und", 0.0)}
    assert identify_language(docs.limit(0)).collect() == []
