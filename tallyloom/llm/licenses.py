"""License scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance from directories."""

from __future__ import annotations

import math
from collections import Counter

import regex  # for the letters of any script, as in the column expressions
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.session import checkpointed

TOKEN = r"\p{L}+|[0-9]+(?:\.[0-9]+)*"
LICENCE_FILE = r"(?i)^(?:licen[cs]es?|copying|copyright|notice|unlicense)(?:[.-][^/]*)?$"
# Short forms of public licences: what a header, a notice line or the head of a licence file says.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    **{
        f"GPL-{v}.0": [
            f"This work is licensed under the GNU General Public License, version {v}.",
            f"SPDX-License-Identifier: GPL-{v}.0",
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
            f"License as published by the Free Software Foundation; either version {v} of the License, or (at your option) any later version.",
        ]
        for v in (2,)
    },
    **{
        f"LGPL-{v}": [
            f"This work is licensed under the GNU Lesser General Public License, version {v}.",
            f"SPDX-License-Identifier: LGPL-{v}",
            "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
            f"License as published by the Free Software Foundation; either version {v.removesuffix('.0')} of the License, or (at your option) any later version.",
        ]
        for v in ("2.0", "2.1", "3.0")
    },
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-2-Clause": [
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ],
    "Unlicense": [
        "SPDX-License-Identifier: Unlicense",
        "This is free and unencumbered software released into the public domain.",
    ],
    "CC0-1.0": [
        "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "BSD-3-Clause": [
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ],
    "MPL-2.0": [
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    **{
        f"CC-BY{short}-{v}": [
            f"Licensed under CC BY{short} {v}.",
            f"SPDX-License-Identifier: CC-BY{short}-{v}",
            f"This work is licensed under a Creative Commons Attribution{long} {v} International License.",
        ]
        for v in ("4.0", "3.0", "2.0")
        for short, long in (("", ""), ("-SA", "-ShareAlike"), ("-ND", "-NoDerivatives"), ("-NC", "-NonCommercial"), ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives"))
        if (short, v) != ("-NC", "4.0")
    },
    "EPL-2.0": ["SPDX-License-Identifier: EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."],
    "Zlib": ["SPDX-License-Identifier: Zlib", "Released under the zlib License."],
    "BSL-1.0": ["SPDX-License-Identifier: BSL-1.0", "Distributed under the Boost Software License, Version 1.0."],
    **{
        f"GFDL-{v}": [
            f"SPDX-License-Identifier: GFDL-{v}",
            "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation "
            f"License, Version {v} or any later version published by the Free Software Foundation",
        ]
        for v in ("1.2", "1.3")
    },
}
# Short statements and the titles of whole licence texts.
for name in ("MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "ISC", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0"):
    TEMPLATES[name].append(f"License: {name}")
for name, texts in {
    "MIT": ["MIT licensed", "This project is MIT licensed."],
    "LGPL-2.0": ["This work is licensed under the GNU Library General Public License, version 2."],
    "Apache-2.0": ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "GPL-2.0": ["Licensed under GPLv2.", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": ["Licensed under GPLv3.", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.1": ["Licensed under LGPLv2.1.", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": ["Licensed under LGPLv3.", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0": ["Licensed under AGPLv3.", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
}.items():
    TEMPLATES[name] += texts
# Licence expressions: known identifiers joined by OR and AND, with exceptions and brackets, after the identifier tag or on a line.
KNOWN_ID = "(?:" + "|".join(sorted((regex.escape(n) for n in TEMPLATES), key=len, reverse=True)) + r")(?:-only|-or-later|\+)?"
EXCEPTION = r"[ \t]+WITH[ \t]+[A-Za-z0-9.-]+"
TERM = rf"\(*{KNOWN_ID}(?:{EXCEPTION})?\)*"
EXPRESSION = rf"(?m)(?:SPDX-License-Identifier:[ \t]*|^[ \t]*(?:License:[ \t]*)?)({TERM}(?:[ \t]+(?:OR|AND)[ \t]+{TERM})+|{KNOWN_ID}{EXCEPTION})[ \t]*(?:\*/|-->)?[ \t\r]*$"

# What tells near relatives apart: a unit states the licence only if it has a word of each list of the first item and
# none of the second.
NC, SA, ND = ["nc", "noncommercial", "commercial"], ["sa", "sharealike", "alike"], ["nd", "noderivatives", "noderivs", "derivatives"]
# A mark of two words: "this library" says nothing, the Library General Public License does.
LIBRARY = "library general"
OTHER_GNU = ["lesser", LIBRARY, "affero", "lgpl", "lgplv", "agpl", "agplv", "fdl"]
GNU = ["gpl", "gplv", "general"]
LICENSED = ["license", "licensed", "licence", "licenced", "charge"]
MARKS: dict[str, tuple[list[list[str]], list[str]]] = {
    "MIT": ([["mit", "charge"], LICENSED], ["isc", "apache", "bsd", "gpl", "x11"]),
    "ISC": ([["isc", "fee"]], ["mit", "charge"]),
    "Apache-2.0": ([["apache"], ["2", "2.0"]], ["1.0", "1.1"]),
    "MPL-2.0": ([["mpl", "mozilla"], ["2", "2.0"]], ["1.0", "1.1"]),
    "GPL-2.0": ([GNU, ["2", "2.0"]], [*OTHER_GNU, "3", "3.0"]),
    "GPL-3.0": ([GNU, ["3", "3.0"]], [*OTHER_GNU, "2", "2.0"]),
    "LGPL-2.0": ([["lgpl", "lgplv", "lesser", LIBRARY], ["2", "2.0"]], ["affero", "2.1", "3", "3.0"]),
    "LGPL-2.1": ([["lgpl", "lgplv", "lesser"], ["2.1"]], ["affero", "3", "3.0"]),
    "LGPL-3.0": ([["lgpl", "lgplv", "lesser"], ["3", "3.0"]], ["affero", "2.1", "2", "2.0"]),
    "AGPL-3.0": ([["agpl", "agplv", "affero"], ["3", "3.0"]], ["1", "1.0"]),
    "BSD-2-Clause": ([["bsd", "redistribution"]], ["3", "4", "0"]),
    "BSD-3-Clause": ([["bsd", "redistribution"]], ["2", "4", "0"]),
    "EPL-2.0": ([["epl", "eclipse"], ["2", "2.0"]], ["1", "1.0"]),
    "Zlib": ([["zlib"], LICENSED], []),
    "BSL-1.0": ([["bsl", "boost"], ["1", "1.0"]], ["1.1"]),
    **{f"GFDL-{v}": ([["gfdl", "documentation"], [v]], []) for v in ("1.2", "1.3")},
    "Unlicense": ([["unlicense", "unencumbered"]], []),
    "CC0-1.0": ([["cc", "waived"]], ["by", "attribution"]),
    **{
        f"CC-BY{''.join(f'-{n}' for n in names)}-{v}": (
            [["by", "attribution"], [v], *(words for n, words in (("NC", NC), ("SA", SA), ("ND", ND)) if n in names)],
            [w for n, words in (("NC", NC), ("SA", SA), ("ND", ND)) if n not in names for w in words],
        )
        for v in ("4.0", "3.0", "2.0")
        for names in ((), ("SA",), ("ND",), ("NC",), ("NC", "SA"), ("NC", "ND"))
    },
}
# The clause that two of the BSD licences differ by stands further down than their head: it is looked for in the whole file.
CLAUSE = r"(?i)\bendorse\s+or\s+promote\b"
SENTENCE_END = r"(?<=[.!?])(?<!\b[vV]\.)\s+|\n[ \t\r]*\n"


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def template_vectors(templates: dict[str, list[str]], counts: dict[str, int], files: int) -> tuple[list[tuple[str, dict[str, float]]], dict[str, float]]:
    """(licence, unit vector) of each template, and the idf of each word of a template."""
    idf = {w: math.log((files + 1) / (counts.get(w, 0) + 1)) + 1 for w in vocabulary(templates)}
    vectors = []
    for license_, texts in sorted(templates.items()):
        for text in texts:
            weights = {w: n * idf[w] for w, n in Counter(regex.findall(TOKEN, text.lower())).items()}
            norm = math.sqrt(sum(x * x for x in weights.values()))
            vectors.append((license_, {w: x / norm for w, x in weights.items()}))
    return vectors, idf


def vocabulary(templates: dict[str, list[str]]) -> list[str]:
    return sorted({t for texts in templates.values() for text in texts for t in regex.findall(TOKEN, text.lower())})


def _map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair])


def own_licenses(files: DataFrame, templates: dict[str, list[str]], least: float) -> DataFrame:
    """``__row``, ``license``, ``score`` of the files (``__row``, ``__text``) that state a licence themselves.

    Units are the lines, the paragraphs and the sentences of the whole text. A unit that lacks what ``MARKS`` asks of a
    licence does not state it, however close it is to a template. Document frequencies count all files; a word in no
    template weighs as one that no file has. Vectors are sparse: a unit keeps its template words, each with its
    count, and the number of other words. A file, and then a unit, is looked at closely only if its template words
    could reach ``least`` even with no other word beside them, which leaves out no match. Only hits shuffle.
    """
    known = F.array(*[F.lit(w) for w in vocabulary(templates)])
    seen = files.select(F.array_intersect(_tokens(F.col("__text")), known).alias("seen"))
    counted = seen.select(F.explode_outer("seen").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    counts = {r["term"]: r["n"] for r in counted.collect() if r["term"] is not None}  # at most one row per template word
    total = files.count()
    vectors, idf = template_vectors(templates, counts, total)
    strange = math.log(total + 1) + 1

    most = _map({w: max(v.get(w, 0.0) for _, v in vectors) ** 2 for w in idf})
    reach = lambda text: F.aggregate(F.array_intersect(_tokens(text), known), F.lit(0.0), lambda a, t: a + most[t])
    close = files.filter(reach(F.col("__text")) >= least * least)
    parts = F.array_distinct(F.concat(F.split("__text", r"\n"), F.split("__text", r"\n[ \t\r]*\n"), F.split("__text", SENTENCE_END)))
    clause = F.col("__text").rlike(CLAUSE).alias("clause")
    units = close.select("__row", clause, F.explode_outer(parts).alias("unit")).filter(reach(F.col("unit")) >= least * least)
    asked = F.array(*[F.lit(w) for w in sorted({w for groups, bad in MARKS.values() for ws in (*groups, bad) for w in ws})])
    library = F.when(F.lower("unit").rlike(r"library\s+general"), F.array(F.lit(LIBRARY))).otherwise(F.array().cast("array<string>"))
    units = units.select("__row", "clause", library.alias("phrases"), _tokens(F.col("unit")).alias("tokens"))
    counted_words = F.transform(
        F.array_intersect("tokens", known), lambda t: F.struct(t.alias("term"), F.size(F.filter("tokens", lambda x: x == t)).alias("tf"))
    )
    units = units.select("__row", "clause", F.concat(F.array_intersect("tokens", asked), "phrases").alias("marks"), F.size("tokens").alias("n"), counted_words.alias("known"))
    rarity = _map(idf)
    weighted = F.transform("known", lambda k: F.struct(k["term"].alias("term"), k["tf"].alias("tf"), (k["tf"] * rarity[k["term"]]).alias("x")))
    units = units.select("__row", "clause", "marks", "n", weighted.alias("known"))
    others = F.col("n") - F.aggregate("known", F.lit(0), lambda a, k: a + k["tf"])
    square = F.aggregate("known", F.lit(0.0), lambda a, k: a + k["x"] * k["x"])
    units = units.select("__row", "clause", "marks", "known", F.sqrt(square + others * strange**2).alias("norm"))

    def cosine(vector: dict[str, float]) -> Column:
        weight = _map(vector)
        dot = F.aggregate("known", F.lit(0.0), lambda a, k: a + k["x"] * F.coalesce(F.try_element_at(weight, k["term"]), F.lit(0.0)))
        return F.round(dot / F.col("norm"), 6)

    def stated(name: str, vector: dict[str, float]) -> Column:
        groups, bad = MARKS.get(name, ([], []))
        holds = F.lit(True)
        for words in groups:
            holds = holds & F.arrays_overlap("marks", F.array(*[F.lit(w) for w in words]))
        if bad:
            holds = holds & ~F.arrays_overlap("marks", F.array(*[F.lit(w) for w in bad]))
        if name in ("BSD-2-Clause", "BSD-3-Clause") and "redistribution" in vector:
            holds = holds & (F.col("clause") if name == "BSD-3-Clause" else ~F.col("clause"))
        return holds

    scores = F.array(*[F.when(stated(name, v), F.struct((-cosine(v)).alias("minus"), F.lit(name).alias("license"))) for name, v in vectors])
    # The limit comes after the aggregate: pushed below, it would compute all of the above once more, word by word.
    best = units.select("__row", F.array_min(scores).alias("best")).groupBy("__row").agg(F.min("best").alias("best"))
    best = best.filter(F.col("best.minus") <= -least)
    best = best.select("__row", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("score"))
    said = expressions(files)
    return best.join(said, "__row", "left_anti").unionByName(said)


def expressions(files: DataFrame) -> DataFrame:
    """``__row``, ``license``, ``score`` (1) of files that state a licence expression: their first one, with single blanks.

    All its identifiers are known ones; brackets that do not pair make it none.
    """
    text = F.col("__text")
    likely = text.contains(" OR ") | text.contains(" AND ") | text.contains(" WITH ")
    first = F.regexp_replace(F.nullif(F.regexp_extract("__text", EXPRESSION, 1), F.lit("")), r"[ \t]+", " ")
    said = files.filter(likely).select("__row", first.alias("license")).filter("license IS NOT NULL")
    paired = F.regexp_count("license", F.lit(r"\(")) == F.regexp_count("license", F.lit(r"\)"))
    return said.filter(paired).distinct().withColumn("score", F.lit(1.0))


def license_scan(files: DataFrame, path_col: str = "path", text_col: str = "text", keep: tuple[str, ...] = (), templates: dict[str, list[str]] | None = None, least: float = 0.75) -> DataFrame:
    """One row per row of ``files``: ``keep``, path, ``license``, ``score``, ``origin`` and ``licence_dir``.

    A file that states a licence itself has it: a licence expression of known identifiers, or else the template with the largest cosine, from ``least`` on, over its
    lines, paragraphs and sentences (ties: the licence that sorts first); ``origin`` is "file" for a licence file by its name,
    else "header". Any other file takes the licence of the nearest directory above it whose licence file states
    one (several in a directory: the best score, then name); ``origin`` is "inherited". Else all four are null.
    Inheritance joins distinct directories with their ancestors, so a directory with a third of all files is one
    row there, and its files then look their directory up.

    A null text or path states or inherits nothing; paths are split at "/". Rows that repeat are scanned once and
    share the result. Other columns are not read; an empty table gives no rows.
    """
    templates = templates or TEMPLATES
    rows = files.select(*[F.col(f"`{c}`").alias(f"__keep{i}") for i, c in enumerate(keep)], F.col(f"`{path_col}`").alias("__path"), F.col(f"`{text_col}`").alias("__text"))
    rows = rows.withColumn("__row", F.xxhash64("__path", "__text")).withColumn("__dir", F.regexp_replace("__path", r"/?[^/]*$", ""))
    own = checkpointed(own_licenses(rows.select("__row", "__text"), templates, least))
    rows = rows.drop("__text").join(own, "__row", "left")
    rows = checkpointed(rows.withColumn("__file", F.coalesce(F.regexp_extract("__path", r"[^/]*$", 0).rlike(LICENCE_FILE), F.lit(False))))

    given = rows.filter("__file AND license IS NOT NULL").groupBy("__dir").agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"))
    given = checkpointed(given.select(F.col("__dir").alias("above"), F.col("best.license").alias("heir"), (-F.col("best.minus")).alias("heir_score")))
    wanting = rows.filter("license IS NULL AND __dir IS NOT NULL").select("__dir").distinct()
    names = F.split("__dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(names)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(names, 1, k), "/").alias("above")))
    steps = wanting.select("__dir", F.explode_outer(above).alias("step")).select("__dir", "step.depth", "step.above")
    nearest = steps.join(given, "above").groupBy("__dir").agg(F.max(F.struct("depth", "above", "heir", "heir_score")).alias("near"))
    nearest = checkpointed(nearest.select("__dir", "near.above", "near.heir", "near.heir_score"))
    full = rows.join(nearest, "__dir", "left")
    stated = F.col("license").isNotNull()
    return full.select(
        *[F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)],
        F.col("__path").alias(path_col),
        F.coalesce("license", "heir").alias("license"),
        F.coalesce("score", "heir_score").alias("score"),
        F.when(stated & F.col("__file"), "file").when(stated, "header").when(F.col("heir").isNotNull(), "inherited").alias("origin"),
        F.when(stated & F.col("__file"), F.col("__dir")).when(~stated, F.col("above")).alias("licence_dir"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """``documents`` as a tree of files: by source, language and id; ids divisible by 25 are licence files of the levels above."""
    number = F.col("doc_id")
    top = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    shelf = F.concat_ws("/", top, F.floor(number / 1000).cast("string"))
    path = (
        F.when(number % 500 == 0, F.concat_ws("/", F.coalesce("source", F.lit("none")), F.lit("LICENSE")))
        .when(number % 100 == 0, F.concat_ws("/", top, F.lit("LICENSE")))
        .when(number % 25 == 0, F.concat_ws("/", shelf, F.lit("COPYING")))
        .otherwise(F.concat_ws("/", shelf, F.floor(number / 100).cast("string"), F.concat(F.lit("doc-"), number.cast("string"), F.lit(".txt"))))
    )
    return docs.select("doc_id", path.alias("path"), "text")
