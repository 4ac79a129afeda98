"""The corpus queries, each with the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.llm.collocations import collocations
from tallyloom.llm.common import ready, table
from tallyloom.llm.decontaminate import contaminated
from tallyloom.llm.exact_dedup import exact_dedup
from tallyloom.llm.language_id import identify_language
from tallyloom.llm.licenses import document_paths, license_scan
from tallyloom.llm.line_dedup import line_dedup
from tallyloom.llm.mixing import mix
from tallyloom.llm.near_dedup import near_duplicates
from tallyloom.llm.ranked_search import ranked_search
from tallyloom.llm.sentence_spans import substring_dedup
from tallyloom.llm.suffix_dedup import suffix_dedup
from tallyloom.llm.tool_calls import conversation_events, link_tool_calls
from tallyloom.llm.warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(ready(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query(
    "op7_exact_dedup",
    """
    WITH t AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
    FROM t
    """,
)
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


@query(
    "op1_benchmark_decontamination",
    r"""
    WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
               FROM documents),
    i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
          FROM benchmark),
    x AS (SELECT item_id, w, least(5, len(w)) AS size FROM i WHERE len(w) > 0),
    s AS (SELECT DISTINCT item_id, unnest([array_to_string(w[k:k + size - 1], ' ') FOR k IN range(1, len(w) - size + 2)]) AS g FROM x),
    n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id),
    t AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[k:k + size - 1], ' ') FOR k IN range(1, len(w) - size + 2)]) AS g
          FROM d, (SELECT DISTINCT size FROM x))
    SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
    FROM t JOIN s USING (g) JOIN n USING (item_id)
    GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 80
    """,
)
def op1_benchmark_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The mixture of op4 and of the pipeline: domain of each source, weights per level, share of all words.
DOMAINS = {
    "web": [f"src{k}" for k in range(8)],
    "books": [f"src{k}" for k in range(8, 14)],
    "code": [f"src{k}" for k in range(14, 20)],
}
MIX_WEIGHTS = {
    "domain": {"web": 50, "books": 30, "code": 15, "other": 5},
    # Every language that is not listed, and "(none)" for null, weighs as much as half the least listed one.
    "lang": {"en": 60, "de": 15, "fr": 15, "es": 10, None: 5},
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (3, 5), 4, 17


def mix_levels() -> dict[str, Column]:
    domain = F.coalesce(*[F.when(F.col("source").isin(names), F.lit(k)) for k, names in DOMAINS.items()], F.lit("other"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def _case(column: str, pairs: dict) -> str:
    listed = " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in pairs.items() if k is not None)
    return f"CASE {listed} ELSE {pairs.get(None, 0)} END"


def _fill(nodes: str, parents: str, name: str) -> str:
    """SQL that adds each child's quota to ``nodes`` (parents, name, capacity, weight, budget)."""
    return f"""
        SELECT *, CASE WHEN f THEN capacity ELSE (budget - coalesce(sum(capacity) FILTER (f) OVER (PARTITION BY {parents}), 0))
                       * weight // sum(weight) FILTER (NOT f) OVER (PARTITION BY {parents}) END AS quota
        FROM (SELECT *, capacity::HUGEINT * ahead <= (budget - before) * weight AS f
              FROM (SELECT *, coalesce(sum(capacity) OVER (PARTITION BY {parents} ORDER BY capacity / weight, {name}
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                           sum(weight) OVER (PARTITION BY {parents} ORDER BY capacity / weight, {name}
                                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead
                    FROM ({nodes})))"""


def mix_sql(documents: str = "documents") -> str:
    domains = " ".join(f"WHEN source IN ({', '.join(repr(s) for s in names)}) THEN '{k}'" for k, names in DOMAINS.items())
    lang_weight = _case("lang", MIX_WEIGHTS["lang"])
    domain_weight = _case("domain", MIX_WEIGHTS["domain"])
    return rf"""
    WITH k AS (
        SELECT doc_id, CASE {domains} ELSE 'other' END AS domain, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
        FROM {documents}),
    leaf AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM k GROUP BY ALL),
    open AS (SELECT *, tokens * {MIX_EPOCHS} AS cap FROM leaf WHERE {domain_weight} > 0 AND {lang_weight} > 0),
    d AS ({_fill(f"SELECT 0 AS root, domain, sum(cap) AS capacity, {domain_weight} AS weight, (SELECT sum(tokens) * {MIX_SHARE[0]} // {MIX_SHARE[1]} FROM leaf) AS budget FROM open GROUP BY domain", "root", "domain")}),
    l AS ({_fill(f"SELECT o.domain, lang, sum(cap) AS capacity, {lang_weight} AS weight, any_value(d.quota) AS budget FROM open o JOIN d USING (domain) GROUP BY o.domain, lang", "domain", "lang")}),
    s AS ({_fill("SELECT o.domain, o.lang, source, sum(cap) AS capacity, 1 AS weight, any_value(l.quota) AS budget FROM open o JOIN l USING (domain, lang) GROUP BY o.domain, o.lang, source", "domain, lang", "source")}),
    q AS (SELECT leaf.*, coalesce(s.quota, 0) AS quota, CASE WHEN leaf.tokens > 0 THEN coalesce(s.quota, 0) // leaf.tokens ELSE 0 END AS epochs
          FROM leaf LEFT JOIN s USING (domain, lang, source)),
    o AS (SELECT k.*, quota, epochs, quota - epochs * q.tokens AS head,
                 sum(k.tokens) OVER (PARTITION BY domain, lang, source
                     ORDER BY md5('{MIX_SEED}:' || epochs || ':' || coalesce(doc_id::VARCHAR, 'null')), k.tokens
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through
          FROM k JOIN q USING (domain, lang, source))
    SELECT doc_id, domain, lang, source, tokens::BIGINT AS tokens, quota::BIGINT AS quota,
           (epochs + CASE WHEN head > 0 AND through <= head THEN 1 ELSE 0 END)::BIGINT AS copies
    FROM o
    """


@query("op4_mixing", mix_sql())
def op4_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


def near_sql(documents: str, width: int, percent: int) -> str:
    return rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w FROM {documents}),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {width}
                 THEN [array_to_string(w[k:k + {width - 1}], ' ') FOR k IN range(1, len(w) - {width - 2})]
                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= {percent} * (x.n + y.n - shared)),
    both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    reach AS (SELECT doc_id AS a, doc_id AS r FROM w UNION SELECT both_ways.b, r FROM reach JOIN both_ways USING (a) WHERE r < both_ways.b),
    c AS (SELECT a AS doc_id, min(r) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM w LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
    """


@query("op3_minhash_near_dedup", near_sql("documents", 3, 85))
def op3_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85).drop("text_hash")


@query(
    "op5_sentence_spans",
    r"""
    WITH t AS (
        SELECT doc_id, regexp_extract(coalesce(text, ''), '^[\x20\x09-\x0D]*') AS blanks,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS t FROM documents),
    w AS (SELECT doc_id, k, tok, regexp_replace(tok, '[\x20\x09-\x0D]+$', '') AS word
          FROM (SELECT doc_id, unnest(t) AS tok, unnest(range(0, len(t))) AS k FROM t)),
    v AS (SELECT *, CASE WHEN regexp_matches(tok, '[.!?][''")\]]*[\x20\x09-\x0D]*$|[\x0A-\x0D]') THEN '0' ELSE '1' END || left(md5(word), 14) AS v FROM w),
    c AS (SELECT *, v < coalesce(min(v) OVER (d ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 'z')
                 AND v <= coalesce(min(v) OVER (d ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), 'z') AS ends
          FROM v WINDOW d AS (PARTITION BY doc_id ORDER BY k)),
    g AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM c),
    h AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, g ORDER BY k) - 1) // 64 AS h FROM g),
    p AS (SELECT doc_id, min(k) AS a, max(k) AS e FROM h GROUP BY doc_id, g, h),
    q AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n, row_number() OVER d AS nth, lead(e, 2) OVER d AS e3, lead(e, 3) OVER d AS e4,
                 max(e) OVER (PARTITION BY doc_id) AS last
          FROM p WINDOW d AS (PARTITION BY doc_id ORDER BY a)),
    r AS (SELECT doc_id, a, CASE WHEN n < 3 THEN CASE WHEN nth = 1 THEN last END WHEN e3 - a >= 9 THEN e3 ELSE e4 END AS z FROM q),
    words AS (SELECT doc_id, list(word ORDER BY k) AS words FROM w GROUP BY doc_id),
    f AS (SELECT doc_id, a, z, row_number() OVER (PARTITION BY array_to_string(words[a + 1:z + 1], ' ') ORDER BY doc_id, a) AS nth
          FROM r JOIN words USING (doc_id) WHERE z - a >= 9),
    x AS (SELECT DISTINCT doc_id, unnest(range(a, z + 1)) AS k FROM f WHERE nth > 1),
    s AS (SELECT w.doc_id, string_agg(tok, '' ORDER BY w.k) FILTER (x.k IS NULL) AS kept FROM w LEFT JOIN x USING (doc_id, k) GROUP BY w.doc_id),
    m AS (SELECT p.doc_id, count(*) AS n_removed FROM p JOIN x ON x.doc_id = p.doc_id AND x.k = p.a GROUP BY p.doc_id),
    o AS (SELECT x.doc_id, count(*) AS n_spans FROM x LEFT JOIN x y ON y.doc_id = x.doc_id AND y.k = x.k - 1 WHERE y.k IS NULL GROUP BY x.doc_id)
    SELECT t.doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(blanks || coalesce(kept, '')) AS kept_sha256
    FROM t LEFT JOIN s USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN o USING (doc_id)
    """,
)
def op5_sentence_spans(spark, sf_dir):
    cleaned = substring_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_removed", "n_spans", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


TOOL_SCHEMAS = {
    "search": {"query": {"type": "string", "required": True}, "limit": {"type": "integer", "required": True, "minimum": 1, "maximum": 25}},
    "note": {"body": {"type": "string", "required": True}, "words": {"type": "integer", "required": True, "maximum": 200}},
}


@query(
    "op10_tool_calls",
    r"""
    WITH w AS (
        SELECT DISTINCT conv_id, turn, role, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n
        FROM conversations),
    e AS (
        SELECT *, CASE role WHEN 'assistant' THEN 'call' WHEN 'user' THEN 'result' ELSE 'message' END AS kind,
               CASE role WHEN 'assistant' THEN conv_id || ':' || turn WHEN 'user' THEN conv_id || ':' || (turn - 1) END AS call_id,
               CASE WHEN role = 'assistant' THEN CASE WHEN n <= 30 THEN 'search' ELSE 'note' END END AS name,
               row_number() OVER (PARTITION BY conv_id, turn, role = 'assistant', role = 'user' ORDER BY
                   CASE WHEN role = 'assistant' THEN CASE WHEN n <= 30 THEN 'search' ELSE 'note' END END, text) AS nth
        FROM w),
    l AS (
        SELECT e.*, c.call_id IS NOT NULL AS has_call, r.call_id IS NOT NULL AS has_result,
               role = 'assistant' AND turn >= 3 AND d.call_id IS NULL AS no_base
        FROM e LEFT JOIN (SELECT DISTINCT conv_id, call_id FROM e WHERE kind = 'call') c ON c.conv_id = e.conv_id AND c.call_id = e.call_id
        LEFT JOIN (SELECT DISTINCT conv_id, call_id FROM e WHERE kind = 'result') r ON r.conv_id = e.conv_id AND r.call_id = e.call_id
        LEFT JOIN (SELECT DISTINCT conv_id, call_id FROM e WHERE kind = 'call') d
            ON d.conv_id = e.conv_id AND d.call_id = e.conv_id || ':' || (e.turn - 2)),
    x AS (
        SELECT *, concat_ws(',',
                 CASE WHEN kind = 'call' AND text IS NULL AND name = 'search' THEN 'missing:query' END,
                 CASE WHEN name = 'search' AND n < 1 THEN 'minimum:limit' END,
                 CASE WHEN name = 'search' AND n > 25 THEN 'maximum:limit' END,
                 CASE WHEN name = 'note' AND n > 200 THEN 'maximum:words' END,
                 CASE WHEN no_base THEN 'needs:' || conv_id || ':' || (turn - 2) END) AS errors
        FROM l)
    SELECT conv_id, turn, kind, call_id, turn AS step,
           CASE WHEN kind <> 'message' AND nth > 1 THEN 'duplicate' WHEN kind = 'result' AND NOT has_call THEN 'orphan'
                WHEN errors <> '' THEN 'invalid' WHEN kind = 'call' AND NOT has_result THEN 'unanswered' ELSE 'ok' END AS status,
           errors,
           CASE name WHEN 'search' THEN '{"arguments":{"limit":' || n || coalesce(',"query":' || to_json(text), '') || '},"call_id":'
                                        || to_json(call_id) || ',"kind":"call","name":"search"}'
                     WHEN 'note' THEN '{"arguments":{"body":' || to_json(text) || ',"words":' || n || '},"call_id":'
                                        || to_json(call_id) || ',"kind":"call","name":"note"}'
                ELSE '{' || coalesce('"call_id":' || to_json(call_id) || ',', '') || coalesce('"content":' || to_json(text) || ',', '')
                     || '"kind":' || to_json(kind) || '}' END AS json
    FROM x
    """,
)
def op10_tool_calls(spark, sf_dir):
    return link_tool_calls(conversation_events(table(spark, sf_dir, "conversations")), TOOL_SCHEMAS)


@query(
    "op8_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                      sha1(coalesce(html, '')) AS payload_digest FROM pages),
    r AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS latest FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN latest > page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN latest > page_id THEN latest END AS refers_to, TRUE AS intact
    FROM r
    """,
)
def op8_warc(spark, sf_dir):
    return archive_pages(table(spark, sf_dir, "pages")).drop("payload", "uri")


@query("op6_language_id")
def op6_language_id(spark, sf_dir):
    return identify_language(table(spark, sf_dir, "documents"))


@query(
    "op2_suffix_dedup",
    """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT doc_id, k, substring(h, 2 * k + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS k FROM d)),
    f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
    r AS (SELECT doc_id, k, CASE WHEN k > max(k) OVER before + 50 OR max(k) OVER before IS NULL THEN 1 ELSE 0 END AS fresh
          FROM w JOIN f USING (s) WHERE doc_id > least
          WINDOW before AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    n AS (SELECT doc_id, k, sum(fresh) OVER (PARTITION BY doc_id ORDER BY k) AS island FROM r),
    i AS (SELECT doc_id, min(k) AS a, max(k) + 50 AS b FROM n GROUP BY doc_id, island),
    g AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS p FROM i),
    c AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS z,
                 string_agg(substring(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS head
          FROM g JOIN d USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(head, '') || substring(h, 2 * coalesce(z, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN c USING (doc_id)
    """,
)
def op2_suffix_dedup(spark, sf_dir):
    cut = suffix_dedup(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op9_license_scan")
def op9_license_scan(spark, sf_dir):
    return license_scan(document_paths(table(spark, sf_dir, "documents")), keep=("doc_id",))


def _grams_sql(longest: int) -> str:
    return " UNION ALL ".join(
        f"SELECT lang, {k} AS len, unnest([array_to_string(w[i:i + {k - 1}], ' ') FOR i IN range(1, len(w) - {k - 2})]) AS g FROM w"
        for k in range(1, longest + 1)
    )


@query(
    "op11_collocations",
    rf"""
    WITH p AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    c AS (SELECT lang, len, g, count(*) AS f FROM ({_grams_sql(4)}) GROUP BY ALL),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE len = 1 GROUP BY lang),
    q AS (SELECT lang, len, g, f AS a, string_split(g, ' ') AS ws FROM c WHERE len > 1 AND f >= 30),
    k AS (SELECT *, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS rest
          FROM (SELECT *, unnest(range(1, len)) AS k FROM q)),
    s AS (SELECT k.lang, k.g, k.a, k.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * k.a) // (x.f + y.f))::BIGINT AS score
          FROM k JOIN c x ON x.lang = k.lang AND x.g = head JOIN c y ON y.lang = k.lang AND y.g = rest),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    i AS (SELECT lang, array_to_string(ws[p:p + size - 1], ' ') AS g, max(a) AS longest
          FROM (SELECT *, unnest(range(1, len - size + 2)) AS p FROM (SELECT *, unnest(range(2, len)) AS size FROM q)) GROUP BY ALL),
    v AS (SELECT b.* FROM b LEFT JOIN i USING (lang, g) WHERE longest IS NULL OR 100 * longest < 80 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
    FROM v JOIN n USING (lang) QUALIFY rank <= 2000
    """,
)
def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


@query(
    "op12_ranked_search",
    r"""
    WITH d AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
    i AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
    f AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY doc_id, t),
    n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
    c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
    w AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY t, docs),
    m AS (SELECT doc_id, 10 + 90 * n * docs // total AS m FROM n, c),
    s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
          FROM i JOIN f USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 10
    """,
)
def op12_ranked_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op13_line_dedup",
    """
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
    l AS (SELECT doc_id, line, k, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM (SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS k FROM d)),
    f AS (SELECT key, TRUE AS frequent FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) AS n_lines, count(frequent) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (frequent IS NULL), '')) AS kept_sha256
    FROM l LEFT JOIN f USING (key) GROUP BY doc_id
    """,
)
def op13_line_dedup(spark, sf_dir):
    cleaned = line_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
