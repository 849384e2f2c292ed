"""The operators as registered queries, with DuckDB SQL where it can express them.

Each query applies its operator, with the production parameters, to its whole
table. ``ORACLE`` leaves out the operators that SQL can't express or that are
too slow there; tests/llm holds them against brute force.
"""

from __future__ import annotations

from functools import wraps

import corpus_pipeline
from pyspark.sql import functions as F

from . import chunks, dac, decontaminate, divergence, jaccard, lm, mixing, pages, quality, repair, secrets, suffix, urls
from .common import read, ship

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark, sf_dir):
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return add


# ---- 4: benchmark decontamination ------------------------------------------------------

_WORDS = (r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')")


@register("op4_decontaminate", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(len(w), 10) AS n,
    array_to_string(list_slice(w, a, a + 9), ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS a FROM i WHERE len(w) > 0)),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS a FROM d),
h AS (SELECT DISTINCT p.doc_id, p.a, g.n, g.item_id FROM p
    JOIN (SELECT DISTINCT n FROM g) s ON p.a + s.n - 1 <= len(p.w)
    JOIN g ON g.n = s.n AND g.gram = array_to_string(list_slice(p.w, p.a, p.a + s.n - 1), ' ')),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS k FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)""")
def op4_decontaminate(spark, sf_dir):
    found = decontaminate.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


# ---- 7: mixing sources to target weights -----------------------------------------------

def _sql_hash(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


@register("op7_mix_sources", f"""
WITH RECURSIVE s AS (SELECT source, CAST(coalesce(sum(length(text)), 0) AS DOUBLE) AS n FROM documents GROUP BY 1),
r AS (SELECT source, CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE pow(n, 0.5::DOUBLE)
    / (SELECT sum(pow(n, 0.5::DOUBLE)) FROM s) * (SELECT sum(n) FROM s) / n END AS rate FROM s),
c AS (SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS cum FROM r
    UNION ALL SELECT source, rate, k + 1, p * rate / (k + 1), cum + p * rate / (k + 1) FROM c
    WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
u AS (SELECT *, {_sql_hash("'draw0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')")} / 4503599627370496.0::DOUBLE AS x
    FROM documents),
n AS (SELECT u.* EXCLUDE (x), (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.cum <= u.x)
    AS n_copies FROM u),
e AS (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM n)
SELECT doc_id, text, lang, source, n_chars, n_copies, copy,
    {_sql_hash("'order0:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || copy")} AS shuffle_key FROM e""")
def op7_mix_sources(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


# ---- 6 and 10: repeated substrings ------------------------------------------------------

def _kept_digest(cut):
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op6_suffix_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM d)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w)
    WHERE k > 1),
g AS (SELECT doc_id, p, sum(gap) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM (SELECT doc_id, p,
    CAST(p - lag(p, 1, -101) OVER (PARTITION BY doc_id ORDER BY p) > 100 AS INTEGER) AS gap FROM r)),
c AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM g GROUP BY doc_id, g),
k AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM (SELECT c.*, d.h,
    lag(b, 1, 0) OVER (PARTITION BY c.doc_id ORDER BY a) AS before FROM c JOIN d USING (doc_id)) GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""")
def op6_suffix_dedup(spark, sf_dir):
    return _kept_digest(suffix.remove_repeats(read(spark, sf_dir, "documents")))


@register("op10_chunk_dedup")
def op10_chunk_dedup(spark, sf_dir):
    return _kept_digest(chunks.remove_repeats(read(spark, sf_dir, "documents"), whole=True))


# ---- 2: n-gram Jaccard join --------------------------------------------------------------

@register("op2_ngram_jaccard")
def op2_ngram_jaccard(spark, sf_dir):
    return jaccard.near_classes(read(spark, sf_dir, "documents"))


# ---- 3: quality rules --------------------------------------------------------------------

@register("op3_token_fertility")
def op3_token_fertility(spark, sf_dir):
    return quality.judge(read(spark, sf_dir, "documents")).drop("tie")


# ---- 9: URL filter -----------------------------------------------------------------------

URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


@register("op9_url_words")
def op9_url_words(spark, sf_dir):
    return urls.judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents"), URL_RULES)


# ---- 5: HTML extraction ------------------------------------------------------------------

@register("op5_site_templates")
def op5_site_templates(spark, sf_dir):
    found = pages.extract(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


# ---- 8: token ids ------------------------------------------------------------------------

@register("op8_token_codes")
def op8_token_codes(spark, sf_dir):
    return dac.round_trip(read(spark, sf_dir, "documents"))


# ---- 1: language-model scores ------------------------------------------------------------

@register("op1_pseudo_likelihood")
def op1_pseudo_likelihood(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return lm.score(docs, lm.fit(docs))


# ---- 11: source divergence audit ---------------------------------------------------------

_SHARE = "1 + (1000000000::HUGEINT * ({} + 1)) // ({} + v.v)"


@register("op11_source_divergence", rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY 1, 2, 3),
n AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c, {_SHARE.format("coalesce(c.c, 0)", "n.n")} AS p,
    {_SHARE.format("k.total", "v.n")} AS q FROM n JOIN k ON k.lang = n.lang JOIN v ON v.lang = n.lang
    LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (SELECT *,
    row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o)
WHERE part = 'pair' OR rank <= 200""")
def op11_source_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))


# ---- 12: secret scans --------------------------------------------------------------------

def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_KIND_ORDER = "list_position([" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "], kind)"


def _parts_sql(kind: str, pattern: str) -> str:
    p = _text(pattern)
    return (f"SELECT r, '{kind}' AS kind, unnest(range(len(m))) AS i, unnest(m) AS m, unnest(g) AS g, unnest(v) AS v "
            f"FROM (SELECT r, regexp_extract_all(text, {p}) AS m, regexp_split_to_array(text, {p})[:-2] AS g, "
            f"regexp_extract_all(text, {p}, {2 if kind == 'assign' else 0}) AS v FROM d)")


def _near_sql(kinds: str) -> str:
    return (f"EXISTS (SELECT 1 FROM f o WHERE o.r = f.r AND o.scope = f.scope AND o.kind IN ({kinds}) AND "
            f"(o.a <> f.a OR o.kind <> f.kind) AND greatest(o.a - f.b, f.a - o.b) <= {secrets.REACH})")


@register("op12_credential_links", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({' UNION ALL '.join(_parts_sql(k, p) for k, p in [*secrets.KINDS.items(), ('blank', secrets.BLANK_LINE)])}),
s AS (SELECT *, CAST(sum(length(g) + length(m)) OVER (PARTITION BY r, kind ORDER BY i) AS BIGINT) AS b FROM m),
p AS (SELECT r, kind, b - length(m) AS a, b FROM s WHERE CASE kind WHEN 'assign' THEN length(v) >= 6
    WHEN 'access' THEN length(m) >= 20 WHEN 'value' THEN regexp_matches(m, {_text(secrets.KEYED)})
        OR regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') ELSE true END),
f AS (SELECT r, kind, a, b, (SELECT count(*) FROM p x WHERE x.r = p.r AND x.kind = 'blank' AND x.a < p.a) AS scope
    FROM p WHERE kind <> 'blank' AND NOT EXISTS (SELECT 1 FROM p o WHERE o.r = p.r AND o.a < p.b AND p.a < o.b
        AND (p.kind IN ('ident', 'endpoint', 'value') AND o.kind IN ('assign', 'access', 'hex')
            OR p.kind IN ('endpoint', 'value') AND o.kind = 'ident' OR p.kind = 'value' AND o.kind = 'endpoint'))),
n AS (SELECT r, kind, a, b, {_near_sql("'assign', 'hex', 'value'")} AS secret, {_near_sql("'access', 'ident'")} AS id,
    {_near_sql("'endpoint'")} AS endpoint FROM f),
k AS (SELECT r, kind, kind || ':' || a || ':' || b AS span, a, {_KIND_ORDER} AS o, kind IN ('assign', 'access', 'hex') AS base
    FROM n WHERE CASE kind WHEN 'ident' THEN secret WHEN 'value' THEN id OR endpoint WHEN 'endpoint' THEN secret AND id
        ELSE true END)
SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    sha256(coalesce(string_agg(span, ',' ORDER BY a, o) FILTER (WHERE base), '')) AS base_sha256,
    coalesce(string_agg(span, ',' ORDER BY a, o), '') AS spans, count(*) FILTER (WHERE NOT base) AS n_weak
FROM d LEFT JOIN k USING (r) GROUP BY r, doc_id""")
def op12_credential_links(spark, sf_dir):
    return secrets.scan(read(spark, sf_dir, "documents"))


# ---- 13: conversation structure repair ---------------------------------------------------

_TABLE = ("(SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: "
          "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)))")
_SPACE = r"\x09-\x0D\x20"


@register("op13_conversation_repair", rf"""
WITH RECURSIVE z AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
crc_table AS (SELECT {_TABLE} AS t),
f AS (SELECT z.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault FROM z, crc_table),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM f),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
        sha256(length(role) || ':' || role || text)) AS i FROM d),
m AS (SELECT *, substr(role, 1, 1) AS ini, NOT regexp_matches(text, '[^{_SPACE}]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][{_SPACE}]*$') AS cut,
    lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS follows FROM o),
h AS (SELECT *, CASE WHEN blank THEN 'blank' WHEN again THEN 'duplicate' WHEN cut THEN 'truncated' ELSE '' END AS fault
    FROM m),
st AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE follows IS NOT NULL AND ini || follows NOT IN ('su', 'ua', 'au')) AS illegal,
    max(i) AS n FROM h GROUP BY conv_id),
moves(a, b, role) AS (VALUES (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
e AS (SELECT conv_id, i, q AS a, q AS b, 'D' AS letter, 3 AS c FROM h, (VALUES (0), (1), (2), (3)) s(q)
    UNION ALL SELECT conv_id, i, a, b, 'R', 2 + CAST(fault = 'truncated' AS INTEGER) FROM h, moves
        WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL SELECT conv_id, i, a, b, 'K', CAST(fault = 'truncated' AS INTEGER) FROM h JOIN moves ON ini = moves.role
        WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL SELECT conv_id, i, 0, 1, 'K', CAST(fault = 'truncated' AS INTEGER) FROM h
        WHERE ini = 's' AND fault NOT IN ('blank', 'duplicate')),
ins(a, b, letters, c) AS (VALUES (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 2), (1, 2, 'I', 2),
    (3, 2, 'I', 2), (2, 3, 'I', 2), (0, 3, 'II', 4), (1, 3, 'II', 4), (2, 2, 'II', 4), (3, 3, 'II', 4)),
x AS (SELECT e.conv_id, e.i, ins.a, e.b, ins.letters || e.letter AS letters, ins.c + e.c AS c FROM e JOIN ins ON ins.b = e.a),
w AS (SELECT conv_id, n + 1 AS i, q, CAST(c AS BIGINT) AS cost, audit FROM st,
        (VALUES (0, 0, ''), (1, 4, 'II'), (2, 2, 'I'), (3, 0, '')) t(q, c, audit)
    UNION ALL SELECT conv_id, i, q, v.cost, v.audit FROM (SELECT x.conv_id, x.i, x.a AS q,
        min(struct_pack(cost := CAST(x.c + w.cost AS BIGINT), audit := x.letters || w.audit)) AS v
        FROM w JOIN x ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.i = w.i - 1 AND x.b = w.q GROUP BY 1, 2, 3)),
best AS (SELECT conv_id, cost, audit FROM w WHERE i = 1 AND q = 0),
l AS (SELECT conv_id, audit, k, audit[k] AS letter,
    len(replace(audit[1:k], 'I', '')) AS i, len(replace(audit[1:k], 'D', '')) AS p
    FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS k FROM best)),
r AS (SELECT l.*, h.role, h.text, max(CASE WHEN p = 1 AND letter = 'K' AND ini = 's' THEN 1 ELSE 0 END)
        OVER (PARTITION BY l.conv_id) AS s FROM l LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM l.conv_id
        AND h.i = l.i AND l.letter <> 'I' WHERE l.letter <> 'D'),
y AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (p - s) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS repaired FROM r GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN st ON st.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM c.conv_id""")
def op13_conversation_repair(spark, sf_dir):
    return repair.repair_damaged(read(spark, sf_dir, "conversations"))


# ---- the pipeline ------------------------------------------------------------------------

@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
