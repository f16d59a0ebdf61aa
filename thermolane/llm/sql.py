"""DuckDB SQL of the operators' queries, where SQL can express them on the given tables."""

OP1 = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), v AS (
  SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM sound
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND len(a.e) = len(b.e)
    AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach(id, m) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.a, r.m FROM reach r JOIN links l ON l.b = r.id
), low AS (SELECT id, min(m) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON low.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

OP2 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM w
), one AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS o
  FROM one a JOIN one b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * o >= 80 * (na + nb - o)),
reach(id, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.a, r.m FROM reach r JOIN links l ON l.b = r.id),
low AS (SELECT id, min(m) AS component_id FROM reach GROUP BY id),
classes AS (SELECT doc_id, CASE WHEN len(s) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY list_sort(s)) END AS n_copies FROM sets)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, component_id, n_copies
FROM sets JOIN low ON low.id = sets.doc_id JOIN classes ON classes.doc_id = sets.doc_id
"""

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _host(url: str) -> str:
    return f"translate(coalesce(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), ''), {_UPPER})"


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _node(url: str) -> str:
    rest = f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^#]*)', 1)"
    return f"CASE WHEN {_host(url)} <> '' THEN {_host(url)} || CASE WHEN {rest} = '' THEN '/' ELSE {rest} END END"


def _op6() -> str:
    from .registry import URL_RULES
    from .url_rules import CANONICAL, COMMENT, HREF, REFRESH, REFRESH_URL

    def q(pattern):
        return "'" + pattern.replace("'", "''") + "'"

    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    return f"""
WITH RECURSIVE rules(rule_host, rule_path, action) AS (VALUES {rules}),
bodies AS (SELECT url, regexp_replace(html, {q(COMMENT)}, '', 'g') AS html FROM pages),
raw AS (
  SELECT url, regexp_extract(tag, {q(HREF)}, 1) AS link FROM (SELECT url, unnest(regexp_extract_all(html, {q(CANONICAL)})) AS tag FROM bodies)
  UNION ALL SELECT url, regexp_extract(tag, {q(REFRESH_URL)}, 1) FROM (SELECT url, unnest(regexp_extract_all(html, {q(REFRESH)})) AS tag FROM bodies)
), parts AS (
  SELECT url, link, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme, {_host("url")} AS host, {_path("url")} AS here,
    regexp_extract(link, '(?s)^([^?#]*)', 1) AS p, regexp_extract(link, '(?s)^[^?#]*(\\?[^#]*)', 1) AS query
  FROM (SELECT url, replace(link, '&amp;', '&') AS link FROM raw WHERE link <> '')
), whole AS (
  SELECT *, CASE WHEN starts_with(p, '/') THEN p WHEN p = '' THEN CASE WHEN here = '' THEN '/' ELSE here END
    ELSE CASE WHEN contains(here, '/') THEN regexp_extract(here, '(?s)^(.*/)', 1) ELSE '/' END || p END AS w FROM parts
), walked AS (
  SELECT *, CASE WHEN regexp_matches(w, '/\\.\\.?(/|$)') THEN list_reduce(
      list_prepend('', string_split(substr(CASE WHEN regexp_matches(w, '/\\.\\.?$') THEN w || '/' ELSE w END, 2), '/')),
      lambda done, part: CASE part WHEN '.' THEN done WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || part END
    ) ELSE w END AS clean FROM whole
), full_links AS (
  SELECT url, CASE WHEN starts_with(link, '//') THEN scheme || ':' || link
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN NOT starts_with(link, '#') AND NOT regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN scheme || '://' || host || clean || query
    END AS target
  FROM walked
), links AS (
  SELECT {_node("url")} AS a, {_node("target")} AS b, target FROM full_links
), urls AS (
  SELECT url AS u, {_node("url")} AS node FROM pages UNION SELECT target, b FROM links WHERE a IS NOT NULL AND b IS NOT NULL
), judged AS (
  SELECT u, node, {_host("u")} AS host, {_path("u")} AS path FROM urls
), best AS (
  SELECT u, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(action, length(rule_host || rule_path)) AS action
  FROM judged JOIN rules ON host <> '' AND (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY u
), both_ways AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
reach(id, m) AS (SELECT a, a FROM both_ways UNION SELECT l.a, r.m FROM reach r JOIN both_ways l ON l.b = r.id),
spread AS (
  SELECT r.id, min(best.action) AS inherited FROM reach r JOIN judged ON judged.node = r.m JOIN best ON best.u = judged.u GROUP BY r.id
)
SELECT page_id, {_host("url")} AS host, {_path("url")} AS path, rule, coalesce(action, inherited, 'allow') AS verdict
FROM pages LEFT JOIN best ON best.u = url LEFT JOIN spread ON spread.id = {_node("url")}
"""


OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha256(t) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM h WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM h LEFT JOIN f USING (payload_digest)
"""

#: 3988292384 is the reflected polynomial of CRC-32.
_CRC_TABLE = """steps(i, k, v) AS (
  SELECT i::UBIGINT, 0, i::UBIGINT FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM steps WHERE k < 8
), tab AS (SELECT list(v ORDER BY i) AS tab FROM steps WHERE k = 8)"""

OP9 = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + 1)::BIGINT AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: ('0x' || p)::UBIGINT) AS raw FROM documents
), c AS (
  SELECT doc_id, size, xor(list_reduce(list_concat([4294967295::UBIGINT], raw),
    lambda crc, x: xor(crc >> 8, tab[(xor(crc, x) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32 FROM d, tab
), s AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id) AS run, sum(size) OVER () AS total, row_number() OVER (ORDER BY doc_id) AS nth FROM c
), e AS (SELECT *, least(((2 * run - size) * 8 // (2 * total)), 7)::INTEGER AS shard FROM s)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY nth) - 1 AS slot,
  NULL::INTEGER AS grown_shard FROM e
"""

OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), {_UPPER}) AS run FROM documents
), occ AS (
  SELECT run, count(*) AS k, list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'),
    lambda p: ('0x' || p)::UBIGINT) AS raw FROM runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, k, xor(list_reduce(list_concat([4294967295::UBIGINT], raw),
    lambda crc, x: xor(crc >> 8, tab[(xor(crc, x) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS h FROM occ, tab
), typed AS (
  SELECT k, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (SELECT word, n, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM places),
shorter AS (SELECT c.word AS w1, c.n AS n1, w.word AS w2, w.n AS n2 FROM cut c JOIN words w ON w.word = c.a || c.b),
pairs AS (
  SELECT x.word AS word, y.word AS other, y.n AS other_n FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT w1, w2, n2 FROM shorter UNION SELECT w2, w1, n1 FROM shorter
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
    CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)
), walk(word, tip) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.tip WHERE forms.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, walk.tip AS root
FROM forms f JOIN walk USING (word) JOIN forms e ON e.word = walk.tip WHERE e.form IS NULL
"""

OP13 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
), terms AS (SELECT d, lang, source, translate(unnest(w), {_UPPER}) AS term FROM docs),
groups AS (SELECT DISTINCT lang, source FROM docs),
kept AS (SELECT lang, term, count(*) AS nl FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(nl) AS tl FROM kept GROUP BY lang),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS t FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT totals.lang, totals.source, kept.term, coalesce(n, 0) AS n,
    (1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (t + 2 * v))::BIGINT AS p,
    (1 + 1000000000::HUGEINT * (nl + 2) // (tl + 2 * v))::BIGINT AS q
  FROM totals JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ALL = {
    "op1_embedding_near_dedup": OP1,
    "op2_ngram_jaccard_join": OP2,
    "op6_url_filter": _op6(),
    "op7_warc": OP7,
    "op9_sharding": OP9,
    "op12_spelling_variants": OP12,
    "op13_source_divergence": OP13,
}
