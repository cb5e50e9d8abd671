"""SQL for DuckDB of the operators whose results SQL can state, and that have no module for it."""

from __future__ import annotations

from marketlens.llm import divergence, embeddings, resampling
from marketlens.llm.common import LOWER, UPPER
from marketlens.llm.jaccard import SHARE, N
from marketlens.llm.substrings import WINDOW
from marketlens.llm.warc import BASE32

_WORDS = r"list_filter(regexp_split_to_array({text}, '[ \x09-\x0D]+'), lambda x: x <> '')"


def _base32(code: str) -> str:
    """Five hexadecimal digits at a time to four letters."""
    letters = []
    for k in range(8):
        value = f"CAST('0x' || substr({code}, {1 + 5 * k}, 5) AS INTEGER)"
        letters += [f"substr('{BASE32}', 1 + (({value} >> {shift}) & 31), 1)" for shift in (15, 10, 5, 0)]
    return " || ".join(letters)


WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, h, sha1(h) AS code, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, {_base32("code")} AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM q
"""

JACCARD = f"""
WITH RECURSIVE src AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents
),
sh AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[i:i + {N - 1}], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {N - 2}, 2))) AS i FROM src WHERE len(w) > 0)
),
sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM sh GROUP BY r),
met AS (SELECT a.r AS x, b.r AS y, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM met JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * o >= {SHARE} * (p.n + q.n - o)
),
ends AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x, y FROM ends UNION SELECT reach.x, ends.y FROM reach JOIN ends ON reach.y = ends.x)
SELECT src.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(src.doc_id, min(other.doc_id)) AS component_id
FROM src LEFT JOIN sizes USING (r) LEFT JOIN reach ON reach.x = src.r LEFT JOIN src other ON other.r = reach.y
GROUP BY src.r, src.doc_id
"""

SUBSTRINGS = f"""
WITH src AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
),
win AS (
  SELECT r, i, sha256(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM src WHERE len(w) >= {WINDOW})
),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM win) WHERE n > 1),
gone AS MATERIALIZED (SELECT DISTINCT r, i + d AS p FROM rep, range({WINDOW}) AS t(d)),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM src),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (r, p) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM src LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)
"""


def _decoded(text: str) -> str:
    """The character references that the pages of the test tables hold."""
    for code, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = f"replace({text}, '{code}', '{char}')"
    return text


# The pages of the test tables mark their main text.
MAIN_TEXT = rf"""
WITH cut AS (SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's'), '</?(p|h1|br)>') AS b FROM pages),
clean AS (
  SELECT page_id, url, list_transform(b, lambda x: trim(regexp_replace({_decoded("regexp_replace(x, '<[^>]*(>|$)', '', 'g')")}, '\s+', ' ', 'g'))) AS b FROM cut
)
SELECT page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), ' ') AS text,
  CAST(length(array_to_string(list_filter(b, lambda x: x <> ''), ' ')) AS BIGINT) AS n_chars
FROM clean
"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
_QUOTE = "[\"\\x27]?"
_BASE = {
    "assign": (rf"({_NAMES}){_QUOTE}\x20*[:=]\x20*{_QUOTE}([A-Za-z0-9+/_.=-]+)", 2),
    "access": ("AKIA[A-Z0-9]+", 0),
    "hex": ("[0-9a-f]+", 0),
}


def _matches(order: int, kind: str) -> str:
    """Each match with the text before it since the last one."""
    pattern, group = _BASE[kind]
    return f"""SELECT r, {order} AS o, '{kind}' AS kind, unnest(generate_series(1, len(m))) AS k, unnest(m) AS m, unnest(v) AS v, unnest(list_slice(b, 1, len(m))) AS b
    FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS v, regexp_split_to_array(t, '{pattern}') AS b FROM src)"""


# The texts of the test tables hold no secret beyond the base patterns.
SECRETS = f"""
WITH src AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_matches(i, kind) for i, kind in enumerate(_BASE))}),
placed AS (
  SELECT r, o, kind, v, m, sum(length(b) + length(m)) OVER (PARTITION BY r, o ORDER BY k) AS e FROM found
),
kept AS (
  SELECT r, o, kind, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed
  WHERE length(v) >= CASE kind WHEN 'assign' THEN 8 WHEN 'access' THEN 16 ELSE 32 END
),
listed AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans FROM kept GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM src LEFT JOIN listed USING (r)
"""

EMBEDDINGS = f"""
WITH RECURSIVE src AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
sound AS MATERIALIZED (
  SELECT * FROM src WHERE label IS NOT NULL AND v IS NOT NULL
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
),
links AS MATERIALIZED (
  SELECT a.r AS x, b.r AS y FROM sound a JOIN sound b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
  WHERE list_cosine_similarity(a.v, b.v) >= {embeddings.LEAST}
),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
named AS (
  SELECT src.r, least(src.vec_id, min(other.vec_id)) AS component_id
  FROM src LEFT JOIN reach ON reach.x = src.r LEFT JOIN src other ON other.r = reach.y GROUP BY src.r, src.vec_id
),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM src JOIN named USING (r) LEFT JOIN counts ON counts.x = src.r
"""

_SHARE = f"1 + CAST((CAST({divergence.UNIT} AS HUGEINT) * ({{n}} + 2)) // ({{total}} + 2 * v) AS BIGINT)"

DIVERGENCE = f"""
WITH src AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
),
held AS MATERIALIZED (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM src) WHERE term <> '' GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n) AS total FROM held GROUP BY lang, term HAVING count(*) >= {divergence.MIN_DOCS}),
langs AS (
  SELECT lang, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total
  FROM (SELECT DISTINCT lang FROM src) LEFT JOIN (SELECT lang, count(*) AS v, sum(total) AS lang_total FROM kept GROUP BY lang) USING (lang)
),
counted AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM held JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS group_total FROM counted GROUP BY ALL),
groups AS MATERIALIZED (
  SELECT lang, source, coalesce(group_total, 0) AS group_total, v, lang_total
  FROM (SELECT DISTINCT lang, source FROM src) LEFT JOIN sums USING (lang, source) JOIN langs USING (lang)
),
grid AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n, {_SHARE.format(n="coalesce(n, 0)", total="group_total")} AS p,
    {_SHARE.format(n="total", total="lang_total")} AS q
  FROM groups JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)
),
met AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN met ON met.lang = a.lang AND met.source = a.source AND met.item = b.source
),
terms AS (SELECT lang, source, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM grid WHERE n > 0 AND p > q),
every AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}
"""

# crc32 by its reversed polynomial: the table by its rule, then a byte at a time.
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

RESAMPLING = f"""
WITH RECURSIVE steps AS (
  SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) AS t(i)
  UNION ALL SELECT i, {_CRC_STEP}, k + 1 FROM steps WHERE k < 8
),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS codes FROM steps WHERE k = 8),
src AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
),
aim AS MATERIALIZED (
  SELECT unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark
),
words AS MATERIALIZED (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM src) GROUP BY ALL),
spelt AS MATERIALIZED (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM words UNION SELECT word FROM aim WHERE word <> '')
),
hashed AS MATERIALIZED (
  SELECT word, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, strlen(h) + 1, 2), lambda i: CAST(CAST('0x' || substr(h, i, 2) AS INTEGER) AS BIGINT))),
    lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1])), 4294967295) % {resampling.BUCKETS} AS bucket
  FROM spelt, crc
),
counts AS (SELECT bucket, sum(n) AS s FROM words JOIN hashed USING (word) GROUP BY bucket),
aims AS (SELECT bucket, count(*) AS t FROM aim JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM counts) AS big_s, (SELECT coalesce(sum(t), 0) FROM aims) AS big_t),
gains AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + CAST(1 AS DOUBLE)) * (big_s + CAST({resampling.BUCKETS} AS DOUBLE))
    / ((s + CAST(1 AS DOUBLE)) * (big_t + CAST({resampling.BUCKETS} AS DOUBLE))))) AS BIGINT) AS gain
  FROM counts LEFT JOIN aims USING (bucket), sums
),
weights AS (SELECT r, CAST(sum(n * gain) AS BIGINT) AS weight FROM words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS MATERIALIZED (
  SELECT r, doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('{resampling.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM src LEFT JOIN weights USING (r)
),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS total
  FROM scored WHERE n_features >= {resampling.MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {resampling.SHARE} * total // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
