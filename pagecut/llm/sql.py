"""DuckDB twins of the queries that SQL can express over whole tables."""

from __future__ import annotations

_BLANKS = r"[\x20\x09-\x0D]"
_WORDS = r"[^\x20\x09-\x0D]+"

EXACT = rf"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '{_BLANKS}', '', 'g') AS norm FROM documents),
r AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size
      FROM t WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r"""

SUFFIX = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM t, unnest(range(0, length(h) // 2 - 99)) AS u(i)),
dup AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
brk AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS b FROM dup),
runs AS (SELECT doc_id, i, sum(b) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM brk),
spans AS (SELECT doc_id, g, min(i) AS a, max(i) + 100 AS z FROM runs GROUP BY ALL),
cut AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans),
kept AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS last,
                string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS head
         FROM cut JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)"""

MIX_CTES = rf"""
sizes AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::BIGINT AS size,
                 ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM DOCS),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (SELECT *, 2 * source_size AS most,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM per),
levels AS (SELECT *, most::DOUBLE / w AS ratio,
                  (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER o, 0))
                  / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
           FROM weighed WINDOW o AS (ORDER BY most::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (SELECT source, source_size, least((SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio) * w, most::DOUBLE) AS target FROM levels),
queued AS (SELECT s.*, g.source_size, g.target,
                  sum(s.size) OVER (PARTITION BY s.source ORDER BY h, s.size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
           FROM sizes s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
copies AS (SELECT doc_id, size, h, k, (upto + k * source_size)::DOUBLE / target AS f FROM queued, unnest([0, 1]) AS u(k) WHERE size > 0),
ran AS (SELECT *, sum(size) OVER (ORDER BY f, k, h, size ROWS UNBOUNDED PRECEDING) AS total FROM copies),
taken AS (SELECT doc_id, size, count(*) AS copies FROM ran WHERE total <= (SELECT sum(target) FROM goal) GROUP BY ALL)"""

MIX = f"""
WITH {MIX_CTES.replace("DOCS", "documents")}
SELECT q.doc_id, q.size, q.source_size, q.target, (q.size * coalesce(t.copies, 0))::BIGINT AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id = t.doc_id AND q.size = t.size"""

LINES = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_WORDS}') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(words[i + 1:i + 8], ' ') AS s FROM w, unnest(range(0, len(words) - 7)) AS u(i)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, unnest(range(0, 8)) AS u(j) GROUP BY doc_id),
ln AS (SELECT doc_id, source, unnest(list_transform(lines, lambda x: trim(regexp_replace(lower(x), '{_BLANKS}+', ' ', 'g')))) AS norm,
              unnest(list_transform(lines, lambda x: len(regexp_extract_all(x, '{_WORDS}')))) AS n FROM w),
often AS (SELECT source, norm FROM ln GROUP BY source, norm HAVING count(DISTINCT doc_id) > 20),
lost AS (SELECT doc_id, sum(n)::BIGINT AS n FROM ln l JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.norm = o.norm GROUP BY doc_id),
f AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '{_BLANKS}', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             coalesce(l.n, 0)::BIGINT AS n_removed_words
      FROM w LEFT JOIN cov c ON w.doc_id = c.doc_id LEFT JOIN lost l ON w.doc_id = l.doc_id)
SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_removed_words >= 0.4::DOUBLE * n_words AS kept FROM f"""

_HOST = "translate(regexp_extract({u}, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({u}, '^.*?://[^/?#]*([^?#]*)', 1, 's')"
_RULE = """CASE WHEN {h} = 'www.example.com' AND starts_with({p}, '/en/') OR ends_with({h}, '.www.example.com') AND starts_with({p}, '/en/') THEN 'www.example.com/en/'
 WHEN ({h} = 'example.com' OR ends_with({h}, '.example.com')) AND starts_with({p}, '/en/') THEN 'example.com/en/'
 WHEN ({h} = 'net' OR ends_with({h}, '.net')) AND starts_with({p}, '/es/') THEN 'net/es/'
 WHEN ({h} = 'net' OR ends_with({h}, '.net')) AND starts_with({p}, '/fr/') THEN 'net/fr/'
 WHEN ({h} = 'com' OR ends_with({h}, '.com')) AND starts_with({p}, '/') THEN 'com/' END"""
_VERDICT = "CASE WHEN {r} IS NULL THEN NULL WHEN {r} IN ('com/', 'www.example.com/en/') THEN 'allow' ELSE 'block' END"
_NORMAL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
 regexp_replace({u}, '#.*$', '', 's'), '([?&])(?:utm_[a-z]+|gclid|fbclid|ref|source)=[^&]*', '\1', 'g'), '&{{2,}}', '&', 'g'), '\?&', '?', 'g'), '[?&]+$', ''),
 '^([^?]*)$', '\1')"""

#: The pages of the given tables hold no redirect or canonical links, so the links here are the steps to normal forms.
URLS = f"""
WITH RECURSIVE p AS (SELECT page_id, url, {_NORMAL.format(u="url")} AS form FROM pages),
e AS (SELECT DISTINCT url AS a, form AS b FROM p WHERE contains(url, '://') AND form <> '' AND url <> form),
linked AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (SELECT a, a FROM linked UNION SELECT r.a, x.b FROM reach r JOIN linked x ON r.b = x.a),
ends AS (SELECT a, {_HOST.format(u="b")} AS h, {_PATH.format(u="b")} AS p FROM reach),
hits AS (SELECT a, {_VERDICT.format(r="(" + _RULE.format(h="h", p="p") + ")")} AS v FROM ends),
stop AS (SELECT a, bool_or(v = 'block') AND NOT coalesce(bool_or(v = 'allow'), false) AS stop FROM hits GROUP BY a),
own AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN {_HOST.format(u="url")} ELSE '' END AS host,
               CASE WHEN contains(url, '://') THEN {_PATH.format(u="url")} ELSE '' END AS path FROM pages),
ruled AS (SELECT *, {_RULE.format(h="host", p="path")} AS rule FROM own)
SELECT page_id, host, path, rule,
       coalesce({_VERDICT.format(r="rule")}, CASE WHEN stop.stop THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN stop ON ruled.url = stop.a"""

NEGATIVES = """
WITH t AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS r,
                  [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT a.r AS a, a.vec_id AS anchor_id, t.r, t.vec_id, a.label = t.label AS same, list_dot_product(a.v, t.v)::BIGINT AS score
           FROM t AS a JOIN t ON a.r <> t.r WHERE a.vec_id % 100 = 0),
positive AS (SELECT a, anchor_id, r, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
             QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INT AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.a = p.a AND NOT s.same AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
WINDOW w AS (PARTITION BY p.a, p.r ORDER BY s.score DESC, s.vec_id NULLS LAST) QUALIFY row_number() OVER w <= 10"""

SQL = {"op12_negatives": NEGATIVES, "op4_exact": EXACT, "op5_suffix": SUFFIX, "op6_mix": MIX, "op8_lines": LINES, "op10_urls": URLS}
