"""DuckDB SQL of the queries that SQL can express, written apart from the Spark forms."""

from __future__ import annotations

from clearbid.llm import decontaminate, divergence, filter_audit, licenses, line_dedup, quality

WORDS = r"regexp_extract_all({t}, '[^\x20\x09-\x0D]+')"
# only A-Z, as lower() would change other letters too
LOW = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"regexp_extract_all({t}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {WORDS.format(t='text')} AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs),
win AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM w, unnest(generate_series(1, len(w) - 2)) AS t(i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
base AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < {quality.MIN_WORDS} AS short, 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS repeats,
             10 * n_symbols > 3 * n_words AS symbols, 2 * n_dup_lines > n_lines AS dup_lines FROM base),
hosts AS (SELECT source, rule, count(*) AS n, sum(CAST(bad AS INT)) AS k
          FROM (SELECT source, unnest(['short', 'repeats', 'symbols', 'dup_lines']) AS rule,
                       unnest([short, repeats, symbols, dup_lines]) AS bad FROM f) GROUP BY ALL),
means AS (SELECT rule, sum(k) / sum(n) AS mean, sum(n) AS total, count(*) AS m FROM hosts GROUP BY rule),
prior AS (SELECT rule, any_value(mean) AS mean, any_value(mean * (1 - mean)) AS within,
                 sum(n * (k / n - mean) ** 2) / any_value(total) - any_value(mean * (1 - mean) * (m - 1) / total) AS between
          FROM hosts JOIN means USING (rule) GROUP BY rule),
strength AS (SELECT rule, mean, least({quality.MAX_STRENGTH}, greatest({quality.MIN_STRENGTH},
                    CASE WHEN between <= within / {quality.MAX_STRENGTH} THEN {quality.MAX_STRENGTH} ELSE within / between - 1 END)) AS s FROM prior),
rates AS (SELECT source, n, s, mean, (k + s * mean) / (n + s) AS rate FROM hosts JOIN strength USING (rule)),
verdict AS (SELECT source, bool_or(rate - {quality.BOUND} * sqrt(rate * (1 - rate) / (n + s + 1)) > greatest({quality.HOST_LIMIT}, {quality.HOST_TIMES} * mean)) AS rejected
            FROM rates GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
       NOT (short OR repeats) AND NOT rejected AS kept
FROM f JOIN verdict v ON f.source IS NOT DISTINCT FROM v.source"""

OP3 = r"""
WITH rec AS (
  SELECT page_id * 3 AS record_id, url, 0 * 86400 + page_id % 86400 AS ts, true AS whole, page_id,
         left(md5(coalesce(html, '')), 16) AS etag, '2024-01-01' AS modified, CAST(strlen(html) AS VARCHAR) AS size FROM pages
  UNION ALL
  SELECT page_id * 3 + 1, CASE WHEN page_id % 2 = 0 THEN regexp_replace(url, '^http://', 'https://') ELSE url || '#again' END,
         3 * 86400 + page_id % 86400, false, page_id,
         CASE WHEN page_id % 7 = 0 THEN 'other' ELSE 'W/' || left(md5(coalesce(html, '')), 16) END, NULL, NULL FROM pages
  UNION ALL
  SELECT page_id * 3 + 2, url, 6 * 86400 + page_id % 86400, page_id % 5 = 0, page_id,
         CASE WHEN page_id % 5 = 0 THEN 'changed' END, '2024-01-01', NULL FROM pages),
cut AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM rec),
part AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^.*@', ''), ':(80|443)$', ''), '^www\.', '') AS host,
                regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/(index\.html?)?$', '') AS path,
                regexp_replace(regexp_replace(regexp_extract(u, '\?(.*)$', 1), '(^|&)(utm_[a-z]*|ref)=[^&]*', '', 'g'), '^&', '') AS query FROM cut),
c AS (SELECT *, host || path || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical_url FROM part),
revisit AS (SELECT * FROM c WHERE NOT whole),
ref AS (SELECT v.record_id, max_by(f.record_id, (f.ts, f.record_id)) AS ref_id
        FROM revisit v JOIN c f ON f.whole AND f.canonical_url = v.canonical_url AND f.ts < v.ts GROUP BY v.record_id),
j AS (SELECT v.*, f.record_id AS ref_id, f.etag AS f_etag, f.modified AS f_modified, f.size AS f_size,
             coalesce(regexp_replace(v.etag, '^W/', '') = regexp_replace(f.etag, '^W/', ''), v.modified = f.modified) AS same,
             f.page_id % 5 = 0 AND f.record_id % 3 = 2 AS changed,
             CASE WHEN f.record_id % 3 = 2 THEN '2024-01-07' END AS f_date
      FROM revisit v LEFT JOIN ref r ON r.record_id = v.record_id LEFT JOIN c f ON f.record_id = r.ref_id),
o AS (SELECT *, CASE WHEN ref_id IS NULL THEN 'no earlier response' WHEN same IS NULL THEN 'unverified'
                     WHEN same THEN 'resolved' ELSE 'validators differ' END AS outcome FROM j)
SELECT record_id, canonical_url, CASE WHEN outcome IN ('resolved', 'unverified') THEN ref_id END AS ref_record_id, outcome,
  CASE WHEN outcome IN ('resolved', 'unverified') THEN array_to_string(list_sort(list_filter([
    CASE WHEN NOT changed THEN 'content-length=' || coalesce(f_size, '') END,
    CASE WHEN NOT changed THEN 'content-type=text/html' END,
    'etag=' || coalesce(etag, f_etag),
    'last-modified=' || coalesce(modified, f_modified),
    CASE WHEN record_id % 3 = 1 THEN 'expires=2024-02-01' END,
    'date=' || CASE WHEN record_id % 3 = 2 THEN '2024-01-07' ELSE f_date END], lambda x: x IS NOT NULL)), ';') END AS headers
FROM o"""

BARE = "trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
OP4 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, source, i, line, {BARE.format(x='line')} AS bare
      FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)),
pages AS (SELECT source, count(*) AS n FROM docs GROUP BY source),
bad AS (SELECT l.source, bare FROM l JOIN pages p ON l.source IS NOT DISTINCT FROM p.source WHERE bare <> ''
        GROUP BY l.source, bare, p.n HAVING count(DISTINCT r) >= {line_dedup.MIN_PAGES} AND count(DISTINCT r) > {line_dedup.RATIO} * p.n),
long AS (SELECT DISTINCT md5('v' || text) AS page, bare FROM l JOIN docs USING (r)
         WHERE len(regexp_extract_all(bare, '[^\\x20\\x09-\\x0D]+')) > {line_dedup.LONG_WORDS}),
passage AS (SELECT bare, min(page) AS keeper FROM long GROUP BY bare HAVING count(*) >= {line_dedup.MIN_PAGES}),
marked AS (SELECT l.r, l.i, l.line, b.bare IS NOT NULL OR coalesce(p.keeper <> md5('v' || d.text), false) AS gone
           FROM l JOIN docs d USING (r) LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.bare = b.bare
           LEFT JOIN passage p ON p.bare = l.bare),
j AS (SELECT r, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS clean, count(*) FILTER (gone) AS n FROM marked GROUP BY r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_dropped,
       CASE WHEN coalesce(n, 0) = 0 THEN text ELSE coalesce(clean, '') END AS text FROM docs LEFT JOIN j USING (r)"""

_TEMPLATES = ", ".join(f"({k}, '{label}', '{words}', {licenses.names_of(words)}::VARCHAR[])" for k, (label, words) in enumerate(licenses.TEMPLATES))
_PHRASES = ", ".join(f"('{p}', '{label}')" for p, label in licenses.PHRASES.items())
OP5 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {LOW.format(t="coalesce(text, '')")} AS low FROM documents),
d AS (SELECT *, {ALNUM.format(t='low')} AS w FROM docs),
phrases AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES {_PHRASES}) AS t(p, label)),
found AS (SELECT r, label, i - 1 AS i FROM (SELECT r, w, unnest(generate_series(1, len(w))) AS i FROM d), phrases
       WHERE w[i:i + len(p) - 1] = p),
templates AS (SELECT t, label, list_distinct(string_split(x, ' ')) AS x, names FROM (VALUES {_TEMPLATES}) AS t(t, label, x, names)),
split AS (SELECT r, string_split(low, chr(10)) AS lines FROM docs),
runs AS (SELECT r, list_distinct({ALNUM.format(t='lines[i]')}) AS own,
                list_distinct({ALNUM.format(t=f"array_to_string(lines[i:i + {licenses.RUN_LINES - 1}], chr(10))")}) AS b
         FROM split, unnest(generate_series(1, len(lines))) AS t(i)),
shares AS (SELECT r, label, names, b, len(x) AS size, len(list_intersect(b, x)) AS shared, len(list_intersect(own, x)) AS alone,
                  ceil({licenses.CONTAINMENT} * len(x) - 1e-9) AS need FROM runs, templates),
met AS (SELECT r, label, shared / size AS share FROM shares
        WHERE shared >= need AND len(list_intersect(names, b)) = len(names) AND (size >= {licenses.SHORT} OR shared = size OR alone >= need)),
base AS (SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM found GROUP BY r),
own AS (SELECT r, max(share) AS best, list(DISTINCT label) AS labels FROM met GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base,
       CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ','), '') AS labels,
       CAST(CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS DOUBLE) AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN own USING (r)"""

_BOTH = "<|im_end|><|im_start|>assistant ok"
OP6 = f"""
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations UNION ALL VALUES (-1, 0, 'user', '{_BOTH}'), (-1, 1, 'assistant', '{_BOTH}')),
e AS (SELECT *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS esc,
             regexp_replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), '<(\\\\*)\\|', '<\\\\\\1|', 'g') AS erole FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length(erole) + 1 + length(esc) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

OP7 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {ALNUM.format(t=LOW.format(t="coalesce(text, '')"))} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {ALNUM.format(t=LOW.format(t="coalesce(text, '')"))} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least({decontaminate.WINDOW}, len(w)) AS k, array_to_string(w[i:i + least({decontaminate.WINDOW}, len(w)) - 1], ' ') AS g
       FROM b, unnest(generate_series(1, len(w) - least({decontaminate.WINDOW}, len(w)) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM d, sizes, unnest(generate_series(1, len(w) - k + 1)) AS t(i)),
hit AS (SELECT r, i, k, item FROM dw JOIN bw USING (k, g)),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AND {decontaminate.SHARE} * coalesce(words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {LOW.format(t="coalesce(text, '')")} AS low FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(low, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
langs AS (SELECT lang, count(term) AS v, coalesce(sum(ln), 0) AS ltotal FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.ln FROM g JOIN kept k ON g.lang = k.lang
          LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
totals AS (SELECT lang, source, sum(n) AS total FROM dense GROUP BY ALL),
p AS (SELECT lang, source, term, n, 1 + {divergence.UNIT}::HUGEINT * (n + 2) // (total + 2 * v) AS p,
             1 + {divergence.UNIT}::HUGEINT * (ln + 2) // (ltotal + 2 * v) AS q FROM dense JOIN totals USING (lang, source) JOIN langs USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
         UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}"""

OP12 = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {WORDS.format(t='t')} AS w FROM d),
m AS (SELECT doc_id, part,
    CASE WHEN len(w) < {filter_audit.MIN_WORDS} THEN 'A' ELSE '' END ||
    CASE WHEN 100 * len(list_distinct(w)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(w) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {filter_audit.MAX_UPPER_PERCENT} * length(t) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(t, '{filter_audit.SYMBOLS}') THEN 'D' ELSE '' END ||
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM w),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL)) AS good,
                 count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)) AS toxic FROM m GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (SELECT o, step, substr(o, step, 1) AS f, left(o, step - 1) AS before FROM orders, unnest(generate_series(1, 5)) AS s(step)),
x AS (SELECT part, o, step, f, n, good, toxic, contains(fails, f) AS bad, length(translate(before, fails, '')) < length(before) AS gone, fails = f AS alone
      FROM cells, steps),
t AS (SELECT part, o, step, f, coalesce(sum(n) FILTER (NOT gone AND NOT bad), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND bad), 0) AS removed,
             coalesce(sum(n) FILTER (gone AND bad), 0) AS redundant, coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
             coalesce(sum(good) FILTER (NOT gone AND bad), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND bad), 0) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, o AS filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM t"""

ORACLES = {"op2_quality": OP2, "op3_revisits": OP3, "op4_line_dedup": OP4, "op5_licenses": OP5, "op6_chat": OP6, "op7_decontaminate": OP7,
           "op11_divergence": OP11, "op12_filter_audit": OP12}
