r"""DuckDB SQL for the registered queries of this folder that SQL can express.

Tokenizers, trained models, XXH64, CRC-32, rendezvous hashes and vector search
are beyond it; the operators behind those queries are tested by brute force,
round trips and held-out accuracy.
"""

_BLANK = r"\x20\x09-\x0D"
_UNIT = rf"[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

# Okapi-like ranking over every (document, term) pair, no shared sums.
LEXICAL_SEARCH = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
whole AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM doc) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, whole GROUP BY term, n_docs),
asked AS (SELECT DISTINCT item_id, text, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, asked.text, doc_id, r,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * len(terms) * n_docs) // n_terms)))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weight USING (term) JOIN doc USING (r), whole GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST, r))::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

# Every combination of an URL's frequent tokens is counted; the best that a URL holds decides.
URL_RULES = f"""
WITH given(verdict, rule) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'), ('block', 'com/de/')),
rest AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS u FROM pages),
part AS (
  SELECT r, page_id, translate(regexp_extract(u, '^[^/?#]*'), {_LOWER}) AS host, regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(u, '^[^?#]*\\?([^#]*)', 1) AS query FROM rest),
ruled AS (
  SELECT r, arg_max(rule, [length(rule), position('/' IN rule)]) AS rule, arg_max(verdict, [length(rule), position('/' IN rule)]) AS verdict
  FROM part JOIN given ON ('.' || host).ends_with('.' || split_part(rule, '/', 1)) AND path.starts_with(substr(rule, position('/' IN rule))) GROUP BY r),
token AS (
  SELECT r, 'h:' || t AS token FROM (SELECT r, unnest(string_split(host, '.')) AS t FROM part) WHERE t <> ''
  UNION SELECT r, 'p:' || t FROM (SELECT r, unnest(string_split(path, '/')) AS t FROM part) WHERE t <> ''
  UNION SELECT r, 'q:' || split_part(t, '=', 1) FROM (SELECT r, unnest(string_split(query, '&')) AS t FROM part) WHERE split_part(t, '=', 1) <> ''),
least AS (SELECT greatest(1, ceil(0.005::DOUBLE * count(*)))::BIGINT AS n FROM ruled),
frequent AS (SELECT token FROM token JOIN ruled USING (r) GROUP BY token HAVING count(*) >= (SELECT n FROM least)),
held AS (SELECT r, list(token ORDER BY token) AS tokens FROM token SEMI JOIN frequent USING (token) GROUP BY r),
combination AS (
  SELECT r, list_filter(tokens, lambda x, i: (m >> (i - 1)) & 1 = 1) AS c FROM (SELECT r, tokens, unnest(range(1, 1::BIGINT << len(tokens))) AS m FROM held)),
counted AS (
  SELECT c, count(*) AS seen, count(*) FILTER (verdict = 'block') AS block, count(*) FILTER (verdict = 'allow') AS allow
  FROM combination JOIN ruled USING (r) GROUP BY c),
mined AS (
  SELECT c, 'block' AS verdict, block AS support, block / seen AS confidence FROM counted
  UNION ALL SELECT c, 'allow', allow, allow / seen FROM counted),
best AS (
  SELECT r, arg_max(verdict, (confidence, support, verdict = 'block')) AS verdict, max(confidence) AS confidence
  FROM combination ANTI JOIN ruled USING (r) JOIN mined USING (c) WHERE support >= (SELECT n FROM least) AND confidence >= 0.8 GROUP BY r)
SELECT page_id, host, path, rule, coalesce(ruled.verdict, best.verdict, 'allow') AS verdict, best.confidence
FROM part LEFT JOIN ruled USING (r) LEFT JOIN best USING (r)
"""

FILL_IN_MIDDLE = f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS units FROM documents),
number AS (
  SELECT doc_id, t, units, len(units) AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS two,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
cut AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(units[1:least(one, two)], ''), '') AS p,
         coalesce(array_to_string(units[least(one, two) + 1:greatest(one, two)], ''), '') AS m, coalesce(array_to_string(units[greatest(one, two) + 1:], ''), '') AS s
  FROM number)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

ORACLE_SQL = {"op11_lexical_search": LEXICAL_SEARCH, "op12_url_rules": URL_RULES, "op13_fill_in_middle": FILL_IN_MIDDLE}
