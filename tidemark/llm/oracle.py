"""The same answers in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)",
    "ssn": r"[0-9-]+",
    "secret": r"[A-Za-z0-9+/_-]{16,}",
}
_FOUND = " UNION ALL ".join(
    f"""SELECT r, {i} AS o, '{kind}' AS kind, regexp_extract_all(t, '{pattern}') AS f,
        string_split_regex(t, '{pattern}') AS g FROM docs"""
    for i, (kind, pattern) in enumerate(_KINDS.items())
)


def _either_case(words: str) -> str:
    """The pattern with each letter in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_VALUE = r"""["'']?\x20*[:=]\x20*["'']?"""
_SECRETS = {
    "assign": rf"({_either_case('password|passwd|secret|token|api_?key')}){_VALUE}([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
    "user": "("
    + _either_case("username|user|login|account|client_?id|access_?key_?id")
    + rf"){_VALUE}([A-Za-z0-9@+_.-]+)",
    "blob": "[A-Za-z0-9+/_=-]+",
    "url": "(?:https?|ftp|ssh|s3|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9:/_.@?=&%+~-]+",
    "host": rf"({_either_case('hostname|host|endpoint|server')}){_VALUE}([A-Za-z0-9:/_.-]+)",
    "break": r"\n[\x20\t]*\n",
}
_SECRETS_FOUND = " UNION ALL ".join(
    f"""SELECT r, {i} AS o, '{kind}' AS kind, regexp_extract_all(t, '{pattern}') AS f,
        {f"regexp_extract_all(t, '{pattern}', 2)" if _VALUE in pattern else "NULL::VARCHAR[]"} AS v,
        string_split_regex(t, '{pattern}') AS g FROM docs"""
    for i, (kind, pattern) in enumerate(_SECRETS.items())
)

ORACLE = {
    "op1_line_dedup": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS rid,
         text IS NULL AS missing, md5(coalesce(text, '')) AS digest,
         string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents),
lines AS (
  SELECT r, rid, digest, unnest(range(len(l))) AS i, unnest(l) AS line FROM docs),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM lines),
cuts AS (
  SELECT r, rid, digest, i, line,
         (h + 31 * coalesce(lag(h) OVER (PARTITION BY r ORDER BY i), 0)) % 3 = 0 AS ends
  FROM hashed),
numbered AS (
  SELECT *, coalesce(sum(CAST(ends AS INTEGER)) OVER (PARTITION BY r ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k
  FROM cuts),
chunks AS (
  SELECT r, rid, digest, k, min(i) AS b, max(i) + 1 AS e,
         string_agg(line, chr(10) ORDER BY i) AS chunk
  FROM numbered GROUP BY r, rid, digest, k HAVING count(*) >= 2),
firsts AS (SELECT chunk, min({'rid': rid, 'digest': digest, 'k': k}) AS f FROM chunks GROUP BY chunk),
gone AS (
  SELECT r, b, e FROM chunks JOIN firsts USING (chunk)
  WHERE {'rid': rid, 'digest': digest, 'k': k} <> f),
lost AS (SELECT r, count(*) AS n, sum(e - b) AS m FROM gone GROUP BY r),
left_over AS (
  SELECT n.r, string_agg(line, chr(10) ORDER BY i) AS t
  FROM numbered n LEFT JOIN gone g ON n.r = g.r AND n.i >= g.b AND n.i < g.e
  WHERE g.r IS NULL GROUP BY n.r)
SELECT doc_id, CAST(CASE WHEN missing THEN 0 ELSE len(l) END AS BIGINT) AS n_lines,
       CAST(coalesce(n, 0) AS BIGINT) AS n_chunks_removed,
       CAST(coalesce(m, 0) AS BIGINT) AS n_lines_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN lost USING (r) LEFT JOIN left_over USING (r)
""",
    "op3_ngram_jaccard_join": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct([array_to_string(w[i : i + 4], ' ')
           FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS s
  FROM docs WHERE len(w) > 0),
members AS (SELECT doc_id, len(s) AS n, md5_number_lower(unnest(s)) AS gram FROM sets),
held AS (SELECT gram, count(*) AS df FROM members GROUP BY gram HAVING count(*) > 1),
shared AS (SELECT doc_id, n, gram FROM members JOIN held USING (gram)),
able AS (SELECT doc_id FROM shared GROUP BY doc_id, n HAVING 100 * count(*) >= 75 * n),
kept AS (SELECT s.* FROM shared s JOIN able USING (doc_id)),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS i
  FROM kept a JOIN kept b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (SELECT u, v FROM pairs WHERE 100 * i >= 75 * (m + n - i)),
reach AS (
  SELECT u AS doc_id, u AS r FROM links
  UNION
  SELECT l.u, reach.r FROM links l JOIN reach ON l.v = reach.doc_id),
least AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(s), 0) AS BIGINT) AS n_shingles,
       coalesce(r, d.doc_id) AS component_id
FROM docs d LEFT JOIN sets USING (doc_id) LEFT JOIN least USING (doc_id)
""",
    "op6_personal_data": rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
placed AS (
  SELECT r, o, kind, unnest(f) AS m, unnest(g[: len(f)]) AS gap,
         unnest([list_sum(list_transform(g[: i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(f[: i - 1], lambda x: length(x))), 0)
                 FOR i IN range(1, len(f) + 1)]) AS s
  FROM found WHERE len(f) > 0),
read AS (
  SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d, right(gap, 40) AS before,
         replace(m, ' ', '') AS code FROM placed),
tested AS (
  SELECT r, o, kind, s, s + length(m) AS e,
    CASE kind WHEN 'email' THEN true
    WHEN 'ip' THEN list_bool_and([length(ltrim(x, '0')) <= 3 AND
           CAST('0' || right(x, 3) AS INTEGER) <= 255 FOR x IN string_split(m, '.')])
    WHEN 'phone' THEN length(d) BETWEEN 10 AND 15
    WHEN 'card' THEN length(d) BETWEEN 14 AND 19 AND list_sum([
           CASE WHEN i % 2 = 1 THEN CAST(reverse(d)[i] AS INTEGER)
                WHEN CAST(reverse(d)[i] AS INTEGER) > 4 THEN 2 * CAST(reverse(d)[i] AS INTEGER) - 9
                ELSE 2 * CAST(reverse(d)[i] AS INTEGER) END
           FOR i IN range(1, length(d) + 1)]) % 10 = 0
    WHEN 'iban' THEN list_reduce(
           [0] || [CASE WHEN c BETWEEN '0' AND '9' THEN CAST(c AS INTEGER) ELSE ord(c) - 55 END
                   FOR c IN string_split(code[5:] || code[:4], '')],
           lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1
    WHEN 'ssn' THEN regexp_matches(m, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$')
         AND NOT regexp_matches(m, '^000|^666|^9|-00-|-0000$')
         AND regexp_matches(before, '(?i)(?:^|[^a-z])(?:ssn|social|security|insurance)(?:[^a-z]|$)')
    ELSE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND regexp_matches(before,
           '(?i)(?:password|passwd|secret|token|api[_ -]?key)["'']? *[:=] *["'']?$') END AS ok
  FROM read),
spans AS (SELECT *, kind || ':' || s || ':' || e AS w FROM tested WHERE ok),
lists AS (
  SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(w, ',' ORDER BY s, o) FILTER (o < 4) AS base,
         string_agg(w, ',' ORDER BY s, o) AS spans
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip,
       coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN lists USING (r)
""",
    "op4_benchmark_decontamination": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         unnest([array_to_string(w[i : i + least(len(w), 10) - 1], ' ')
                 FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS gram
  FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS start,
         unnest([array_to_string(w[i : i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS gram
  FROM docs, sizes WHERE len(w) >= n),
found AS (SELECT r, start, n, item_id FROM grams JOIN windows USING (n, gram)),
hits AS (
  SELECT r, count(DISTINCT place) AS n_hit
  FROM (SELECT r, unnest(range(start, start + n)) AS place FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), 'null') AS id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
""",
    "op8_suffix_array_dedup": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (
  SELECT r, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM docs WHERE length(h) >= 400),
windows AS (SELECT r, p, md5(substr(h, 2 * p + 1, 400)) AS w FROM places),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
starts AS (SELECT r, p FROM windows JOIN twice USING (w)),
runs AS (
  SELECT r, p, sum(CAST(p > coalesce(before + 200, -1) AS INTEGER)) OVER (
           PARTITION BY r ORDER BY p ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM starts)),
spans AS (SELECT r, min(p) AS b, max(p) + 200 AS e FROM runs GROUP BY r, run),
gaps AS (
  SELECT r, e AS b, lead(b, 1, 1000000000) OVER (PARTITION BY r ORDER BY b) AS e FROM spans
  UNION ALL SELECT r, 0, min(b) FROM spans GROUP BY r),
kept AS (
  SELECT r, string_agg(substr(h, 2 * b + 1, 2 * (e - b)), '' ORDER BY b) AS k
  FROM gaps JOIN docs USING (r) GROUP BY r),
lost AS (SELECT r, sum(e - b) AS n, count(*) AS m FROM spans GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(m, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM docs LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
""",
    "op11_secret_scan": rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_SECRETS_FOUND}),
placed AS (
  SELECT r, o, kind, unnest(f) AS m, unnest(coalesce(v, f)) AS v,
         unnest([list_sum(list_transform(g[: i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(f[: i - 1], lambda x: length(x))), 0)
                 FOR i IN range(1, len(f) + 1)]) AS s
  FROM found WHERE len(f) > 0),
spans AS (
  SELECT r, o, kind, s, s + length(m) AS e,
         CASE WHEN kind IN ('access', 'user') THEN 'who' WHEN kind IN ('url', 'host') THEN 'where'
              WHEN kind = 'break' THEN NULL ELSE 'by' END AS role
  FROM placed
  WHERE CASE kind WHEN 'assign' THEN length(v) >= 6 WHEN 'access' THEN length(m) >= 20
    WHEN 'hex' THEN length(m) >= 24 WHEN 'user' THEN length(v) >= 3 WHEN 'host' THEN length(v) >= 3
    WHEN 'blob' THEN length(m) >= 16 AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')
         AND regexp_matches(m, '[0-9]')
    ELSE true END),
scoped AS (
  SELECT *, count(CASE WHEN kind = 'break' THEN 1 END) OVER (PARTITION BY r ORDER BY s, o) AS scope
  FROM spans),
parts AS (
  SELECT * FROM scoped a WHERE kind <> 'break' AND NOT (kind = 'blob' AND EXISTS (
    SELECT 1 FROM spans b WHERE a.r = b.r AND b.kind NOT IN ('blob', 'break')
       AND b.s < a.e AND a.s < b.e))),
linked AS (
  SELECT DISTINCT a.r, a.o, a.s FROM parts a JOIN parts b ON a.r = b.r AND a.scope = b.scope
     AND (a.role = 'by') <> (b.role = 'by') AND greatest(b.s - a.e, a.s - b.e) <= 200),
kept AS (
  SELECT r, o, kind, s, kind || ':' || s || ':' || e AS w FROM parts
  WHERE o < 3 OR (r, o, s) IN (SELECT (r, o, s) FROM linked)),
lists AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(w, ',' ORDER BY s, o) FILTER (o < 3) AS base,
         string_agg(w, ',' ORDER BY s, o) AS spans
  FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM docs LEFT JOIN lists USING (r)
""",
    "op12_importance_resampling": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
uses AS (
  SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM docs) GROUP BY r, word),
wanted AS (SELECT word, count(*) AS n FROM items GROUP BY word),
steps AS (
  SELECT [list_reduce([n] || range(8), lambda c, i:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
          FOR n IN range(256)] AS step),
bucket AS (
  SELECT word, xor(list_reduce(
           [4294967295] || [CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)
                            FOR i IN range(length(h) // 2)],
           lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b
  FROM (SELECT word, hex(encode(word)) AS h FROM
        (SELECT word FROM uses UNION SELECT word FROM wanted)), steps),
corpus AS (SELECT b, sum(n) AS s FROM uses JOIN bucket USING (word) GROUP BY b),
target AS (SELECT b, sum(n) AS t FROM wanted JOIN bucket USING (word) GROUP BY b),
totals AS (
  SELECT CAST((SELECT coalesce(sum(s), 0) FROM corpus) AS DOUBLE) AS all_s,
         CAST((SELECT coalesce(sum(t), 0) FROM target) AS DOUBLE) AS all_t),
gain AS (
  SELECT b, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (all_s + 10000)
                                 / ((CAST(s AS DOUBLE) + 1) * (all_t + 10000)))) AS BIGINT) AS g
  FROM corpus LEFT JOIN target USING (b), totals),
weights AS (
  SELECT r, sum(n) AS n, CAST(sum(n * g) AS BIGINT) AS total
  FROM uses JOIN bucket USING (word) JOIN gain USING (b) GROUP BY r),
scored AS (
  SELECT r, doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
         CAST(CASE WHEN n IS NULL THEN 0
              ELSE (total - ((total % n) + n) % n) // n END AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM docs LEFT JOIN weights USING (r)),
noisy AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT)
           AS score
  FROM scored),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able
  FROM noisy WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CAST(CASE WHEN rank <= 10 * able // 100 THEN rank END AS BIGINT) AS rank
FROM noisy LEFT JOIN ranked USING (r)
""",
}
