"""DuckDB SQL of the registered queries, written from the result contracts."""

from webloom.llm.licenses import TEMPLATES

_NOTICES = ", ".join("({}, '{}', '{}')".format(k, name, notice.replace("'", "''")) for k, (name, notice) in enumerate(TEMPLATES))
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_WS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SQL = {
    "op1_decontaminate": r"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
ig AS (
  SELECT item_id, len(w) AS size, k - 1 AS ipos, w[k:k + 4] AS gram, length(array_to_string(w[k:k + 4], '')) AS wt
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS k FROM i)),
im AS (SELECT item_id, gram, any_value(wt) AS wt, count(*) AS times FROM ig GROUP BY item_id, gram),
iw AS (SELECT item_id, sum(wt) AS weight FROM ig GROUP BY item_id),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
dg AS (
  SELECT doc_id, len(w) AS n, k - 1 AS pos, w[k:k + 4] AS gram, length(array_to_string(w[k:k + 4], '')) AS wt
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS k FROM d)),
win AS (
  SELECT DISTINCT doc_id, item_id, n, size, greatest(least(pos - ipos, n - size), 0) AS start FROM dg JOIN ig USING (gram)),
inside AS (
  SELECT win.doc_id, item_id, start, least(size, win.n) AS n_words, gram, any_value(wt) AS wt, count(*) AS times
  FROM win JOIN dg ON dg.doc_id = win.doc_id AND pos >= start AND pos + 5 <= start + least(size, win.n)
  GROUP BY win.doc_id, item_id, start, least(size, win.n), gram),
s AS (
  SELECT doc_id, inside.item_id, start, n_words, sum(inside.wt * inside.times) AS whole,
         sum(CASE WHEN im.gram IS NULL THEN 0 ELSE inside.wt * least(inside.times, im.times) END) AS common
  FROM inside LEFT JOIN im ON im.item_id = inside.item_id AND im.gram = inside.gram
  GROUP BY doc_id, inside.item_id, start, n_words),
sim AS (
  SELECT doc_id, item_id, start, n_words, CAST(common AS DOUBLE) / CAST(whole + weight - common AS DOUBLE) AS similarity
  FROM s JOIN iw USING (item_id))
SELECT doc_id, item_id, CAST(start AS BIGINT) AS start_word, CAST(n_words AS BIGINT) AS n_words, similarity
FROM sim WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1""",
    "op3_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, greatest(strlen(h) // 2 - 99, 0))) AS p FROM d)),
later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM win) WHERE k > 1),
edges AS (
  SELECT doc_id, p, CASE WHEN p > 1 + lag(p, 1, -1000) OVER w THEN 1 ELSE 0 END AS fresh,
         CASE WHEN p > 100 + lag(p, 1, -1000) OVER w THEN 1 ELSE 0 END AS apart
  FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
spans AS (
  SELECT doc_id, min(p) AS first, max(p) + 100 AS last
  FROM (SELECT doc_id, p, sum(apart) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM edges) GROUP BY doc_id, g),
stay AS (
  SELECT d.doc_id, h, coalesce(first, strlen(h) // 2) AS upto, last,
         lag(last, 1, 0) OVER (PARTITION BY d.doc_id ORDER BY first) AS since,
         row_number() OVER (PARTITION BY d.doc_id ORDER BY first) AS k FROM d LEFT JOIN spans ON d.doc_id = spans.doc_id),
pieces AS (
  SELECT doc_id, h, k, since, upto, last FROM stay
  UNION ALL
  SELECT doc_id, h, k + 1, last, strlen(h) // 2, NULL FROM stay
  WHERE last IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY k DESC) = 1)
SELECT doc_id, CAST(any_value(strlen(h) // 2) AS BIGINT) AS n_bytes,
       CAST(any_value(strlen(h) // 2) - sum(upto - since) AS BIGINT) AS n_removed,
       count(last) AS n_spans,
       sha256(unhex(string_agg(substr(h, 2 * since + 1, 2 * (upto - since)), '' ORDER BY k))) AS kept_sha256
FROM pieces GROUP BY doc_id""",
    "op4_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 48, 1))) AS p FROM d)),
firsts AS (SELECT s, min(doc_id) AS holder FROM win GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS pos FROM win JOIN firsts USING (s) WHERE holder < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
judged AS (SELECT words.doc_id, word, words.pos, gone.pos IS NOT NULL AS cut
           FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.pos = gone.pos),
kept AS (SELECT doc_id, count(*) FILTER (cut) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT cut) AS text
         FROM judged GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op6_jaccard_join": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, w[p:p + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3)
  UNION ALL
  SELECT doc_id, w FROM d WHERE len(w) BETWEEN 1 AND 2),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes sa ON sa.doc_id = a.doc_id JOIN sizes sb ON sb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(sa.n) + any_value(sb.n) - count(*))),
reach(doc_id, other) AS (
  SELECT a, b FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id
FROM d LEFT JOIN sizes ON d.doc_id = sizes.doc_id LEFT JOIN reach ON d.doc_id = reach.doc_id GROUP BY d.doc_id""",
    "op2_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, translate(trim(line, {_WS}), {_LOWER}) AS key FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.line, k.pos, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op5_warc": f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html,
         CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits
  FROM pages),
q AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes,
         array_to_string(list_transform(range(0, 160, 5), lambda i: substr('{_BASE32}', 1 + CAST(
           16 * CAST(bits[i + 1] AS INT) + 8 * CAST(bits[i + 2] AS INT) + 4 * CAST(bits[i + 3] AS INT)
           + 2 * CAST(bits[i + 4] AS INT) + CAST(bits[i + 5] AS INT) AS INT), 1)), '') AS payload_digest
  FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM k""",
    "op9_licenses": rf"""
WITH notices(template, license, notice) AS (VALUES {_NOTICES}),
tw AS (SELECT template, license, string_split(lower(trim(regexp_replace(notice, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM notices),
tg AS (SELECT DISTINCT template, license, w[i] AS x, w[i + 1] AS y
       FROM (SELECT template, license, w, unnest(range(1, len(w))) AS i FROM tw)),
tn AS (SELECT *, count(*) OVER (PARTITION BY template) AS b FROM tg),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
u AS (
  SELECT doc_id, 'line' AS kind, unnest(string_split(t, chr(10))) AS unit, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d
  UNION ALL
  SELECT doc_id, kind, unit, pos FROM (
    SELECT doc_id, 'paragraph' AS kind, unnest(string_split_regex(t, '\n[ \t\r]*\n')) AS unit,
           generate_subscripts(string_split_regex(t, '\n[ \t\r]*\n'), 1) AS pos FROM d) WHERE contains(unit, chr(10))
  UNION ALL
  SELECT doc_id, 'text', t, 1 FROM d WHERE regexp_matches(t, '\n[ \t\r]*\n')),
uw AS (SELECT doc_id, kind, pos, string_split(lower(trim(regexp_replace(unit, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM u),
ug AS (SELECT DISTINCT doc_id, kind, pos, w[i] AS x, w[i + 1] AS y
       FROM (SELECT doc_id, kind, pos, w, unnest(range(1, len(w))) AS i FROM uw WHERE len(w) >= 2)),
un AS (SELECT *, count(*) OVER (PARTITION BY doc_id, kind, pos) AS a FROM ug),
s AS (SELECT doc_id, kind, pos, template, license, 2.0::DOUBLE * count(*) / (any_value(a) + any_value(b)) AS dice
      FROM un JOIN tn ON un.x = tn.x AND un.y = tn.y GROUP BY ALL)
SELECT doc_id, license, max(dice) AS dice, count(DISTINCT (kind, pos)) AS n_units
FROM s WHERE dice >= 0.8 GROUP BY doc_id, license""",
    "op10_quality_rules": rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
triples AS (
  SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM d)),
seen AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM triples),
again AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM seen WHERE n > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS line FROM d),
worded AS (
  SELECT doc_id, host, line, translate(trim(line, {_WS}), {_LOWER}) AS key,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM lines WHERE trim(line, {_WS}) <> ''),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
hot AS (
  SELECT host, key, min(doc_id) AS holder FROM worded GROUP BY host, key HAVING count(DISTINCT doc_id) > 100),
lost AS (
  SELECT w.doc_id, sum(n) AS n_all, sum(CASE WHEN h.key IS NOT NULL AND h.holder <> w.doc_id THEN n ELSE 0 END) AS n_cut
  FROM worded w LEFT JOIN hot h ON w.host = h.host AND w.key = h.key GROUP BY w.doc_id),
base AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(100 * (n_all - n_cut) < 50 * n_all, false) AS depleted
  FROM d LEFT JOIN dups ON d.doc_id = dups.doc_id LEFT JOIN again ON d.doc_id = again.doc_id
  LEFT JOIN lost ON d.doc_id = lost.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT depleted AS kept
FROM base""",
    "op11_vector_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach(vec_id, other) AS (
  SELECT a, b FROM links UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a),
lowest AS (SELECT vec_id, min(other) AS low FROM reach GROUP BY vec_id),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, coalesce(low, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(low, v.vec_id) AS kept
FROM v LEFT JOIN lowest USING (vec_id) LEFT JOIN counted ON v.vec_id = counted.a""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(CASE WHEN len(a.e) = 0 THEN 0 ELSE list_dot_product(a.e, b.e) END AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 5""",
    "op13_spelling_variants": f"""
WITH RECURSIVE bits(byte, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT byte, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY byte) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), {_LOWER}) AS w FROM documents),
per_doc AS (
  SELECT w, count(*) AS times, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x
  FROM runs WHERE length(w) >= 6 GROUP BY doc_id, w),
hashed AS (
  SELECT w, times, xor(list_reduce(
      list_transform(range(0, length(x) // 2), lambda i: CAST(('0x' || substr(x, 2 * i + 1, 2)) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295), 4294967295) AS h
  FROM per_doc, crc_table),
planted AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, times
  FROM hashed),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM planted WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
gaps AS (
  SELECT word, n, length(word) AS size, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM words, unnest(range(1, length(word) + 1)) AS g(i)),
near AS (
  SELECT a.word AS word, b.word AS other FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.size = b.size AND a.word <> b.word
  UNION SELECT a.word, b.word FROM gaps a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM gaps a JOIN words b ON a.rest = b.word),
forms AS (
  SELECT near.word, count(*) AS n_near, max(o.n) AS top, arg_min(other, struct_pack(n := -o.n, w := other)) AS best
  FROM near JOIN words o ON o.word = near.other GROUP BY near.word),
pointed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * words.n THEN best END AS form,
         CASE WHEN top >= 5 * words.n THEN top END AS form_n
  FROM words LEFT JOIN forms ON words.word = forms.word),
climb(word, step, depth) AS (
  SELECT word, word, 0 FROM pointed
  UNION ALL
  SELECT climb.word, pointed.form, depth + 1 FROM climb JOIN pointed ON pointed.word = climb.step WHERE pointed.form IS NOT NULL)
SELECT pointed.word, form, root, n, n_near, form_n
FROM pointed JOIN (SELECT word, arg_max(step, depth) AS root FROM climb GROUP BY word) USING (word)""",
}
