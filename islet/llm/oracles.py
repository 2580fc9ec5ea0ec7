"""SQL twins of the queries that SQL can say."""

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

CHAT = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i FROM t),
p AS (SELECT conv_id, i, string_agg(coalesce('=' || role, '-') || chr(1) || coalesce('=' || text, '-') || chr(2), '') OVER (PARTITION BY conv_id ORDER BY i) AS prefix FROM o),
whole AS (SELECT conv_id, max(i) AS n_turns, arg_max(prefix, i) AS prefix FROM p GROUP BY conv_id),
one AS (SELECT min(conv_id) AS conv_id, n_turns, prefix FROM whole GROUP BY n_turns, prefix),
kept AS (SELECT conv_id, n_turns FROM one WHERE NOT EXISTS (SELECT 1 FROM p JOIN whole w USING (conv_id) WHERE p.i = one.n_turns AND p.prefix = one.prefix AND w.n_turns > p.i))
SELECT conv_id, n_turns, string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '' ORDER BY i) AS rendered
FROM kept JOIN o USING (conv_id) GROUP BY conv_id, n_turns"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY a.r, b.r),
links AS (SELECT a, b FROM shared JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach(r, t) AS (SELECT r, r FROM n UNION SELECT reach.r, l.b FROM reach JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = reach.t)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, CASE WHEN n.n IS NULL THEN doc_id ELSE c.component_id END AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN (SELECT reach.r, min(x.doc_id) AS component_id FROM reach JOIN d x ON x.r = reach.t GROUP BY reach.r) c USING (r)"""

SUFFIXES = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS o, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, o, i, substring(h, 2 * i + 1, 100) AS s FROM (SELECT *, unnest(range(0, length(h) // 2 - 49)) AS i FROM d)),
hit AS (SELECT r, i FROM (SELECT r, o, i, min(o) OVER (PARTITION BY s) AS low FROM w) WHERE low < o),
edge AS (SELECT r, i, i > lag(i) OVER (PARTITION BY r ORDER BY i) + 50 AS apart FROM hit),
run AS (SELECT r, i, count(*) FILTER (apart) OVER (PARTITION BY r ORDER BY i) AS k FROM edge),
span AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY r, k),
cut AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS was FROM span),
gone AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substring(h, 2 * was + 1, 2 * (a - was)), '' ORDER BY a) AS kept, max(b) AS last FROM cut JOIN d USING (r) GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
 sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN gone USING (r)"""

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i : i + 7], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
again AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
rep AS (SELECT r, CAST(sum(least(8, coalesce(later - i, 8))) AS BIGINT) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS later FROM again) GROUP BY r),
line AS (SELECT r, source, trim(lower(regexp_replace(l, '[\x20\x09\x0B-\x0D]+', ' ', 'g'))) AS l FROM (SELECT r, source, unnest(string_split(t, chr(10))) AS l FROM d)),
host AS (SELECT source, count(DISTINCT r) AS n FROM line WHERE l <> '' GROUP BY source),
counted AS (SELECT source, l, count(DISTINCT r) AS n FROM line WHERE l <> '' GROUP BY source, l),
often AS (SELECT c.source, l FROM counted c JOIN host h ON h.source IS NOT DISTINCT FROM c.source WHERE c.n > 5 AND c.n > CAST(0.01 AS DOUBLE) * h.n),
lost AS (SELECT r, sum(len(string_split(l, ' '))) AS n FROM line x WHERE EXISTS (SELECT 1 FROM often o WHERE o.l = x.l AND o.source IS NOT DISTINCT FROM x.source) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
  len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed_words FROM d LEFT JOIN rep USING (r) LEFT JOIN lost USING (r))
SELECT *, NOT base_failed AND NOT n_removed_words > 0.5 * n_words AS kept FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)"""

#: CRC-32 of a text's UTF-8 bytes, byte by byte over a table that a recursion makes.
CRC_TABLE = """
WITH RECURSIVE bit(i, k, c) AS (SELECT i, 0, i FROM range(256) t(i) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bit WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM bit WHERE k = 8)"""
CRC = "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(hex(encode({0}))) // 2), lambda i: ('0x' || substring(hex(encode({0})), 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"

VARIANTS = CRC_TABLE + rf""",
run AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || w AS k, w, count(*) AS times FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents) GROUP BY doc_id, w),
hashed AS (SELECT w, times, {CRC.format("k")} AS h FROM run, crc),
typed AS (SELECT CASE WHEN h % 97 = 0 THEN substring(w, 1, (h % length(w))::INT) || substring(w, (h % length(w))::INT + 2) ELSE w END AS word, times FROM hashed),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cut AS (SELECT word, n, i, substring(word, 1, i::INT - 1) AS a, substring(word, i::INT + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT x.word, y.word AS near, y.n FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.i = y.i AND x.word <> y.word
 UNION SELECT c.word, v.word, v.n FROM cut c JOIN v ON v.word = c.a || c.b UNION SELECT v.word, c.word, c.n FROM cut c JOIN v ON v.word = c.a || c.b),
best AS (SELECT word, count(*) AS n_near, max(n) AS m, min(near) FILTER (n = top) AS near FROM (SELECT *, max(n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
form AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * v.n THEN near END AS form, CASE WHEN m >= 2 * v.n THEN m END AS form_n FROM v LEFT JOIN best USING (word)),
step(word, root, form) AS (SELECT word, word, form FROM form UNION ALL SELECT s.word, f.word, f.form FROM step s JOIN form f ON f.word = s.form)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, s.root FROM form f JOIN step s ON s.word = f.word AND s.form IS NULL"""

#: One row of costs, audits and lines by place (nothing yet, behind a system turn, a user's, an assistant's) moves from the last row to the first.
REPAIR = CRC_TABLE + rf""",
h AS (SELECT *, coalesce(role, ' ') AS r0, coalesce(text, ' ') AS t0, {CRC.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations, crc),
dmg AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE r0 END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(t0, '[.!?]', '', 'g') ELSE t0 END AS text, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS c FROM h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dmg),
x AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS tail, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o),
f AS (SELECT *, CASE WHEN tail = '' THEN 'b' WHEN again THEN 'd' WHEN tail NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault, CASE role[1] WHEN 's' THEN 2 WHEN 'u' THEN 3 WHEN 'a' THEN 4 ELSE 0 END AS own FROM x),
moves AS (SELECT [{{'p': 1, 'q': 2, 'm': 0}}, {{'p': 1, 'q': 3, 'm': 0}}, {{'p': 1, 'q': 4, 'm': 1}}, {{'p': 2, 'q': 3, 'm': 0}}, {{'p': 2, 'q': 4, 'm': 1}}, {{'p': 3, 'q': 4, 'm': 0}}, {{'p': 3, 'q': 3, 'm': 1}}, {{'p': 4, 'q': 3, 'm': 0}}, {{'p': 4, 'q': 4, 'm': 1}}] AS ways),
v(conv_id, i, best) AS (
 SELECT conv_id, max(i), [{{'cost': 0, 'audit': '', 'said': []::VARCHAR[]}}, {{'cost': 6, 'audit': 'II', 'said': ['user:', 'assistant:']}}, {{'cost': 3, 'audit': 'I', 'said': ['assistant:']}}, {{'cost': 0, 'audit': '', 'said': []::VARCHAR[]}}] FROM f GROUP BY conv_id
 UNION ALL
 SELECT v.conv_id, v.i - 1, list_transform([1, 2, 3, 4], lambda p: list_min(list_concat(
   [{{'cost': best[p].cost + 4, 'audit': 'D' || best[p].audit, 'said': best[p].said}}],
   list_transform(list_filter(ways, lambda w: w.p = p AND fault NOT IN ('b', 'd') AND (w.q = own OR w.q > 2)), lambda w: {{
    'cost': best[w.q].cost + 3 * w.m + CASE WHEN w.q = own THEN 0 ELSE 3 END + CASE WHEN fault = 't' THEN 3 ELSE 0 END,
    'audit': repeat('I', w.m) || CASE WHEN w.q = own THEN 'K' ELSE 'R' END || best[w.q].audit,
    'said': list_concat(CASE WHEN w.m = 0 THEN []::VARCHAR[] WHEN w.q = 3 THEN ['assistant:'] ELSE ['user:'] END, [CASE WHEN w.q = own THEN role WHEN w.q = 3 THEN 'user' ELSE 'assistant' END || ':' || text], best[w.q].said)}}))))
 FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i, moves WHERE v.i > 0),
n AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
 CAST(coalesce(best[1].cost, 0) AS BIGINT) AS cost, coalesce(best[1].audit, '') AS audit, sha256(coalesce(array_to_string(best[1].said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM c.conv_id AND v.i = 0"""

ORACLE = {"op4_chat_formatting": CHAT, "op5_ngram_jaccard_join": JACCARD, "op8_suffix_array_dedup": SUFFIXES, "op10_quality_rules": QUALITY, "op11_conversation_repair": REPAIR, "op12_spelling_variants": VARIANTS}
