"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

_SPACE = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACE}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], chr(31)) AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY d.doc_id, n.n"""

OP8 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS l, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
ls AS (SELECT DISTINCT l FROM bw),
dw AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS g FROM (SELECT doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i FROM d, ls WHERE len(w) >= l)),
h AS (SELECT dw.doc_id, dw.i, dw.l, bw.item_id FROM dw JOIN bw ON dw.l = bw.l AND dw.g = bw.g),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + l - 1)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)"""

OP9 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w, [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r WHERE n > 1) GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
  CAST(length(array_to_string(w, '')) - length(regexp_replace(array_to_string(w, ''), '\p{{Lu}}+', '', 'g')) AS BIGINT) AS n_upper, CAST(length(array_to_string(w, '')) - length(regexp_replace(array_to_string(w, ''), '\p{{L}}+', '', 'g')) AS BIGINT) AS n_letters FROM d LEFT JOIN c USING (doc_id)),
f AS (SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT + 8 * (10 * n_dup_lines > 3 * n_lines)::INT + 16 * (2 * n_words > word_chars)::INT + 32 * (word_chars > 14 * n_words)::INT + 64 * (10 * n_upper > 4 * word_chars)::INT + 128 * (10 * n_letters < 5 * word_chars)::INT AS BIGINT) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 AS base_failed, (failures & 3) = 0 AND (failures & 71) = 0 AND bit_count(failures & 184) < 2 AS kept, failures, n_lines, n_upper, n_letters, 2 AS policy_version FROM f"""

OP11 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
c AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS t FROM benchmark),
p AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM b) GROUP BY ALL),
f AS (SELECT t, CAST(floor(1000 * ln((2 * (SELECT n FROM c) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p GROUP BY t),
m AS (SELECT doc_id, 10 + (90 * len(w)::BIGINT * c.n) // c.l AS m FROM d, c WHERE len(w) > 0),
s AS (SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM b JOIN p USING (t) JOIN f USING (t) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10"""
