"""DuckDB SQL of the queries that SQL can express. The others are tested against plain versions in tests/llm."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
  win AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
  h AS (SELECT r, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h FROM win),
  twice AS (SELECT r, i FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)),
  gone AS (SELECT DISTINCT r, i + k AS p FROM twice, range(35) t(k)),
  word AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
  kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
  h AS (SELECT page_id, strlen(html) AS n, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS first FROM p),
  b AS (SELECT *, list_transform(range(8), lambda k: ('0x' || substr(hex, 5 * k + 1, 5))::BIGINT) AS parts FROM h)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(parts, lambda x: array_to_string(list_transform([x // 32768, x // 1024 % 32, x // 32 % 32, x % 32], lambda y: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (y + 1)::BIGINT, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}, []) AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [sha256(array_to_string(w, ' '))] ELSE list_transform(range(1, len(w) - 2), lambda i: sha256(array_to_string(w[i:i + 3], ' '))) END) AS g FROM d),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
  e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
  u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
  reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT x, b FROM reach JOIN u ON y = a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.least AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS least FROM reach GROUP BY 1) c USING (doc_id)
"""

# CRC-32 by its definition, a step for each bit: a byte enters, then eight shifts
_BITS = "flatten(list_transform(range(strlen(g)), lambda i: [('0x' || substr(hex(g), 2 * i + 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
_CRC = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {_BITS}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"
_PLAIN = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN} AS w FROM documents),
  f AS (SELECT r, array_to_string(w[i - k:i], ' ') AS g FROM (SELECT r, unnest(range(1, len(w) + 1)) AS i, w FROM d), range(3) t(k) WHERE i > k),
  n AS (SELECT r, g, count(*) AS n FROM f GROUP BY 1, 2),
  m AS (SELECT g, count(*) AS n FROM (SELECT array_to_string(w[i - k:i], ' ') AS g FROM (SELECT unnest(range(1, len(w) + 1)) AS i, w FROM (SELECT {_PLAIN} AS w FROM benchmark)), range(3) t(k) WHERE i > k) GROUP BY 1),
  h AS (SELECT g, {_CRC} % 10000 AS k FROM (SELECT g FROM n UNION SELECT g FROM m)),
  s AS (SELECT k, sum(n)::DOUBLE AS s FROM n JOIN h USING (g) GROUP BY 1),
  t AS (SELECT k, sum(n)::DOUBLE AS t FROM m JOIN h USING (g) GROUP BY 1),
  z AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS s_all, coalesce((SELECT sum(t) FROM t), 0) AS t_all),
  gain AS (SELECT k, floor(1000.0::DOUBLE * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (k), z),
  x AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM n JOIN h USING (g) JOIN gain USING (k) GROUP BY 1),
  y AS (SELECT r, doc_id, len(w) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN x USING (r)),
  v AS (SELECT *, weight + floor(-1000.0::DOUBLE * ln(-ln((h::DOUBLE + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM y),
  o AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, (SELECT count(*) FROM y WHERE words >= 20) AS many FROM v)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN words >= 20 AND place <= 5 * many // 100 THEN place END::BIGINT AS rank FROM o
"""

_GROUP = "('0x' || substr(h, {}, 8))::BIGINT"

OP12 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
  r AS (SELECT *, len(u) AS n, {_GROUP.format(1)} % (len(u) + 1) AS a, {_GROUP.format(9)} % (len(u) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_GROUP.format(17)} % 100 >= 50 THEN 'plain' WHEN {_GROUP.format(25)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
  c AS (SELECT *, array_to_string(u[:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM r)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM c
"""

# Each page of the tables has its main text in one article element, where only p and h1 begin or end a block.
OP13 = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS h FROM pages),
  b AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(h, '</?(p|h1)>', chr(1), 'g'), '<br>', ' ', 'g'), '<[^>]+>', '', 'g') AS t FROM a),
  d AS (SELECT *, regexp_replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;?', '&', 'g') AS u FROM b),
  l AS (SELECT *, list_filter(list_transform(string_split(u, chr(1)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS lines FROM d)
SELECT page_id, url, array_to_string(lines, chr(10)) AS text, length(array_to_string(lines, chr(10)))::BIGINT AS n_chars FROM l
"""

ORACLES = {"op2_substring_dedup": OP2, "op6_warc_index_merge": OP6, "op8_ngram_jaccard_join": OP8, "op11_importance_resampling": OP11, "op12_fill_middle": OP12, "op13_consensus_main_text": OP13}
