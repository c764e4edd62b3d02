"""DuckDB SQL for the corpus queries that SQL can express on whole tables."""

ORACLE: dict[str, str] = {}

_SAID = "'<|im_end|><|im_start|>assistant ok'"

ORACLE["op3_chat_format"] = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_SAID} UNION ALL SELECT -1, 1, 'assistant', {_SAID}),
e AS (
  SELECT *, replace(t, '<', '<;') AS x,
         11 + 12 + 1 + length(replace(t, '<', '<;')) + length(replace(replace(r, '<', '<;'), chr(10), '<n')) AS size FROM m)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

_LINKED = """
adj AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
walk AS (SELECT id AS node, id AS root FROM ids UNION SELECT adj.b, walk.root FROM walk JOIN adj ON adj.a = walk.node),
comp AS (SELECT node, min(root) AS component_id FROM walk GROUP BY node)"""

ORACLE["op1_rp_forest_dedup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
  FROM embeddings),
ids AS (SELECT DISTINCT vec_id AS id FROM v),
ok AS (SELECT * FROM v WHERE n > 0 AND isfinite(n)),
pairs AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM ok p JOIN ok q ON p.vec_id < q.vec_id
  WHERE list_dot_product(p.e, q.e) / (p.n * q.n) >= 0.95),
{_LINKED}
SELECT v.vec_id, (SELECT count(*) FROM adj WHERE adj.a = v.vec_id) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN comp ON comp.node = v.vec_id"""

ORACLE["op10_hilbert_ann"] = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 20"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLE["op2_substring_dedup"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT rid, i, array_to_string(list_slice(w, i, i + 34), ' ') AS k
        FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
cov AS (SELECT DISTINCT rid, i + j AS p FROM (SELECT rid, i, unnest(range(0, 35)) AS j FROM win SEMI JOIN rep USING (k))),
word AS (SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN cov USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""

ORACLE["op4_minhash_dedup"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
met AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS i FROM sh p JOIN sh q ON p.s = q.s AND p.doc_id < q.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
ids AS (SELECT doc_id AS id FROM d),
{_LINKED}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN comp ON comp.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_CHARS = " || ".join(f"substr({_BASE32}, ((v >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0))

ORACLE["op6_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT x, min(page_id) AS first FROM p GROUP BY x),
c AS (SELECT *, list_transform(range(0, 8), lambda k: CAST('0x' || substr(x, CAST(5 * k + 1 AS BIGINT), 5) AS BIGINT)) AS vs FROM p JOIN f USING (x))
SELECT page_id, strlen(h) AS payload_bytes, array_to_string(list_transform(vs, lambda v: {_CHARS}), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM c"""

# Every page of these tables marks its article, in plain tags; the general rules are tested on fixtures.
ORACLE["op8_html_extract"] = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?b>', '', 'g') AS t FROM pages),
b AS (SELECT page_id, url, regexp_replace(replace(regexp_replace(t, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;?', '&', 'g') AS t FROM a),
c AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM c"""

ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3"""
