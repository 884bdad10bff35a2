"""SQL for those of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

OP4 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
i AS (
  SELECT row_number() OVER () AS i, item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g
  FROM i, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(s) WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM d, ns, unnest(range(1, len(w) - n + 2)) AS t(s)),
m AS (SELECT r, s, n, item_id FROM dw JOIN iw USING (n, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM m, unnest(range(s, s + n)) AS t(p) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

OP7 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(replace(replace(role, '%', '%25'), ':', '%3A'), '#', '%23'), '<', '%3C'), '\', '%5C') AS r,
         CASE WHEN contains(text, '\') OR contains(text, '###') OR contains(text, '</turn>')
              THEN replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/') ELSE text END AS t
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(length(r) + length(t) + 15) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP13 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, k AS words, array_to_string(ws[s:s + k - 1], ' ') AS phrase
  FROM w, unnest([1, 2, 3]) AS t(k), unnest(range(1, len(ws) - k + 2)) AS u(s)),
f AS (SELECT lang, words, phrase, count(*) AS c FROM g GROUP BY ALL),
n AS (SELECT lang, sum(c) AS n FROM f WHERE words = 1 GROUP BY lang),
cand AS (SELECT lang, words, phrase, c AS a, string_split(phrase, ' ') AS ws FROM f WHERE words > 1 AND c >= 10),
cuts AS (
  SELECT q.lang, q.words, q.phrase, q.a, k, x.c AS l, y.c AS r,
         (1000000::HUGEINT * q.a * q.a) // (x.c::HUGEINT * y.c) AS score
  FROM cand q, unnest(range(1, q.words)) AS t(k)
  JOIN f x ON x.lang = q.lang AND x.words = k AND x.phrase = array_to_string(q.ws[1:k], ' ')
  JOIN f y ON y.lang = q.lang AND y.words = q.words - k AND y.phrase = array_to_string(q.ws[k + 1:q.words], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT q.lang, array_to_string(q.ws[s:s + m - 1], ' ') AS phrase, max(q.a) AS longer
  FROM cand q, unnest(range(2, q.words)) AS t(m), unnest(range(1, q.words - m + 2)) AS u(s) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a)
SELECT lang, rank, phrase, a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) JOIN n USING (lang)
WHERE rank <= 2000
"""



def _op12_round(n: int) -> str:
    """The assignment to the centroids of round n, and the centroids after it."""
    return f"""
a{n} AS (
  SELECT k.r, k.vec_id, k.v, c.c, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
  FROM k, c{n} c QUALIFY row_number() OVER (PARTITION BY k.r ORDER BY d, c.c) = 1),
s{n} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n}) GROUP BY c, i),
m{n} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{n} GROUP BY c),
c{n + 1} AS (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{n} o LEFT JOIN m{n} m USING (c)),"""


OP12 = f"""
WITH k AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('1:' || vec_id) AS h, v FROM k) ORDER BY h, v LIMIT 16),
{"".join(_op12_round(n) for n in range(4))}
t AS (SELECT c, sum(d) AS s FROM a3 GROUP BY c)
SELECT vec_id, CAST(a3.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(t.s AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(s) FROM t) AS BIGINT) AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM a3 JOIN t USING (c) JOIN c3 USING (c)
"""

ORACLES: dict[str, str] = {
    "op4_decontamination": OP4,
    "op7_chat_format": OP7,
    "op12_centroid_clustering": OP12,
    "op13_phrases": OP13,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
