"""DuckDB SQL for the operators that SQL can express."""

ORACLES: dict[str, str] = {
    "op2_source_mix": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS u
  FROM documents),
src AS (
  SELECT source, sum(size)::DOUBLE AS cap1, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
  FROM sized GROUP BY source),
-- sources in order of the level at which they are clamped: the first k are
-- clamped where the level of the others is at most that of the next
ranked AS (
  SELECT *, 3 * cap1 / w AS lvl, row_number() OVER (ORDER BY 3 * cap1 / w, source NULLS LAST) AS k,
         sum(3 * cap1) OVER o - 3 * cap1 AS held, sum(w) OVER () - (sum(w) OVER o - w) AS free, sum(cap1) OVER () AS total
  FROM src WINDOW o AS (ORDER BY 3 * cap1 / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (SELECT min_by((total - held) / free, k) AS l FROM ranked WHERE (total - held) / free <= lvl),
goal AS (
  SELECT source, source_size, least(3 * cap1, w * coalesce(l, 'infinity'::DOUBLE)) AS target FROM ranked LEFT JOIN level ON true),
part AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-9) ELSE 0 END AS whole FROM goal),
draws AS (
  SELECT s.source, u, sum(size) AS s FROM sized s GROUP BY s.source, u),
run AS (
  SELECT d.*, sum(s) OVER (PARTITION BY source ORDER BY u) AS upto, lag(u) OVER (PARTITION BY source ORDER BY u) AS prev FROM draws d),
cuts AS (
  SELECT p.source, CASE WHEN upto - need <= need - (upto - s) THEN u ELSE coalesce(prev, u - 1) END AS cut
  FROM run r JOIN (SELECT *, greatest(0.0, target - whole * source_size) AS need FROM part) p ON r.source IS NOT DISTINCT FROM p.source
  WHERE upto >= need AND upto - s < need)
SELECT doc_id, size, p.source_size, p.target, ((whole + CASE WHEN u <= coalesce(cut, -1) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM sized s JOIN part p ON s.source IS NOT DISTINCT FROM p.source LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
""",
    "op6_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first, count(*) AS n FROM d WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
""",
    "op4_vector_dedup": """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v,
         label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.ok AND b.ok AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, p.b FROM reach r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM e LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
""",
    "op9_minhash": r"""
WITH RECURSIVE t AS (SELECT doc_id, text, md5(text) AS k FROM documents),
cls AS (SELECT k, any_value(text) AS text, min(doc_id) AS least, count(*) AS n FROM t WHERE k IS NOT NULL GROUP BY k),
w AS (SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM cls),
s AS (
  SELECT k, g, count(*)::DOUBLE AS x FROM (
    SELECT k, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE
      list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w WHERE len(w) > 0)
  GROUP BY k, g),
tot AS (SELECT k, sum(x) AS total FROM s GROUP BY k),
pair AS (
  SELECT a.k AS a, b.k AS b, a.x AS x, b.x AS y, count(*) AS m
  FROM s a JOIN s b ON a.g = b.g AND a.k < b.k GROUP BY ALL),
rest AS (
  SELECT a, b, any_value(ta.total) - sum(x * m) AS ra, any_value(tb.total) - sum(y * m) AS rb
  FROM pair JOIN tot ta ON ta.k = a JOIN tot tb ON tb.k = b GROUP BY a, b),
term AS (
  SELECT p.a, p.b, p.m, r.ra / p.x + r.rb / p.y + sum(q.m * greatest(q.x / p.x, q.y / p.y)) AS d
  FROM pair p JOIN rest r ON r.a = p.a AND r.b = p.b JOIN pair q ON q.a = p.a AND q.b = p.b
  GROUP BY p.a, p.b, p.x, p.y, p.m, r.ra, r.rb),
link AS (SELECT a, b FROM term GROUP BY a, b HAVING sum(m / d) >= 0.8),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT k AS a, k AS b FROM cls UNION SELECT r.a, l.b FROM reach r JOIN edge l ON r.b = l.a),
root AS (SELECT a AS k, min(b) AS root FROM reach GROUP BY a),
grp AS (SELECT root, min(least) AS class_id, sum(n)::BIGINT AS n_copies FROM cls JOIN root USING (k) GROUP BY root)
SELECT t.doc_id, CASE WHEN t.k IS NULL THEN t.doc_id ELSE class_id END AS class_id, coalesce(n_copies, 1)::BIGINT AS n_copies,
       t.doc_id IS NOT DISTINCT FROM CASE WHEN t.k IS NULL THEN t.doc_id ELSE class_id END AS kept
FROM t LEFT JOIN root USING (k) LEFT JOIN grp USING (root)
""",
}
