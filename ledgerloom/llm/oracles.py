"""DuckDB SQL of the queries that SQL can express, over the same whole tables."""

from __future__ import annotations

# fixed: white space and letters as the operators define them
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, r.key IS NOT NULL AND r.top <> k.doc_id AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

JACCARD_JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
reach AS (
  SELECT doc_id AS node, doc_id AS goal FROM documents
  UNION
  SELECT r.node, l.y FROM reach r JOIN links l ON r.goal = l.x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.goal) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.node = d.doc_id GROUP BY ALL
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE fine AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM fine a, fine b
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS node, vec_id AS goal FROM embeddings
  UNION
  SELECT r.node, l.y FROM reach r JOIN links l ON r.goal = l.x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, min(r.goal) AS component_id, v.vec_id = min(r.goal) AS kept
FROM embeddings v LEFT JOIN counts c ON c.x = v.vec_id JOIN reach r ON r.node = v.vec_id GROUP BY v.vec_id, c.n
"""

_LETTERS = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_LETTERS}) AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_LETTERS}) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i + 1:i + 10], ' ') AS s
  FROM (SELECT item, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT r, w, unnest(range(0, len(w))) AS i FROM d),
found AS (
  SELECT p.r, p.i, x.size, x.item FROM places p, (SELECT DISTINCT size FROM windows) z, windows x
  WHERE p.i + z.size <= len(p.w) AND x.size = z.size AND x.s = array_to_string(p.w[p.i + 1:p.i + z.size], ' ')),
hit AS (
  SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT r, i, size FROM found)) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
  sha256(coalesce(t.list, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit h ON h.r = d.r LEFT JOIN items t ON t.r = d.r
"""

_UNITS = "'[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+'"

FILL_IN_MIDDLE = f"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_UNITS}) AS u, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
n AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2, ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM h),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM n),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""

ORACLES = {
    "op5_jaccard_join": JACCARD_JOIN,
    "op7_line_dedup": LINE_DEDUP,
    "op9_embedding_dedup": EMBEDDING_DEDUP,
    "op11_decontamination": DECONTAMINATION,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
}
