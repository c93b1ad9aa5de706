"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op13_prefix_trie"] = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, list({'id': sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')),
      'words': len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))}
    ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc(conv_id, pos, value) AS (
  SELECT conv_id, 0, 4294967295::BIGINT FROM turns
  UNION ALL
  SELECT conv_id, pos + 1, list_reduce(
    [xor(value, CAST(ord(substr(CAST(conv_id AS VARCHAR), pos + 1, 1)) AS BIGINT)), 1, 1, 1, 1, 1, 1, 1, 1],
    lambda c, _: xor(c // 2, (c % 2) * 3988292384))
  FROM crc WHERE pos < length(CAST(conv_id AS VARCHAR))),
h AS (SELECT conv_id, xor(value, 4294967295) % 4 AS h FROM crc WHERE pos = length(CAST(conv_id AS VARCHAR))),
rebuilt AS (
  SELECT c.conv_id, coalesce(b.own[1:h], []) || c.own[h + 1:] AS turns
  FROM turns c JOIN h ON h.conv_id = c.conv_id LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 20),
steps AS (SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt),
prefixes AS (
  SELECT conv_id, depth, array_to_string(list_transform(turns[1:depth], lambda t: t.id), '') AS node,
    CASE WHEN depth > 0 THEN array_to_string(list_transform(turns[1:depth - 1], lambda t: t.id), '') END AS parent,
    CASE WHEN depth > 0 THEN turns[depth].words ELSE 0 END AS words, depth = len(turns) AS ends
  FROM steps),
nodes AS (
  SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
    (count(*) - 1) * any_value(words) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
paths AS (
  SELECT left(n.node, 64 * unnest(range(0, n.depth + 1))) AS top, saved, c.n IS NULL AS leaf
  FROM nodes n LEFT JOIN children c ON c.node = n.node),
sums AS (SELECT top, sum(saved) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves FROM paths GROUP BY top)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
  s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.top = n.node LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.node = n.node
"""

ORACLES["op12_dual_tree_search"] = r"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
counted AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM split GROUP BY row, term),
sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY row),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
lengths AS (SELECT row, 100 - 50 + ((50 * n * docs) // terms) AS m FROM sizes, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT a.item_id, a.text, c.row, any_value(c.doc_id) AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked a JOIN counted c ON c.term = a.term JOIN weights w ON w.term = a.term JOIN lengths l ON l.row = c.row
  GROUP BY a.item_id, a.text, c.row),
ranked AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES["op3_repeats"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT row, doc_id, pos, sha256(array_to_string(words[pos:pos + 19], ' ')) AS passage
  FROM (SELECT row, doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM docs)),
earliest AS (
  SELECT passage, min({'none': doc_id IS NULL, 'doc_id': doc_id, 'pos': pos}) AS first FROM windows GROUP BY passage),
gone AS (
  SELECT DISTINCT row, unnest(range(pos, pos + 20)) AS place
  FROM windows JOIN earliest USING (passage) WHERE {'none': doc_id IS NULL, 'doc_id': doc_id, 'pos': pos} > first),
places AS (SELECT row, count(*) AS n FROM gone GROUP BY row),
every AS (SELECT row, words[place] AS word, place FROM (SELECT row, words, unnest(range(1, len(words) + 1)) AS place FROM docs)),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY place) AS text FROM every ANTI JOIN gone USING (row, place) GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN places USING (row) LEFT JOIN kept USING (row)
"""

ORACLES["op6_hnsw"] = r"""
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS v,
    coalesce(len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0, false) AS usable
  FROM embeddings),
units AS (
  SELECT row, vec_id, len(v) AS size, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v
  FROM vectors WHERE usable),
links AS MATERIALIZED (
  SELECT a.row AS a, b.row AS b FROM units a JOIN units b ON a.size = b.size AND a.row <> b.row
  WHERE list_inner_product(a.v, b.v) >= 0.9),
reach(a, b) AS (SELECT row, row FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
groups AS (SELECT a AS row, min(vec_id) AS component_id FROM reach JOIN vectors ON vectors.row = b GROUP BY a),
counts AS (SELECT a AS row, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN groups USING (row) LEFT JOIN counts USING (row)
"""
