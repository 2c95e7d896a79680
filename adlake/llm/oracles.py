"""DuckDB SQL for the operators whose results SQL can express: plain
statements of the results, over whole tables, by comparing everything."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All pairs of a label by cosine; components by reachability.
OP5 = """
WITH RECURSIVE ids AS (SELECT DISTINCT vec_id FROM embeddings),
v AS MATERIALIZED (
  SELECT DISTINCT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
half AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
links AS MATERIALIZED (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (
  SELECT vec_id, vec_id AS c FROM ids
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.c),
root AS (SELECT vec_id, min(c) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM root LEFT JOIN n ON n.a = vec_id
"""

#: Pairs by shared shingles; components by reachability.
OP6 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^ \\t\\n\\v\\f\\r]+') AS w FROM documents WHERE text IS NOT NULL),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
half AS MATERIALIZED (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
links AS MATERIALIZED (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.c),
root AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT r.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, r.doc_id = component_id AS kept
FROM root r LEFT JOIN n ON n.doc_id = r.doc_id
"""

_WORDS = f"regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

#: Windows of items joined with the windows of texts of the same length.
OP9 = f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
pos AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS MATERIALIZED (
  SELECT doc_id, i, pos.n, item_id FROM pos JOIN win ON win.n = pos.n AND win.s = array_to_string(w[i : i + pos.n - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS t
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(t, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

#: Every step of every order of five filters, counted document by document.
OP11 = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
first AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
l AS (SELECT doc_id, max(quality = 1) AS q, max(toxic = 1) AS x FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS MATERIALIZED (
  SELECT part, coalesce(q, false) AS q, coalesce(x, false) AS x,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 3 * length(d.t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN d.doc_id > first_id THEN 'E' ELSE '' END) AS fails
  FROM d JOIN first ON first.t = d.t LEFT JOIN l ON l.doc_id = d.doc_id),
cell AS MATERIALIZED (SELECT part, fails, count(*) AS n, count(*) FILTER (q) AS g, count(*) FILTER (x) AS x FROM f GROUP BY ALL),
perm AS (
  SELECT '' AS filter_order UNION ALL
  SELECT filter_order || c FROM perm, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c) WHERE NOT contains(filter_order, c)),
step AS (SELECT filter_order, k AS step, filter_order[k] AS filter, filter_order[1 : k - 1] AS before
  FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS k FROM perm WHERE length(filter_order) = 5)),
state AS (
  SELECT part, filter_order, step, filter, n, g, x, fails, contains(fails, filter) AS hit,
    before <> '' AND regexp_matches(fails, '[' || before || '0]') AS gone
  FROM cell, step),
counted AS MATERIALIZED (
  SELECT part, filter_order, step, filter,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND hit), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (fails = filter), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(g) FILTER (NOT gone AND hit), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(x) FILTER (NOT gone AND hit), 0) AS BIGINT) AS toxic_lost
  FROM state GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted
"""

ORACLES = {"op5_embedding_dedup": OP5, "op6_minhash_dedup": OP6, "op9_decontaminate": OP9, "op11_filter_audit": OP11}
