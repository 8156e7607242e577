"""DuckDB statements with the rows of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (SELECT item, least(len(w), 13) AS k, w FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT item, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM bw)),
ks AS (SELECT DISTINCT k FROM g),
p AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT doc_id, i, p.k AS k, item FROM p JOIN g ON p.gram = g.gram AND p.k = g.k),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(t.s, '')) AS items_sha256,
  coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

_OP4 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT e.b, r.seen FROM r JOIN e ON e.a = r.node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(seen) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.node = d.doc_id GROUP BY 1, 2
"""

_OP8 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
tri AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
often AS (SELECT doc_id, g FROM tri GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM tri JOIN often USING (doc_id, g)) GROUP BY doc_id),
l AS (SELECT doc_id, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS v
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)),
f AS (SELECT *, len(v) AS n, length(array_to_string(v, '')) AS chars,
  length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
  length(regexp_replace(line, '[^!]', '', 'g')) AS loud,
  len(list_filter(v, lambda x: x IN ('|', '>', '»', '›', '·', '•'))) AS bars,
  len(list_filter(range(2, len(v) + 1), lambda j: v[j] = v[j - 1])) AS follows,
  row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup
  FROM l WHERE len(v) > 0),
x AS (SELECT doc_id, n, dup, 10 * symbols >= chars OR (loud >= 3 AND 3 * loud > n)
   OR (n >= 10 AND regexp_matches(v[-1], '[a-zA-Z0-9,]$')) OR (bars >= 3 AND 4 * bars >= n)
   OR (n >= 5 AND 2 * follows > n) OR dup OR (n <= 40 AND regexp_matches(
     translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
     'all rights reserved|click here|cookie policy|cookies to|enable javascript|javascript is disabled|lorem ipsum|privacy policy|skip to content|subscribe to our newsletter|terms of service|terms of use'
     || '|alle rechte vorbehalten|cookie-richtlinie|hier klicken|javascript aktivieren|newsletter abonnieren|nutzungsbedingungen|zum inhalt springen'
     || '|activer javascript|aller au contenu|cliquez ici|conditions d''utilisation|politique de confidentialité|tous droits réservés'
     || '|activar javascript|aviso legal|haga clic aquí|política de privacidad|términos de uso|todos los derechos reservados'
   )) AS failed FROM f),
s AS (SELECT doc_id, sum(CASE WHEN dup THEN 1 ELSE 0 END) AS dups, sum(CASE WHEN failed THEN n ELSE 0 END) AS lost
  FROM x GROUP BY doc_id),
o AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(lost, 0) AS BIGINT) AS n_lost_words
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN s USING (doc_id)),
r AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM o)
SELECT *, NOT base_failed AND 2 * n_lost_words <= n_words AS kept FROM r
"""

_OP9 = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS draw, md5(coalesce(text, '')) AS tie FROM documents),
z AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
q AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
  FROM z),
e AS (SELECT *, CAST(source_size AS DOUBLE) * 2 AS lim, (SELECT CAST(sum(source_size) AS DOUBLE) * 1.5 FROM z) AS budget,
  row_number() OVER (ORDER BY CAST(source_size AS DOUBLE) * 2 / weight, source NULLS LAST) AS k FROM q),
v AS (SELECT *, (budget - coalesce((SELECT sum(y.lim) FROM e y WHERE y.k < e.k), 0))
   / (SELECT sum(y.weight) FROM e y WHERE y.k >= e.k) AS level FROM e),
g AS (SELECT source, source_size, CASE WHEN lim / weight <= level THEN lim
   ELSE (SELECT arg_min(y.level, y.k) FROM v y WHERE y.lim / y.weight > y.level) * weight END AS target FROM v),
u AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY draw, tie, doc_id) AS queued
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT u.*, copy, (queued + copy * source_size) / CASE WHEN target > 0 THEN target ELSE 1.0 END AS finish
  FROM u, (SELECT unnest([0, 1]) AS copy)),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, draw, tie, doc_id, copy) AS reached FROM c),
t AS (SELECT doc_id, count(*) AS copies FROM r WHERE reached <= (SELECT sum(target) FROM g) GROUP BY doc_id)
SELECT u.doc_id, size, source_size, target, CAST(coalesce(t.copies, 0) * size AS BIGINT) AS taken, source
FROM u LEFT JOIN t USING (doc_id)
"""

ORACLES: dict[str, str] = {"op1_decontamination": _OP1, "op4_ngram_join": _OP4, "op8_quality_rules": _OP8, "op9_mixing": _OP9}

_TERMS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS w FROM documents),
c AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
b AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS w FROM benchmark),
q AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
p AS (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM p, c GROUP BY term, docs),
g AS (SELECT row, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)) AS gain FROM p, c),
s AS (SELECT item, item_id, row, doc_id, CAST(sum(times * weight * gain) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN g USING (term) GROUP BY ALL),
r AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


def _op13() -> str:
    """Ten rounds of assignment and mean, one common table each, then the last assignment."""

    def assigned(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (SELECT row, cluster, distance FROM (
  SELECT row, cluster, distance, row_number() OVER (PARTITION BY row ORDER BY distance, cluster) AS place FROM (
    SELECT row, c.cluster, list_sum(list_transform(list_zip(v, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
    FROM kept, c{k} c)) WHERE place = 1)"""

    def mean(k: int) -> str:
        return f"""c{k} AS MATERIALIZED (SELECT old.cluster, coalesce(new.x, old.x) AS x FROM c{k - 1} old LEFT JOIN (
  SELECT cluster, list((total - ((total % size) + size) % size) // size ORDER BY place) AS x FROM (
    SELECT cluster, place, CAST(sum(value) AS BIGINT) AS total, count(*) AS size FROM (
      SELECT cluster, unnest(v) AS value, generate_subscripts(v, 1) AS place FROM a{k - 1} JOIN kept USING (row)) GROUP BY ALL)
  GROUP BY cluster) new USING (cluster))"""

    rounds = ",\n".join(f"{assigned(k)},\n{mean(k + 1)}" for k in range(10))
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
  list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster, v AS x
  FROM kept QUALIFY cluster < 8),
{rounds},
{assigned(10)},
z AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a10 GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(distance AS BIGINT) AS distance, cluster_inertia,
  (SELECT CAST(sum(distance) AS BIGINT) FROM a10) AS inertia, sha256(array_to_string(c10.x, ',')) AS centroid_sha256
FROM a10 JOIN kept USING (row) JOIN z USING (cluster) JOIN c10 USING (cluster)
"""


ORACLES.update({"op12_lexical_search": _OP12, "op13_centroid_clusters": _op13()})
