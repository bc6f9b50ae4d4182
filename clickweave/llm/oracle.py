"""DuckDB SQL for the operators that SQL can express: mixing (1), top-k search
(4), the Jaccard join (9), near copies of embeddings (12) and the manifest (13).
The others use trained models, tokenizers or
hashes that SQL does not have; their tests hold them against brute force."""

from __future__ import annotations

_WORDS = r"""list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

OP1 = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, text, CAST(len({_WORDS.format(text="coalesce(text, '')")}) AS BIGINT) AS size FROM documents
), good AS (
  SELECT doc_id AS g, MAX(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END)::DOUBLE AS q FROM labels GROUP BY doc_id
), keyed AS (
  SELECT doc_id, source, size,
         -ln((CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), md5(text), ''))[1:12] AS BIGINT)::DOUBLE + 0.5) / 281474976710656.0)
         / coalesce(q, 1.0) AS k
  FROM sized LEFT JOIN good ON g = doc_id
), sums AS (
  SELECT source, SUM(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM keyed GROUP BY source
), rounds AS (  -- cap what is above three times its size, share again, until none is
  SELECT 0 AS step, source, source_size, weight, FALSE AS capped FROM sums
  UNION ALL
  SELECT step + 1, source, source_size, weight, capped OR weight * level > 3.0 * source_size
  FROM (SELECT *, (SUM(source_size) OVER () - coalesce(SUM(3.0 * source_size) FILTER (capped) OVER (), 0))
                  / SUM(weight) FILTER (NOT capped) OVER () AS level FROM rounds)
  WHERE step <= (SELECT COUNT(*) FROM sums)
), shares AS (
  SELECT source, source_size, weight, capped,
         (SUM(source_size) OVER () - coalesce(SUM(3.0 * source_size) FILTER (capped) OVER (), 0))
         / NULLIF(SUM(weight) FILTER (NOT capped) OVER (), 0) AS level
  FROM rounds WHERE step = (SELECT MAX(step) FROM rounds)
), targets AS (
  SELECT source, source_size, CASE WHEN capped THEN 3.0 * source_size ELSE weight * level END::DOUBLE AS target FROM shares
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets
), ranked AS (
  SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
         SUM(size) OVER (PARTITION BY k.source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) AS run
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source
), taken AS (
  SELECT *, epochs + CASE WHEN rest > 0 AND run - size / 2.0 <= rest THEN 1 ELSE 0 END AS copies FROM ranked
)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies FROM taken
"""

OP4 = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = f"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text=_AZ)} AS ws FROM documents
), sets AS (
  SELECT r, doc_id, CASE WHEN len(ws) >= 5
           THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
           WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh
  FROM words
), elements AS (
  SELECT r, len(sh) AS n, unnest(sh) AS x FROM sets
), links AS (
  SELECT a.r AS a, b.r AS b FROM elements a JOIN elements b ON a.x = b.x AND a.r < b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * COUNT(*) >= 75 * (a.n + b.n - COUNT(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT r, r AS t FROM sets
  UNION
  SELECT reach.r, both_ways.b FROM reach JOIN both_ways ON reach.t = both_ways.a
), least AS (
  SELECT reach.r, MIN(other.doc_id) AS component_id FROM reach JOIN sets other ON other.r = reach.t GROUP BY reach.r
)
SELECT sets.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id FROM sets JOIN least USING (r)
"""

OP12 = """
WITH RECURSIVE rows_ AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), good AS MATERIALIZED (
  SELECT r, e FROM rows_ WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT r, r AS t FROM rows_
  UNION
  SELECT reach.r, links.b FROM reach JOIN links ON reach.t = links.a
), least AS (
  SELECT reach.r, MIN(other.vec_id) AS component_id FROM reach JOIN rows_ other ON other.r = reach.t GROUP BY reach.r
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM rows_ JOIN least USING (r) LEFT JOIN (SELECT a AS r, COUNT(*) AS n FROM links GROUP BY a) USING (r)
"""

_CRC32 = """xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
  lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))))"""


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || {x}, '-')" for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP13 = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_CRC32.format(x="doc_id")} % 5 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf("text")} END AS shown
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, COUNT(*) OVER (PARTITION BY source) AS n FROM docs
), nodes AS (  -- n: nodes of the level
  SELECT source, 0 AS lv, idx, leaf AS d, n FROM placed
  UNION ALL
  SELECT source, lv + 1, idx // 16, sha256(string_agg(d, '' ORDER BY idx)), (n + 15) // 16 FROM nodes WHERE n > 1 GROUP BY source, lv, idx // 16, n
), subroots AS (
  SELECT source, lv AS h, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, COUNT(*) OVER () AS m FROM nodes WHERE n = 1
), above AS (
  SELECT 0 AS lv, place AS idx, subroot AS d, m AS n FROM subroots
  UNION ALL
  SELECT lv + 1, idx // 16, sha256(string_agg(d, '' ORDER BY idx)), (n + 15) // 16 FROM above WHERE n > 1 GROUP BY lv, idx // 16, n
), sides AS (  -- what stands left and right of a document's node at each level
  SELECT r, lv, string_agg(CASE WHEN k < own THEN d ELSE '' END, '' ORDER BY k) AS l, string_agg(CASE WHEN k > own THEN d ELSE '' END, '' ORDER BY k) AS g
  FROM (
    SELECT r, lv, t.idx AS k, t.d, p.idx // (16 ** lv)::BIGINT AS own FROM placed p JOIN nodes t ON t.source IS NOT DISTINCT FROM p.source
      AND t.n > 1 AND t.idx // 16 = p.idx // (16 ** (lv + 1))::BIGINT
    UNION ALL
    SELECT r, h + lv, a.idx, a.d, s.place // (16 ** lv)::BIGINT FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
      JOIN above a ON a.n > 1 AND a.idx // 16 = s.place // (16 ** (lv + 1))::BIGINT
  ) GROUP BY r, lv
), fold AS (
  SELECT r, 0 AS lv, shown AS d FROM docs
  UNION ALL
  SELECT fold.r, lv + 1, sha256(l || d || g) FROM fold JOIN sides USING (r, lv)
), ends AS (
  SELECT r, arg_max(d, lv) AS folded_root FROM fold GROUP BY r
), proofs AS (
  SELECT r, string_agg(l || g, '' ORDER BY lv) AS p FROM sides GROUP BY r
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(p, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM docs JOIN subroots ON subroots.source IS NOT DISTINCT FROM docs.source JOIN ends USING (r) LEFT JOIN proofs USING (r)
CROSS JOIN (SELECT d AS root FROM above WHERE n = 1)
"""

SQL = {"op1_mixing": OP1, "op4_topk": OP4, "op9_jaccard_tiles": OP9, "op12_nndescent": OP12, "op13_manifest": OP13}
