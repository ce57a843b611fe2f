"""What SQL can say of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

import math

from shardloom.llm.licenses import THRESHOLD, Space
from shardloom.llm.substrings import WINDOW

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRINGS = f"""
WITH split AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM split WHERE len(w) >= {WINDOW})
),
again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT r, i + k AS place
  FROM windows JOIN again USING (s) CROSS JOIN (SELECT unnest(range(0, {WINDOW})) AS k)
),
placed AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM split),
kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
  FROM placed ANTI JOIN covered USING (r, place) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (r)"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v!r}::DOUBLE" for v in row) + ")" for row in rows)


def licences() -> str:
    """Cosines of all lines that share a term with a template, and the way up to the nearest folder."""
    space = Space()
    idf = _values(sorted(space.idf.items()))
    weights = _values((n, t, w) for n, v in space.vectors.items() for t, w in v.items())
    unseen = math.log(1 + len(space.vectors)) + 1
    return f"""
WITH idf(term, idf) AS (VALUES {idf}),
template(licence, term, weight) AS (VALUES {weights}),
files AS (
  SELECT doc_id, text, concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'), CAST(doc_id // 50 AS VARCHAR)) AS folder,
         doc_id % 50 = 0 AS named FROM documents
),
units AS (
  SELECT doc_id, line - 1 AS line, lower(unit) AS unit
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line FROM files)
  UNION ALL SELECT doc_id, -1, lower(text) FROM files WHERE named
),
terms AS (
  SELECT doc_id, line, term, count(*) AS n
  FROM (SELECT doc_id, line, unnest(regexp_extract_all(unit, '[a-z0-9]+')) AS term FROM units) GROUP BY ALL
),
weighed AS (SELECT t.*, n * coalesce(idf, {unseen!r}::DOUBLE) AS w FROM terms t LEFT JOIN idf USING (term)),
sizes AS (SELECT doc_id, line, sqrt(sum(w * w)) AS size FROM weighed GROUP BY ALL),
cosines AS (
  SELECT doc_id, line, licence, round(sum(w * weight) / any_value(size), 6) AS cosine
  FROM weighed JOIN template USING (term) JOIN sizes USING (doc_id, line) GROUP BY doc_id, line, licence
),
own AS (
  SELECT doc_id, licence, cosine FROM cosines WHERE cosine >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, licence, line) = 1
),
holders AS (SELECT folder, licence AS above, cosine AS near FROM files JOIN own USING (doc_id) WHERE named)
SELECT doc_id, folder || '/' || CASE WHEN named THEN 'LICENSE' ELSE CAST(doc_id AS VARCHAR) || '.txt' END AS path,
       coalesce(licence, above) AS licence, coalesce(cosine, near) AS cosine,
       CASE WHEN licence IS NOT NULL THEN 'header' WHEN above IS NOT NULL THEN 'directory' END AS via,
       CASE WHEN licence IS NULL AND above IS NOT NULL THEN folder END AS licence_directory
FROM files LEFT JOIN own USING (doc_id) LEFT JOIN holders USING (folder)"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, nodes: str) -> str:
    """Levels of the trees over ``nodes`` (k, g, idx, h) per g, and every node's siblings (k, ord, lft, rgt)."""
    return f"""
{name}_height AS (
  SELECT g, sum(CASE WHEN pow(8, e) < n THEN 1 ELSE 0 END) AS height
  FROM (SELECT g, count(*) AS n FROM {nodes} GROUP BY g), range(0, 21) t(e) GROUP BY g
),
{name}_levels(g, depth, idx, h, height) AS (
  SELECT g, 0, idx, h, height FROM {nodes} JOIN {name}_height USING (g)
  UNION ALL
  SELECT g, depth + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), height
  FROM {name}_levels WHERE depth < height GROUP BY g, depth, idx // 8, height
),
{name}_top AS (SELECT g, h AS top FROM {name}_levels WHERE depth = height),
{name}_sibs AS (
  SELECT n.k, s.depth AS ord,
         coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (WHERE s.idx < n.idx // CAST(pow(8, s.depth) AS BIGINT)), '') AS lft,
         coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (WHERE s.idx > n.idx // CAST(pow(8, s.depth) AS BIGINT)), '') AS rgt
  FROM {nodes} n JOIN {name}_levels s
    ON s.g = n.g AND s.depth < s.height AND s.idx // 8 = n.idx // CAST(pow(8, s.depth) AS BIGINT) // 8
  GROUP BY n.k, s.depth
)"""


MERKLE = f"""
WITH RECURSIVE
crc_table(i, step, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_table WHERE step < 8
),
ids AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
crc(s, pos, c) AS (
  SELECT s, 0, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT crc.s, pos + 1, xor(t.c, crc.c >> 8)
  FROM crc JOIN crc_table t ON t.step = 8 AND t.i = xor(crc.c, ascii(substr(crc.s, pos + 1, 1))) & 255
  WHERE pos < strlen(crc.s)
),
tampered AS (SELECT s FROM crc WHERE pos = strlen(s) AND xor(c, 4294967295) % 3 = 0),
rows AS (
  SELECT row_number() OVER () AS k, d.*, CASE WHEN t.s IS NOT NULL THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS alt_text
  FROM documents d LEFT JOIN tampered t ON t.s = CAST(d.doc_id AS VARCHAR)
),
leaves AS (
  SELECT k, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '+' || lang END AS g, {_leaf("text")} AS h, {_leaf("alt_text")} AS alt FROM rows
),
leaf_nodes AS (
  SELECT k, g, h, row_number() OVER (PARTITION BY g ORDER BY doc_id ASC NULLS FIRST, h, alt) - 1 AS idx FROM leaves
),
{_tree("inner", "leaf_nodes")},
group_nodes AS (
  SELECT g AS k, '' AS g, top AS h, row_number() OVER (ORDER BY CAST(g AS BLOB)) - 1 AS idx FROM inner_top
),
{_tree("outer", "group_nodes")},
segments AS (
  SELECT k, ord, lft, rgt FROM inner_sibs
  UNION ALL
  SELECT l.k, 100 + o.ord, o.lft, o.rgt FROM leaves l JOIN outer_sibs o ON o.k = l.g
),
ranked AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY ord) AS r, lft, rgt FROM segments),
fold(k, r, cur) AS (
  SELECT k, 0, alt FROM leaves
  UNION ALL
  SELECT f.k, f.r + 1, sha256(s.lft || f.cur || s.rgt) FROM fold f JOIN ranked s ON s.k = f.k AND s.r = f.r + 1
),
folded AS (SELECT k, arg_max(cur, r) AS folded_root FROM fold GROUP BY k),
proofs AS (SELECT k, string_agg(lft || rgt, '' ORDER BY r) AS proof FROM ranked GROUP BY k)
SELECT l.doc_id, l.h AS leaf, i.top AS subroot, (SELECT top FROM outer_top) AS root,
       sha256(coalesce(p.proof, '')) AS proof_sha256, f.folded_root,
       f.folded_root = (SELECT top FROM outer_top) AS verified
FROM leaves l JOIN inner_top i USING (g) JOIN folded f USING (k) LEFT JOIN proofs p USING (k)"""


EMBEDDINGS = """
WITH RECURSIVE
rows AS (SELECT row_number() OVER () AS k, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT k, vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM rows
  WHERE e IS NOT NULL AND len(e) > 0 AND list_count(e) = len(e)
    AND NOT list_bool_or(list_transform(e, lambda x: isnan(x) OR isinf(x)))
    AND list_sum(list_transform(e, lambda x: x * x)) > 0
),
links AS (
  SELECT a.k AS a, b.k AS b FROM ok a JOIN ok b ON a.k < b.k AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(k, r) AS (
  SELECT k, k FROM ok
  UNION
  SELECT reach.k, w.b FROM reach JOIN both_ways w ON w.a = reach.r
),
least AS (SELECT reach.k, min(rows.vec_id) AS component_id FROM reach JOIN rows ON rows.k = reach.r GROUP BY reach.k),
counted AS (SELECT a AS k, count(*) AS n FROM both_ways GROUP BY a)
SELECT rows.vec_id, CAST(coalesce(counted.n, 0) AS BIGINT) AS n_links,
       CASE WHEN ok.k IS NULL THEN rows.vec_id ELSE least.component_id END AS component_id,
       rows.vec_id IS NOT DISTINCT FROM (CASE WHEN ok.k IS NULL THEN rows.vec_id ELSE least.component_id END) AS kept
FROM rows LEFT JOIN ok USING (k) LEFT JOIN least USING (k) LEFT JOIN counted USING (k)"""


SQL = {
    "op5_licenses": licences(),
    "op9_substring_dedup": SUBSTRINGS,
    "op11_embedding_dedup": EMBEDDINGS,
    "op13_merkle": MERKLE,
}
