"""DuckDB SQL for the operators' queries, where SQL can express them."""

from __future__ import annotations

OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.ints, c.ints) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP12 = f"""
WITH q AS (SELECT item_id, row_number() OVER () AS item, {_TERMS} AS terms FROM benchmark),
entry AS (SELECT DISTINCT item, item_id, term FROM (SELECT item, item_id, unnest(terms) AS term FROM q)),
d AS (SELECT doc_id, row_number() OVER () AS doc, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
counted AS (SELECT doc, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS words FROM counted),
tf AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM counted)
  WHERE term IN (SELECT term FROM entry) GROUP BY doc, term
),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
),
score AS (
  SELECT item, item_id, doc, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * documents) // words))))) AS BIGINT) AS score
  FROM entry JOIN weight USING (term) JOIN tf USING (term) JOIN counted USING (doc), total
  GROUP BY item, item_id, doc, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= 50
"""


def oracle() -> dict[str, str]:
    """SQL by query name."""
    return {"op3_top_k": OP3, "op12_lexical_search": OP12}
