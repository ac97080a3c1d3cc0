"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from coinslot.llm.license_scan import ANCHORS, LOWER, RULES, SENTENCES, UPPER


def _license_scan() -> str:
    numbers = ", ".join(f"'{s}': {n}" for n, s in SENTENCES.items())
    anchored = " OR ".join(f"contains(s, '{a}')" for a in ANCHORS)
    names = ", ".join(
        "CASE WHEN " + " OR ".join(f"contains(fenced, ',{','.join(map(str, rule))},')" for rule in RULES[name]) + f" THEN '{name}' END"
        for name in sorted(RULES)
    )
    return f"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
lines AS (SELECT doc_id, string_split_regex(regexp_replace(t, '[.!?][ \\t]+', chr(10), 'g'), '[\\n\\r]') AS l FROM lowered),
plain AS (
  SELECT doc_id, list_filter(list_transform(l, lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))), lambda s: {anchored}) AS p
  FROM lines),
known AS (
  SELECT doc_id, list_filter(list_transform(p, lambda s: MAP {{{numbers}}}[s]), lambda n: n IS NOT NULL) AS ids FROM plain),
listed AS (SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids FROM known),
fences AS (SELECT doc_id, sentence_ids, ',' || sentence_ids || ',' AS fenced FROM listed)
SELECT doc_id, sentence_ids, concat_ws(',', {names}) AS licenses FROM fences"""


def _ngram_jaccard() -> str:
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS ws FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS grams FROM w),
e AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM g),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, a.n AS m, b.n AS n, count(*) AS i
  FROM e a JOIN e b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p WHERE 100 * i >= 75 * (m + n - i)),
b AS (SELECT u AS x, v AS y FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT x AS doc_id, y AS reached FROM b UNION SELECT r.doc_id, b.y FROM r JOIN b ON b.x = r.reached),
c AS (SELECT doc_id, min(reached) AS least FROM r GROUP BY doc_id)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, least(doc_id, coalesce(c.least, doc_id)) AS component_id
FROM g LEFT JOIN c USING (doc_id)"""


def _exact_dedup() -> str:
    return """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS sha FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY sha ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY sha) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha AS text_sha256 FROM k"""


def _topk() -> str:
    return """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard": _ngram_jaccard(),
    "op7_exact_dedup": _exact_dedup(),
    "op8_license_scan": _license_scan(),
    "op10_topk": _topk(),
}
