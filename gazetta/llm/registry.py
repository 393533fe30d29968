"""The queries of this subpackage. Exact top-k has an SQL twin; the others cannot be written in the SQL of the checking engine whole: tests hold them against brute force."""

from __future__ import annotations

from . import ann, bpe, langid, lines, mixing, quality, simhash, substring, topk, urls

QUERIES = {
    "op1_substring_dedup": substring.op1,
    "op2_source_mixing": mixing.op2,
    "op3_byte_bpe": bpe.op3,
    "op4_exact_top_k": topk.op4,
    "op5_url_filters": urls.op5,
    "op6_quality_classifier": quality.op6,
    "op7_language_id": langid.op7,
    "op8_simhash_near_dedup": simhash.op8,
    "op9_line_dedup": lines.op9,
    "op10_ann_search": ann.op10,
}
ORACLES: dict[str, str] = {
    "op4_exact_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
}
