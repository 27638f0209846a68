"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from stormline.llm.conversations import op13_conversation_repair
from stormline.llm.fingerprint import op2_fingerprint
from stormline.llm.langid import op10_language_id
from stormline.llm.linededup import op8_line_dedup
from stormline.llm.lm import op9_lm_score
from stormline.llm.mixing import op4_mixing
from stormline.llm.ngram_join import op1_ngram_jaccard_join
from stormline.llm.passages import op11_passage_dedup
from stormline.llm.pieces import op7_piece_sampling
from stormline.llm.secrets import op3_secret_scan
from stormline.llm.sharding import op5_sharding
from stormline.llm.topk import op6_topk
from stormline.llm.variants import op12_spelling_variants

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_fingerprint": op2_fingerprint,
    "op3_secret_scan": op3_secret_scan,
    "op4_mixing": op4_mixing,
    "op5_sharding": op5_sharding,
    "op6_topk": op6_topk,
    "op7_piece_sampling": op7_piece_sampling,
    "op8_line_dedup": op8_line_dedup,
    "op9_lm_score": op9_lm_score,
    "op10_language_id": op10_language_id,
    "op11_passage_dedup": op11_passage_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op6_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                 list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op11_passage_dedup": """
        WITH d AS (
          SELECT row_number() OVER () AS k, doc_id, coalesce(doc_id, 9223372036854775807) AS o, hex(encode(coalesce(text, ''))) AS x FROM documents
        ), g AS (
          SELECT k, o, 500 * c + j AS i, substr(y, 2 * j + 1, 100) AS w
          FROM (SELECT k, o, c, y, unnest(range(length(y) // 2 - 49)) AS j FROM (SELECT k, o, c, substr(x, 1000 * c + 1, 1098) AS y FROM (SELECT k, o, x, unnest(range((length(x) // 2 - 50) // 500 + 1)) AS c FROM d WHERE length(x) >= 100)))
        ), m AS (SELECT w, min(o) AS o FROM g GROUP BY w
        ), r AS (
          SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS p FROM (SELECT g.k, g.i FROM g JOIN m ON g.w = m.w WHERE m.o < g.o)
        ), s AS (
          SELECT k, min(i) AS a, max(i) + 50 AS b
          FROM (SELECT *, sum(CASE WHEN p IS NULL OR i > p + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY i) AS run FROM r) GROUP BY k, run
        ), t AS (
          SELECT k, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(before, '' ORDER BY a) AS kept, max(b) AS last
          FROM (SELECT s.k, a, b, substr(x, 2 * coalesce(lag(b) OVER (PARTITION BY s.k ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(b) OVER (PARTITION BY s.k ORDER BY a), 0))) AS before FROM s JOIN d ON s.k = d.k)
          GROUP BY k
        )
        SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN t ON d.k = t.k
    """,
}
