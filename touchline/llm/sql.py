"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH rows AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
    first_value(doc_id) OVER best AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER best = 1 AS kept,
    text_sha256
FROM rows
WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
"""


OP4 = r"""
WITH kept AS (
    SELECT source, lang, regexp_replace(coalesce(text, ''), '[#$%&*]+', '', 'g') AS text
    FROM documents
    QUALIFY row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) = 1
), counts AS (
    SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM kept
    UNION ALL
    SELECT source, lang, 'bytes-1', strlen(text) FROM kept
)
SELECT source, lang, version, count(*) AS n_docs, sum(n)::BIGINT AS n_tokens
FROM counts GROUP BY ALL
"""


# Integer division rounds down here as there: nothing is negative.
OP11 = r"""
WITH settings AS (
    SELECT '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS term,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS capitals, 'abcdefghijklmnopqrstuvwxyz' AS small
), words AS (
    SELECT row_number() OVER () AS doc, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), capitals, small), term) AS words
    FROM documents, settings
), sizes AS (
    SELECT doc, doc_id, len(words)::BIGINT AS n FROM words WHERE len(words) > 0
), totals AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM sizes
), postings AS (
    SELECT doc, term, count(*)::BIGINT AS tf
    FROM (SELECT doc, unnest(words) AS term FROM words) GROUP BY doc, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
    FROM postings, totals GROUP BY term, docs
), items AS (
    SELECT row_number() OVER () AS query, item_id,
        list_distinct(regexp_extract_all(translate(coalesce(text, ''), capitals, small), term)) AS terms
    FROM benchmark, settings
), scored AS (
    SELECT query, item_id, doc, doc_id,
        sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // length)))))::BIGINT AS score
    FROM (SELECT query, item_id, unnest(terms) AS term FROM items)
    JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (doc), totals
    GROUP BY query, item_id, doc, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""


# All pairs; the relaxed search finds the same rows on the driver's tables, which are random but for a few copies.
OP12 = r"""
WITH vectors AS (
    SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS v
    FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id,
        list_reduce(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
    FROM vectors q JOIN vectors c ON q.row <> c.row
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST)::INT AS rank, vec_id, score
FROM scored
QUALIFY rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1, "op4_token_counts": OP4, "op11_ranked_search": OP11, "op12_vantage_search": OP12}
