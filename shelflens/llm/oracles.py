"""DuckDB SQL of the queries that SQL can express."""

ORACLES = {
    "op4_exact_topk": """
WITH v AS (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op5_mixing": """
WITH RECURSIVE sized AS (
    SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM sized GROUP BY source),
rounds AS (
    -- One round: share what is left among the sources that are not full; those above their limit become full.
    SELECT 0 AS round, []::VARCHAR[] AS full_names, false AS full_null, false AS done, 0.0::DOUBLE AS level
    UNION ALL
    SELECT * FROM (
        SELECT round + 1,
               list_sort((SELECT coalesce(list(source) FILTER (source IS NOT NULL AND (list_contains(full_names, source) OR 2 * source_size <= weight * l)), []) FROM sources)),
               full_null OR (SELECT coalesce(bool_or(source IS NULL AND 2 * source_size <= weight * l), false) FROM sources),
               (SELECT count(*) FROM sources WHERE 2 * source_size <= weight * l
                  AND NOT CASE WHEN source IS NULL THEN full_null ELSE list_contains(full_names, source) END) = 0,
               l
        FROM (
            SELECT round, full_names, full_null, done,
                   (SELECT 1.5 * sum(source_size) - coalesce(sum(2 * source_size) FILTER (
                        CASE WHEN source IS NULL THEN full_null ELSE list_contains(full_names, source) END), 0) FROM sources)::DOUBLE
                   / (SELECT sum(weight) FILTER (
                        NOT CASE WHEN source IS NULL THEN full_null ELSE list_contains(full_names, source) END) FROM sources)::DOUBLE AS l
            FROM rounds WHERE NOT done))),
last AS (SELECT * FROM rounds ORDER BY round DESC LIMIT 1),
targets AS (
    SELECT source, source_size, least(2.0::DOUBLE * source_size, CASE WHEN CASE WHEN source IS NULL THEN full_null
               ELSE list_contains(full_names, source) END THEN 2.0::DOUBLE * source_size ELSE weight * level END) AS target
    FROM sources, last),
placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, 'text:' || s.text, '')), s.doc_id, s.size
                             ROWS UNBOUNDED PRECEDING) - s.size AS before,
           CASE WHEN t.source_size > 0 THEN floor(floor(t.target) / t.source_size)::BIGINT ELSE 0 END AS passes
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (passes * size + greatest(0, least(size, floor(target)::BIGINT - passes * source_size - before)))::BIGINT AS taken
FROM placed""",
    "op8_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_filter_audit": """
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
masks AS (
    SELECT doc_id, part,
           CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
    FROM texts),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
counts AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
    FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
letters AS (SELECT substr('ABCDE', i, 1) AS letter, 1 << (i - 1) AS bit FROM range(1, 6) r(i)),
orders AS (
    SELECT '' AS filter_order, 0 AS before
    UNION ALL
    SELECT filter_order || letter, before | bit FROM orders JOIN letters ON before & bit = 0),
steps AS (
    SELECT filter_order, k AS step, bit,
           (SELECT coalesce(sum(b.bit), 0) FROM letters b WHERE contains(substr(filter_order, 1, k - 1), b.letter))::INT AS before
    FROM orders, range(1, 6) s(k), letters WHERE length(filter_order) = 5 AND letter = substr(filter_order, k, 1)),
summed AS (
    SELECT part, filter_order, step, bit,
           coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
           coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
           coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant,
           coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
           coalesce(sum(n_good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
           coalesce(sum(n_toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
    FROM counts, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM summed""",
}
