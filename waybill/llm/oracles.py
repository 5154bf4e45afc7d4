"""The queries of this subpackage that SQL can express, for DuckDB."""

OP4 = r"""
WITH RECURSIVE listed AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 3),
                                          lambda i: array_to_string(list_slice(words, i, i + 4), ' '))) END AS shingles
    FROM listed
), posted AS (
    SELECT doc_id, len(shingles) AS size, unnest(shingles) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM posted a JOIN posted b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.size, b.size
    HAVING 100 * count(*) >= 75 * (a.size + b.size - count(*))
), reach AS (
    SELECT a AS doc_id, b AS other FROM links
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
), least AS (
    SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id
)
SELECT sets.doc_id, len(shingles)::BIGINT AS n_shingles,
       least(sets.doc_id, coalesce(other, sets.doc_id)) AS component_id,
       sets.doc_id <= coalesce(other, sets.doc_id) AS kept
FROM sets LEFT JOIN least USING (doc_id)
"""

OP9 = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vector, c.vector)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY rank <= 5
"""

OP10 = """
WITH RECURSIVE sizes AS (
    SELECT source, count(*) AS documents, pow(count(*)::DOUBLE, 0.5) AS weight FROM documents GROUP BY source
), rates AS (
    SELECT source, sum(documents) OVER () * weight / (sum(weight) OVER () * documents) AS rate FROM sizes
), parts AS (
    SELECT source, greatest(ceil(rate / 16), 1)::INTEGER AS parts, rate / greatest(ceil(rate / 16), 1) AS mean FROM rates
), terms AS (
    SELECT source, mean, 0 AS k, exp(-mean) AS term, exp(-mean) AS reached FROM parts
    UNION ALL
    SELECT source, mean, k + 1, term * mean / (k + 1), reached + term * mean / (k + 1) FROM terms WHERE k < 120
), chances AS (
    SELECT doc_id, text, lang, d.source, n_chars, part,
           (('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, 'null') || '|' || part), 1, 12))::BIGINT + 0.5::DOUBLE)
           / pow(2, 48) AS chance
    FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, parts + 1)) AS numbers(part)
), drawn AS (
    SELECT c.doc_id, c.part, count(reached) AS copies
    FROM chances c LEFT JOIN terms t ON c.source IS NOT DISTINCT FROM t.source AND reached < chance
    GROUP BY c.doc_id, c.part
), counted AS (
    SELECT doc_id, sum(copies)::INTEGER AS copies FROM drawn GROUP BY doc_id
)
SELECT d.*, copy::INTEGER AS copy
FROM documents d JOIN counted USING (doc_id), unnest(range(0, copies)) AS numbers(copy)
"""

OP13 = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), flags AS (
    SELECT doc_id, part,
           len(words) < 50 AS a,
           100 * len(list_distinct(words)) < 65 * len(words) AS b,
           100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c,
           regexp_matches(t, '[#$%&*|]') AS d,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
    FROM texts
), known AS (
    SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), sets AS (
    SELECT part, a::INT + b::INT * 2 + c::INT * 4 + d::INT * 8 + e::INT * 16 AS failed, count(*) AS documents,
           count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
    FROM flags LEFT JOIN known USING (doc_id) GROUP BY ALL
), letters AS (
    SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS letters(letter, bit)
), orders AS (
    SELECT p.letter || q.letter || r.letter || s.letter || t.letter AS filter_order
    FROM letters p, letters q, letters r, letters s, letters t
    WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND len(list_distinct([p.bit, q.bit, r.bit, s.bit, t.bit])) = 5
), steps AS (
    SELECT filter_order, step::INTEGER AS step, letter, bit,
           (SELECT coalesce(sum(bit), 0) FROM letters l WHERE instr(filter_order, l.letter) < step)::INT AS before
    FROM orders, unnest(range(1, 6)) AS steps(step) JOIN letters ON letter = substr(filter_order, step, 1)
), figures AS (
    SELECT part, filter_order, step, letter,
           coalesce(sum(documents) FILTER (WHERE failed & (before | bit) = 0), 0)::BIGINT AS kept,
           coalesce(sum(documents) FILTER (WHERE failed & before = 0 AND failed & bit > 0), 0)::BIGINT AS removed,
           coalesce(sum(documents) FILTER (WHERE failed & before > 0 AND failed & bit > 0), 0)::BIGINT AS redundant,
           coalesce(sum(documents) FILTER (WHERE failed = bit), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (WHERE failed & before = 0 AND failed & bit > 0), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (WHERE failed & before = 0 AND failed & bit > 0), 0)::BIGINT AS toxic_lost
    FROM sets, steps GROUP BY ALL
)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM figures
"""

ORACLES = {
    "op4_near_dedup": OP4,
    "op9_topk_search": OP9,
    "op10_source_mixing": OP10,
    "op13_filter_audit": OP13,
}
