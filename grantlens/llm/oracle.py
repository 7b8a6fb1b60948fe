"""DuckDB SQL for the queries that SQL can express."""

ORACLE = {
    "op6_exact_dedup": r"""
WITH digests AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), groups AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM digests JOIN groups USING (text_sha256)
""",
    "op7_line_dedup": r"""
WITH split AS (
    SELECT doc_id, coalesce(source, '') AS site,
        unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), lines AS (
    SELECT *, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS trimmed FROM split
), counted AS (
    SELECT *, CASE WHEN trimmed = '' THEN 0 ELSE len(string_split(trimmed, ' ')) END AS n_words FROM lines
), spread AS (
    SELECT trimmed FROM counted WHERE n_words > 0 GROUP BY trimmed, n_words
    HAVING count(DISTINCT site) >= CASE WHEN n_words < 4 THEN 16 ELSE 8 END
), hosts AS (
    SELECT doc_id FROM counted LEFT JOIN spread USING (trimmed) GROUP BY doc_id
    HAVING 100 * coalesce(sum(n_words) FILTER (spread.trimmed IS NOT NULL), 0) <= 50 * sum(n_words)
), boilerplate AS (
    SELECT trimmed FROM counted SEMI JOIN hosts USING (doc_id) SEMI JOIN spread USING (trimmed)
    GROUP BY trimmed, n_words HAVING count(DISTINCT site) >= CASE WHEN n_words < 4 THEN 16 ELSE 8 END
), marked AS (
    SELECT counted.*, boilerplate.trimmed IS NOT NULL AS found
    FROM counted LEFT JOIN boilerplate USING (trimmed)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (found) AS n_removed,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT found), '')) AS text_sha256
FROM marked GROUP BY doc_id
""",
    "op4_preference_format": r"""
WITH said AS (
    SELECT CAST(conv_id AS BIGINT) AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
), answers AS (
    SELECT pair_id, max(turn) AS last, arg_max(text, turn) AS answer FROM said WHERE role = 'assistant' GROUP BY 1
), turns AS (
    SELECT pair_id, 0 AS side, turn, role, text FROM said LEFT JOIN answers USING (pair_id)
    WHERE last IS NULL OR turn <= last
    UNION ALL
    SELECT pair_id, 1, turn, role, text FROM said LEFT JOIN answers USING (pair_id)
    WHERE last IS NULL OR turn < last
    UNION ALL
    SELECT own.pair_id, 1, own.last, 'assistant', next.answer
    FROM answers own JOIN answers next ON next.pair_id = own.pair_id + 1
), firsts AS (
    SELECT pair_id, min(turn) AS first FROM (
        SELECT pair_id, turn FROM turns GROUP BY pair_id, turn
        HAVING count(*) < 2 OR min(role) <> max(role) OR min(text) <> max(text)
    ) GROUP BY pair_id
), rendered AS (
    SELECT pair_id, side, turn, role, first,
        '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS piece,
        first IS NULL OR turn < first AS common
    FROM turns LEFT JOIN firsts USING (pair_id)
), placed AS (
    SELECT *, coalesce(sum(length(piece)) OVER (
        PARTITION BY pair_id, side, common ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    ), 0)::BIGINT AS place
    FROM rendered
), masked AS (
    SELECT *, CASE WHEN role = 'assistant' AND NOT common
        THEN (place + length('<|im_start|>' || role) + 1) || ':' || (place + length(piece)) END AS mask
    FROM placed
)
SELECT pair_id,
    count(*) FILTER (common AND side = 0) AS n_common,
    sha256(coalesce(string_agg(piece, '' ORDER BY turn) FILTER (common AND side = 0), '')) AS prompt_sha256,
    sha256(coalesce(string_agg(piece, '' ORDER BY turn) FILTER (NOT common AND side = 0), '')) AS chosen_sha256,
    sha256(coalesce(string_agg(piece, '' ORDER BY turn) FILTER (NOT common AND side = 1), '')) AS rejected_sha256,
    coalesce(string_agg(mask, ',' ORDER BY turn) FILTER (side = 0), '') AS chosen_mask,
    coalesce(string_agg(mask, ',' ORDER BY turn) FILTER (side = 1), '') AS rejected_mask
FROM masked GROUP BY pair_id
""",
}
