"""DuckDB statements for the numbered queries that SQL can express."""

TOKEN_COUNTS = r"""
WITH kept AS (
    SELECT text, source, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS nth
    FROM documents
), plain AS (
    SELECT source, lang, regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g') AS text
    FROM kept
    WHERE nth = 1 OR text IS NULL
), counted AS (
    SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS tokens FROM plain
    UNION ALL
    SELECT source, lang, 'pieces-1', len(regexp_extract_all(text, '[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) FROM plain
)
SELECT source, lang, version, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
FROM counted
GROUP BY source, lang, version
"""

LINE_DEDUP = r"""
WITH raw AS (
    SELECT doc_id,
           unnest(string_split(text, chr(10))) AS txt,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
    FROM documents
), lines AS (
    SELECT row_number() OVER (ORDER BY doc_id, line) AS id, doc_id, line,
           list_distinct(regexp_extract_all(txt, '[^\x20\x09-\x0D]+')) AS words
    FROM raw
    WHERE regexp_matches(txt, '[^\x20\x09-\x0D]')
), words AS (
    SELECT id, len(words) AS n, unnest(words) AS word FROM lines
), frequency AS (
    SELECT word, count(*) AS df FROM words GROUP BY word
), ranked AS (
    SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY df, word) AS pos
    FROM words JOIN frequency USING (word)
), prefix AS (
    SELECT * FROM ranked WHERE pos <= n - (n * 80 + 99) // 100 + 1
), candidates AS (
    SELECT DISTINCT a.id AS first_id, b.id AS later_id
    FROM prefix a JOIN prefix b
      ON a.word = b.word AND a.id < b.id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), removed AS (
    SELECT DISTINCT l.id, l.doc_id, l.line
    FROM candidates c JOIN lines f ON f.id = c.first_id JOIN lines l ON l.id = c.later_id
    WHERE 180 * len(list_intersect(f.words, l.words)) >= 80 * (len(f.words) + len(l.words))
), counted AS (
    SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id
), gone AS (
    SELECT doc_id, count(*) AS n_removed, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS removed_lines
    FROM removed GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed_lines, '') AS removed_lines
FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

LEXICAL_SEARCH = r"""
WITH doc AS (
    SELECT row_number() OVER () AS row_id, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), long AS (
    SELECT row_id, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM doc WHERE len(terms) > 0
), total AS (
    SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM long
), item AS (
    SELECT DISTINCT item_id, text FROM benchmark
), asked AS (
    SELECT item_id, term, CAST(count(*) AS BIGINT) AS times
    FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM item
    )
    GROUP BY item_id, term
), posting AS (
    SELECT row_id, term, CAST(count(*) AS BIGINT) AS tf
    FROM (SELECT row_id, unnest(terms) AS term FROM long)
    WHERE term IN (SELECT term FROM asked)
    GROUP BY row_id, term
), weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM posting, total
    GROUP BY term
), scored AS (
    SELECT item_id, posting.row_id,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS score
    FROM asked JOIN posting USING (term) JOIN weight USING (term) JOIN long USING (row_id), total
    GROUP BY item_id, posting.row_id
), ranked AS (
    SELECT item_id, doc_id, score,
           row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
    FROM scored JOIN long USING (row_id)
    WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM ranked
WHERE rank <= 20
"""

ORACLES = {"op6_token_counts": TOKEN_COUNTS, "op9_line_dedup": LINE_DEDUP, "op12_lexical_search": LEXICAL_SEARCH}
