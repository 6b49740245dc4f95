"""DuckDB SQL of the queries that SQL can express on whole tables."""

SQL = {
    "op1_decontaminate": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p + 1:p + least(len(w), 13)], ' ') AS gram
            FROM (SELECT *, unnest(range(greatest(len(w) - 12, 1))) AS p FROM items WHERE len(w) > 0)
        ), runs AS (
            SELECT doc_id, p, n, array_to_string(w[p + 1:p + n], ' ') AS gram
            FROM (SELECT doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS p
                  FROM words CROSS JOIN (SELECT DISTINCT n FROM windows))
        ), hits AS (
            SELECT doc_id, p, runs.n, item_id FROM runs JOIN windows ON runs.gram = windows.gram AND runs.n = windows.n
        ), spots AS (
            SELECT doc_id, count(DISTINCT spot)::BIGINT AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + n)) AS spot FROM hits) GROUP BY doc_id
        ), found AS (
            SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM words LEFT JOIN spots USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
    "op8_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, n, line, translate(trim(line, E' \t\n\x0b\x0c\r'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), E'\n')) AS line,
                         generate_subscripts(string_split(coalesce(text, ''), E'\n'), 1) AS n
                  FROM documents)
        ), repeated AS (
            SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ), marked AS (
            SELECT lines.*, repeated.key IS NOT NULL AS gone FROM lines LEFT JOIN repeated USING (key)
        )
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(line, E'\n' ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op11_lexical_search": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), asked AS (
            SELECT item_id, term, count(*)::BIGINT AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
            GROUP BY ALL
        ), totals AS (
            SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM words WHERE len(w) > 0
        ), held AS (
            SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM words
        ), tf AS (
            SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM held
            WHERE term IN (SELECT term FROM asked) GROUP BY ALL
        ), weights AS (
            SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight
            FROM tf CROSS JOIN totals GROUP BY term
        ), scores AS (
            SELECT item_id, doc_id,
                   sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM tf JOIN weights USING (term) JOIN asked USING (term) CROSS JOIN totals GROUP BY item_id, doc_id
        )
        SELECT item_id, rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
              FROM scores WHERE score > 0)
        WHERE rank <= 10
    """,
}
