"""SQL for the registered queries of this folder, where SQL can express them."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_minhash_groups"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
    FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS id, doc_id AS r FROM documents
    UNION
    SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.r
), groups AS (
    SELECT id, min(r) AS component_id FROM reach GROUP BY id
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN groups ON groups.id = doc_id
"""

ORACLE_SQL["op9_rule_cascade"] = r"""
WITH texts AS (
    SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(str_split(text, chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS line_list
    FROM texts
), starts AS (
    SELECT row_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5
), windows AS (
    SELECT row_id, i, count(*) OVER (PARTITION BY row_id, array_to_string(w[i:i + 4], ' ')) AS n
    FROM starts
), covered AS (
    SELECT DISTINCT row_id, unnest(range(i, i + 5)) AS word FROM windows WHERE n > 1
), repeats AS (
    SELECT row_id, count(*) AS n_repeat_words FROM covered GROUP BY row_id
), counts AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_shouts,
        len(line_list)::BIGINT AS n_lines,
        (len(line_list) - len(list_distinct(line_list)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM words LEFT JOIN repeats USING (row_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > 3 * n_words
        OR 10 * n_shouts > 3 * n_words OR 10 * n_dup_lines > 3 * n_lines
        OR word_chars > 25 * n_words) AS kept
FROM counts
"""

ORACLE_SQL["op6_chat_segments"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL
    SELECT -7, turn, role, '</s>[INST] ok [/INST]'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS extra(turn, role)
), placed AS (
    SELECT *, row_number() OVER w - 1 AS k, lag(role, 1, '') OVER w AS state,
        count(*) OVER (PARTITION BY conv_id) AS n
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), checked AS (
    SELECT *, (state, role) NOT IN (('', 'system'), ('', 'user'), ('system', 'user'),
            ('user', 'assistant'), ('assistant', 'user')) AS wrong,
        length(text) + 2 * (length(text) - length(replace(text, chr(92), '')))
            - 1 * (length(text) - length(replace(text, '</s>', ''))) // 4
            - 5 * (length(text) - length(replace(text, '<</SYS>>', ''))) // 8
            - 4 * (length(text) - length(replace(text, '<<SYS>>', ''))) // 7
            - 0 * (length(text) - length(replace(text, '<s>', ''))) // 3
            - 4 * (length(text) - length(replace(text, '[/INST]', ''))) // 7
            - 4 * (length(text) - length(replace(text, '[/TURN]', ''))) // 7
            - 3 * (length(text) - length(replace(text, '[INST]', ''))) // 6
            - 3 * (length(text) - length(replace(text, '[SAYS]', ''))) // 6
            - 3 * (length(text) - length(replace(text, '[TURN]', ''))) // 6
            + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                ELSE 19 + length(role) END AS chars
    FROM placed
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars,
    coalesce(min(k) FILTER (wrong),
        CASE WHEN arg_max(role, k) <> 'assistant' THEN max(n) END) IS NULL AS valid,
    coalesce(min(k) FILTER (wrong),
        CASE WHEN arg_max(role, k) <> 'assistant' THEN max(n) END)::INTEGER AS first_bad_turn
FROM checked GROUP BY conv_id
"""

ORACLE_SQL["op12_source_divergence"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT row_id, lang, source,
        unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
), kept AS (
    SELECT lang, term, count(*) AS total FROM words
    GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3
), sources AS (
    SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term
), grid AS (
    SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n, total,
        sum(coalesce(n, 0)) OVER (PARTITION BY s.lang, s.source) AS size,
        sum(coalesce(n, 0)) OVER (PARTITION BY s.lang) AS lang_size,
        count(*) OVER (PARTITION BY s.lang, s.source) AS v
    FROM sources s JOIN kept k USING (lang) LEFT JOIN counts c
        ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), shares AS (
    SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 1)) // (size + v) AS p,
        1 + (1000000000::HUGEINT * (total + 1)) // (lang_size + v) AS q
    FROM grid
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
    FROM every
)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR place <= 200
"""
