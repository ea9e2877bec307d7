"""DuckDB SQL with the rows of the registered queries."""

QUALITY_RULES = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
    SELECT rid, doc_id, text, string_split(text, chr(10)) AS lines,
           list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM docs),
windows AS (
    SELECT rid, unnest(range(1, len(words) - 1)) AS i, words FROM split WHERE len(words) >= 3),
marked AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS n FROM windows),
repeated AS (
    SELECT rid, count(DISTINCT place) AS n
    FROM (SELECT rid, i + unnest([0, 1, 2]) AS place FROM marked WHERE n > 1) GROUP BY rid),
line AS (
    SELECT rid, line, len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
    FROM (SELECT rid, unnest(lines) AS line FROM split)),
judged AS (
    SELECT rid, line, n,
           n = 0 OR ((n < 12 OR regexp_matches(line, '[.!?;:…。！？]'))
             AND len(regexp_extract_all(line, '[#*$%&|<>]')) <= n * 0.3
             AND len(regexp_extract_all(line, '!')) <= greatest(1, n * 0.3)
             AND len(regexp_extract_all(line, '[\x20\x09-\x0D][|»›·•>][\x20\x09-\x0D]')) < 3
             AND NOT regexp_matches(lower(line), 'all rights reserved|cookie policy|privacy policy|terms of use|terms of service|enable javascript|click here|lorem ipsum|licensed under|released under the|general public license'))
           AS good
    FROM line),
lines AS (
    SELECT rid, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
           count(*) FILTER (NOT good) AS n_failed_lines,
           sum(length(line)) AS all_chars, coalesce(sum(length(line)) FILTER (good), 0) AS good_chars
    FROM judged GROUP BY rid),
measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           n_dup_lines::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
           n_failed_lines::BIGINT AS n_failed_lines, all_chars, good_chars
    FROM split JOIN lines USING (rid) LEFT JOIN repeated USING (rid)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND good_chars >= 0.5 * all_chars AS kept, n_failed_lines
FROM failed
"""

CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
escaped AS (
    SELECT *, regexp_replace(text, '<(\\*)\|(im_start|im_end)\|>', '<\\\1|\2|>', 'g') AS written FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(12 + length(role) + 1 + length(written) + 11)::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant')::BIGINT AS n_learned
FROM escaped GROUP BY conv_id
"""

FILL_IN_MIDDLE = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
numbers AS (
    SELECT doc_id, text, length(text)::BIGINT AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
           ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4
    FROM drawn),
cuts AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers),
parts AS (
    SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix
    FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
