"""SQL for DuckDB that gives the same rows as each registered query."""

# The whitespace Python's str.strip() removes, as SQL.
_POINTS = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS = "(" + " || ".join(f"chr({p})" for p in _POINTS) + ")"

# The three patterns.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"


def clean(col: str) -> str:
    return rf"regexp_replace(trim(coalesce({col}, ''), {WS}), '\n{{3,}}', chr(10) || chr(10), 'g')"


def redact(col: str, *patterns: str) -> str:
    for pattern in patterns or (EMAIL, PHONE, SSN):
        col = f"regexp_replace({col}, '{pattern}', '[REDACTED]', 'g')"
    return col


def capital(col: str) -> str:
    return f"upper(left({col}, 1)) || lower(substr({col}, 2))"


def usable(col: str) -> str:
    return f"coalesce(length({col}) BETWEEN 10 AND 8000 AND trim({col}, {WS}) <> '', false)"


VALID = f"({usable('Context')} AND {usable('Response')})"

DOC_PAIRS = """doc_pairs AS (
  SELECT doc_id, split_part(text, chr(10), 1) AS Context,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) END AS Response
  FROM documents)"""

DIRTY_TURNS = """dirty_turns AS (
  SELECT conv_id, turn, role,
         chr(160) || ' ' || text || repeat(chr(10), 4) || 'mail u' || CAST(conv_id AS VARCHAR) || '@ex.com tel 555-'
         || lpad(right(CAST(conv_id AS VARCHAR), 3), 3, '0') || '-' || lpad(CAST(turn AS VARCHAR), 4, '0')
         || ' id 123-45-' || lpad(CAST(turn AS VARCHAR), 4, '0') || ' ' || chr(9) AS text
  FROM conversations)"""

PREPARED = f"""{DOC_PAIRS}, kept AS (
  SELECT doc_id, {clean('Context')} AS question, {clean('Response')} AS answer
  FROM doc_pairs WHERE {VALID}), ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS pos, count(*) OVER () AS n
  FROM kept), prepared AS (
  SELECT doc_id, question, answer, pos,
         CASE WHEN pos <= trunc(n * 0.97::DOUBLE) THEN 'train' ELSE 'val' END AS split
  FROM ranked)"""


def messages(source: str) -> str:
    """One row per message with its place in the sample."""
    return f"""msgs AS (
  SELECT conv_id, role, text AS content, turn,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS msg_idx
  FROM {source})"""


def rendered(line: str, between: str, alias: str = "text") -> str:
    return f"string_agg({line}, {between} ORDER BY turn) AS {alias}"


SPARSE_TURNS = """sparse AS (
  SELECT CASE WHEN conv_id % 3 = 0 THEN 0 ELSE conv_id END AS conv_id, (conv_id * 100 + turn // 2) * 1000000 AS turn, role, text
  FROM conversations)"""

TAGGED = "'<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10)"

RAW = """said AS (
  SELECT conv_id, turn, role, CAST(to_json({'role': role, 'content': text}) AS VARCHAR) AS js FROM conversations), raw AS (
  SELECT conv_id, turn, CASE
    WHEN role = 'system' THEN '{"text":' || js || '}'
    WHEN turn = 0 THEN '{"messages":[' || js || ']}'
    WHEN turn = 1 THEN '{"messages":[' || js || ',{"role":"assistant","content":null}]}'
    WHEN turn = 2 THEN '{"messages":[' || js || ',{"role":"bot","content":"x"}]}'
    WHEN turn = 3 THEN '{"messages":[' || js || ',{"role":"user"}]}'
    WHEN turn = 4 THEN '{"messages":[' || js || ',"x"]}'
    WHEN turn = 5 THEN '{"messages":' || js || '}'
    WHEN turn = 6 THEN '{"id":7,"messages":[' || js || ',{"role":"assistant","content":5,"extra":true}]}'
    ELSE '{"messages":[' || js END AS value
  FROM said)"""

SAMPLE_ISSUES = f"""WITH {messages('conversations')}, per AS (
  SELECT conv_id, count(*) AS n, arg_min(role, turn) AS r0, arg_max(role, turn) AS r1 FROM msgs GROUP BY conv_id),
issues AS (
  SELECT conv_id AS sample_id, CAST(NULL AS BIGINT) AS msg_idx, 'message_count' AS rule,
         'Sample ' || conv_id || ': Expected 2 messages, got ' || n AS detail FROM per WHERE n <> 2
  UNION ALL
  SELECT conv_id, NULL, 'first_role', 'Sample ' || conv_id || ': First message should have role ''user''' FROM per
  WHERE n = 2 AND r0 <> 'user'
  UNION ALL
  SELECT conv_id, NULL, 'second_role', 'Sample ' || conv_id || ': Second message should have role ''assistant''' FROM per
  WHERE n = 2 AND r1 <> 'assistant')"""

STATS = """num_samples, num_features, features,
  round(avg_messages_per_sample, 6) AS avg_messages_per_sample, min_messages, max_messages,
  round(avg_content_length, 6) AS avg_content_length, min_content_length, max_content_length"""

EVAL_TURNS = """numbered AS (
  SELECT row_number() OVER (ORDER BY u.conv_id, u.turn) AS sample_id, u.turn, u.text, length(u.text) AS size, a.text AS response
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user'), asked AS (
  SELECT sample_id, response,
    CASE WHEN (turn < 4 AND size >= 30) OR turn >= 6 THEN text END AS message,
    CASE WHEN turn >= 4 AND size >= 100 THEN 'Q: ' || text WHEN turn >= 4 THEN '' END AS prompt,
    CASE WHEN size >= 60 THEN CASE WHEN contains(text, '?') THEN 'question' ELSE 'statement' END END AS category,
    CASE WHEN length(response) > 1200 THEN 'response too long' END AS response_error
  FROM numbered), prompts AS (
  SELECT *, CASE WHEN message IS NOT NULL THEN 'User: ' || message || chr(10) || 'Assistant:' ELSE prompt END AS model_prompt,
    CASE WHEN message IS NULL AND prompt IS NULL THEN 'Sample must have ''messages'' or ''prompt'' field' END AS prompt_error
  FROM asked), failed AS (
  SELECT *, coalesce(prompt_error, response_error, CASE WHEN response IS NULL THEN 'no response' END) AS error
  FROM prompts), results AS (
  SELECT sample_id, error,
    CASE WHEN error IS NULL THEN model_prompt END AS model_prompt,
    CASE WHEN error IS NULL THEN coalesce(nullif(prompt, ''), message, '') END AS prompt,
    CASE WHEN error IS NULL THEN response END AS response,
    CASE WHEN error IS NULL THEN category END AS category,
    CASE WHEN error IS NULL THEN CAST(category IS NOT NULL AS BIGINT) END AS n_metadata,
    CASE WHEN error IS NULL THEN CAST(256 AS BIGINT) END AS max_new_tokens,
    CASE WHEN error IS NULL THEN 0.7::DOUBLE END AS temperature,
    CASE WHEN error IS NULL THEN 0.9::DOUBLE END AS top_p
  FROM failed)"""

ORACLES = {
    "jsonl_roundtrip": f"WITH {messages('conversations')} SELECT conv_id, msg_idx, role, content FROM msgs",
    "jsonl_mixed_types": """SELECT conv_id AS conv, turn, CASE turn % 5 WHEN 0 THEN turn::VARCHAR WHEN 1 THEN '"' || turn || '"'
          WHEN 2 THEN '[' || turn || ',"x"]' WHEN 3 THEN CAST(to_json({'t': text}) AS VARCHAR) ELSE 'true' END AS value FROM conversations""",
    "jsonl_quarantine": f"""WITH {RAW}, odd AS (
          SELECT CASE WHEN turn = 4 THEN '[' || value || ']' ELSE value END AS value FROM raw), judged AS (
          SELECT value, CASE WHEN NOT json_valid(value) THEN 'not valid JSON' WHEN json_type(value) <> 'OBJECT' THEN 'not an object' END AS reason
          FROM odd)
        SELECT CAST(NULL AS VARCHAR) AS content, CAST(NULL AS BIGINT) AS id, value AS text, reason FROM judged WHERE reason IS NOT NULL
        UNION ALL SELECT coalesce(json_extract_string(value, '$.text.content'), json_extract_string(value, '$.messages[0].content'),
          json_extract_string(value, '$.messages.content')), CAST(json_extract(value, '$.id') AS BIGINT), NULL, NULL
        FROM (SELECT value FROM judged WHERE reason IS NULL)""",
    "stream_curate": f"""WITH {DOC_PAIRS}
        SELECT doc_id, CASE WHEN CAST('0x' || left(md5('42:' || CAST(doc_id AS VARCHAR)), 8) AS BIGINT) / 4294967296.0::DOUBLE
                 < 0.9::DOUBLE THEN 'train' ELSE 'val' END AS split, 'user' AS first_role, {redact(clean('Context'))} AS question,
               'assistant' AS second_role, {redact(clean('Response'))} AS answer FROM doc_pairs WHERE {VALID}""",
    "published_splits": """WITH s AS (SELECT doc_id, text, CASE WHEN CAST('0x' || left(md5('7:' || CAST(doc_id AS VARCHAR)), 8) AS BIGINT)
          / 4294967296.0::DOUBLE < 0.9::DOUBLE THEN 'train' ELSE 'val' END AS split FROM documents)
        SELECT *, count(*) OVER (PARTITION BY split) AS reported FROM s""",
    "load_splits": f"""WITH {PREPARED}
        SELECT doc_id, CASE split WHEN 'val' THEN 'validation' ELSE split END AS split,
               'user' AS first_role, question, 'assistant' AS second_role, answer FROM prepared""",
    "eval_prompt_file": """SELECT row_number() OVER (ORDER BY conv_id, turn) AS sample_id, text,
        CAST(conv_id AS VARCHAR) AS conv FROM conversations WHERE role = 'user'""",
    "scan_pairs": f"""WITH {DOC_PAIRS}
        SELECT doc_id, coalesce(Context, '') AS Context, coalesce(Response, '') AS Response FROM doc_pairs""",
    "source_profile": "SELECT count(*) AS num_rows, 'doc_id,text,lang,source,n_chars' AS columns FROM documents",
    "turn_messages": f"WITH {messages('conversations')} SELECT conv_id, msg_idx, role, content FROM msgs",
    "turn_pairs": """WITH gapped AS (
          SELECT conv_id, turn * (CASE WHEN conv_id % 2 = 0 THEN 10 ELSE 700 END) + conv_id % 3 AS turn, role, text FROM conversations),
        t AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM gapped WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        SELECT conv_id, turn, text AS Context, next_text AS Response FROM t
        WHERE role = 'user' AND next_role = 'assistant'""",
    "turn_pairs_sparse": f"""WITH {SPARSE_TURNS}, t AS (
          SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
          FROM sparse WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
        SELECT conv_id, turn, text AS Context, next_text AS Response FROM t
        WHERE role = 'user' AND next_role = 'assistant'""",
    "turn_messages_sparse": f"""WITH {SPARSE_TURNS}
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS msg_idx, role, text AS content
        FROM sparse""",
    "keyed_rows": "SELECT row_number() OVER (PARTITION BY text) - 1 AS copy, text FROM documents",
    "clean_text": f"WITH {DIRTY_TURNS} SELECT conv_id, turn, {clean('text')} AS text FROM dirty_turns",
    "filter_valid": f"WITH {DOC_PAIRS} SELECT doc_id, Context, Response FROM doc_pairs WHERE {VALID}",
    "skip_counts": f"""WITH {DOC_PAIRS} SELECT count(*) FILTER (WHERE {VALID}) AS kept,
        count(*) FILTER (WHERE NOT {VALID}) AS skipped FROM doc_pairs""",
    "pairs_to_messages": f"""WITH {DIRTY_TURNS}
        SELECT u.conv_id, u.turn, 'user' AS first_role, {clean('u.text')} AS question,
               'assistant' AS second_role, {clean('a.text')} AS answer
        FROM dirty_turns u JOIN dirty_turns a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        WHERE u.role = 'user' AND a.role = 'assistant'""",
    "messages_concat": f"""WITH {messages('conversations')}
        SELECT conv_id, {rendered('content', "' '")} FROM msgs GROUP BY ALL""",
    "render_plain": f"""WITH {messages('conversations')}
        SELECT conv_id, {rendered(capital('role') + " || ': ' || content", 'chr(10)')} FROM msgs GROUP BY ALL""",
    "render_tagged": f"""WITH {messages('conversations')}
        SELECT conv_id, {rendered(TAGGED, "''")},
               string_agg({TAGGED}, '' ORDER BY turn) || '<|im_start|>assistant' || chr(10) AS prompt
        FROM msgs GROUP BY ALL""",
    "filter_long": rf"""WITH {DOC_PAIRS}, s AS (
          SELECT doc_id, {clean('Context')} AS question, {clean('Response')} AS answer FROM doc_pairs)
        SELECT doc_id, 'user' AS first_role, question, 'assistant' AS second_role, answer FROM s
        WHERE len(regexp_extract_all(question || ' ' || answer, '\S+')) <= 512""",
    "filter_long_counted": rf"""WITH {DOC_PAIRS}, s AS (
          SELECT doc_id, {clean('Context')} AS question, {clean('Response')} AS answer FROM doc_pairs)
        SELECT doc_id, 'user' AS first_role, question, 'assistant' AS second_role, answer FROM s
        WHERE len(regexp_extract_all(question || ' ' || answer, '[A-Za-z]+|[0-9]')) + 2 <= 300""",
    "validate_messages": f"""WITH mixed AS (
          SELECT conv_id, turn, CASE WHEN conv_id % 5 = 0 AND turn = 1 THEN 'bot' ELSE role END AS role, text FROM conversations
          UNION ALL SELECT -1 - conv_id, turn, role, text FROM conversations WHERE turn = 0), {messages('mixed')}
        SELECT conv_id, count(*) >= 2 AND bool_and(role IN ('user', 'assistant', 'system')) AS valid
        FROM msgs GROUP BY ALL""",
    "validate_messages_json": f"""WITH {RAW}, parsed AS (
          SELECT conv_id, turn, CASE WHEN json_valid(value) THEN value ELSE '{{}}' END AS value FROM raw), items AS (
          SELECT conv_id, turn,
                 CASE WHEN json_type(value, '$.messages') = 'ARRAY' THEN json_extract(value, '$.messages[*]') ELSE [] END AS items
          FROM parsed), checked AS (
          SELECT conv_id, turn, json_type(e) = 'OBJECT' AND json_exists(e, '$.content') AND json_type(e, '$.role') = 'VARCHAR'
                 AND json_extract_string(e, '$.role') IN ('user', 'assistant', 'system') AS ok
          FROM (SELECT conv_id, turn, unnest(items) AS e FROM items))
        SELECT r.conv_id, r.turn, coalesce(c.n >= 2 AND c.n_ok = c.n, false) AS valid
        FROM raw r LEFT JOIN (SELECT conv_id, turn, count(*) AS n, count(*) FILTER (WHERE coalesce(ok, false)) AS n_ok
                              FROM checked GROUP BY conv_id, turn) c
          ON c.conv_id = r.conv_id AND c.turn = r.turn""",
    "schema_issues": f"{SAMPLE_ISSUES} SELECT * FROM issues",
    "schema_issues_json": f"""WITH {RAW}, parsed AS (
          SELECT conv_id || '-' || turn AS key, CASE WHEN json_valid(value) THEN value END AS value FROM raw), samples AS (
          SELECT key, value IS NOT NULL AND coalesce(json_exists(value, '$.messages'), false) AS present,
                 CASE WHEN json_type(value, '$.messages') = 'ARRAY' THEN json_extract(value, '$.messages[*]') ELSE [] END AS items
          FROM parsed), messages AS (
          SELECT key, items, unnest([0, 1]) AS i FROM samples WHERE present AND len(items) = 2)
        SELECT key AS sample_id, CAST(NULL AS BIGINT) AS msg_idx, 'missing_messages' AS rule,
               'Sample ' || key || ': Missing ''messages'' key' AS detail FROM samples WHERE NOT present
        UNION ALL SELECT key, NULL, 'message_count', 'Sample ' || key || ': Expected 2 messages, got ' || len(items)
        FROM samples WHERE present AND len(items) <> 2
        UNION ALL SELECT key, NULL, 'first_role', 'Sample ' || key || ': First message should have role ''user'''
        FROM messages WHERE i = 0 AND json_extract_string(items[1], '$.role') IS DISTINCT FROM 'user'
        UNION ALL SELECT key, NULL, 'second_role', 'Sample ' || key || ': Second message should have role ''assistant'''
        FROM messages WHERE i = 1 AND json_extract_string(items[2], '$.role') IS DISTINCT FROM 'assistant'
        UNION ALL SELECT key, i, 'missing_content', 'Sample ' || key || ', message ' || i || ': Missing ''content'' key'
        FROM messages WHERE NOT coalesce(json_exists(items[i + 1], '$.content'), false)""",
    "schema_report": f"""{SAMPLE_ISSUES} SELECT *, (SELECT count(*) FROM issues) AS n_issues,
          greatest((SELECT count(*) FROM issues) - 10, 0) AS n_more
        FROM issues ORDER BY sample_id, msg_idx NULLS FIRST, rule LIMIT 10""",
    "content_rules": f"""WITH {DOC_PAIRS}
        SELECT 'turns' AS source, conv_id AS id,
               bool_or(role = 'user') AND bool_or(role = 'assistant') AND bool_and(coalesce(length(text) > 0, false)) AS ok
        FROM conversations GROUP BY conv_id
        UNION ALL SELECT 'docs', doc_id, {clean('Context')} <> '' AND {clean('Response')} <> '' FROM doc_pairs""",
    "redact_email": f"WITH {DIRTY_TURNS} SELECT conv_id, turn, {redact('text', EMAIL)} AS text FROM dirty_turns",
    "redact_phone": f"WITH {DIRTY_TURNS} SELECT conv_id, turn, {redact('text', PHONE)} AS text FROM dirty_turns",
    "redact_ssn": f"WITH {DIRTY_TURNS} SELECT conv_id, turn, {redact('text', SSN)} AS text FROM dirty_turns",
    "redact_all": f"SELECT doc_id, {redact('text')} AS text FROM documents",
    "redact_messages": f"""WITH {DIRTY_TURNS}, {messages('dirty_turns')}
        SELECT conv_id, msg_idx, role, {redact('content')} AS content FROM msgs""",
    "dataset_stats": f"""WITH {messages('conversations')}, per AS (SELECT conv_id, count(*) AS m FROM msgs GROUP BY conv_id), s AS (
          SELECT count(*) AS num_samples, CAST(2 AS BIGINT) AS num_features, 'conv_id,messages' AS features,
                 avg(m) AS avg_messages_per_sample, min(m) AS min_messages, max(m) AS max_messages FROM per), c AS (
          SELECT avg(length(content)) AS avg_content_length, CAST(min(length(content)) AS BIGINT) AS min_content_length,
                 CAST(max(length(content)) AS BIGINT) AS max_content_length FROM msgs)
        SELECT {STATS} FROM s, c""",
    "split_stats": f"""WITH {PREPARED}, s AS (
          SELECT split, count(*) AS num_samples, CAST(2 AS BIGINT) AS num_features, 'doc_id,messages' AS features,
                 2.0::DOUBLE AS avg_messages_per_sample, CAST(2 AS BIGINT) AS min_messages, CAST(2 AS BIGINT) AS max_messages,
                 sum(length(question) + length(answer)) / (2.0::DOUBLE * count(*)) AS avg_content_length,
                 CAST(min(least(length(question), length(answer))) AS BIGINT) AS min_content_length,
                 CAST(max(greatest(length(question), length(answer))) AS BIGINT) AS max_content_length
          FROM prepared GROUP BY split)
        SELECT split, {STATS} FROM s""",
    "split_counts": f"WITH {PREPARED} SELECT split, count(*) AS num_samples FROM prepared GROUP BY split",
    "seeded_order": """SELECT row_number() OVER (ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id) AS position, doc_id
        FROM documents""",
    "split_hash": """SELECT doc_id, CASE WHEN CAST('0x' || left(md5('7:' || CAST(doc_id AS VARCHAR)), 8) AS BIGINT) / 4294967296.0::DOUBLE
          < 0.9::DOUBLE THEN 'train' ELSE 'val' END AS split FROM documents""",
    "pii_counts": f"""WITH {DIRTY_TURNS}, texts AS (
          SELECT text || ' 5551234567@x.com and 5551234567.b@y.org 123-45-6789@z.org' AS text FROM dirty_turns), replaced AS (
          SELECT text, {redact('text', EMAIL)} AS no_mail, {redact('text', EMAIL, PHONE)} AS no_phone FROM texts), hits AS (
          SELECT k.kind, len(CASE k.kind WHEN 'email' THEN regexp_extract_all(text, '{EMAIL}')
            WHEN 'phone' THEN regexp_extract_all(no_mail, '{PHONE}') ELSE regexp_extract_all(no_phone, '{SSN}') END) AS n
          FROM replaced, (VALUES ('email'), ('phone'), ('ssn')) k(kind))
        SELECT kind, sum(n)::BIGINT AS n_hits, count(*) FILTER (n > 0) AS n_rows FROM hits GROUP BY kind""",
    "skip_reasons": f"""WITH {DOC_PAIRS}, faults AS (
          SELECT CASE WHEN coalesce(Context, '') = '' THEN 'context missing' WHEN trim(Context, {WS}) = '' THEN 'context blank'
            WHEN length(Context) < 10 THEN 'context too short' WHEN length(Context) > 8000 THEN 'context too long'
            WHEN coalesce(Response, '') = '' THEN 'response missing' WHEN trim(Response, {WS}) = '' THEN 'response blank'
            WHEN length(Response) < 10 THEN 'response too short' WHEN length(Response) > 8000 THEN 'response too long' END AS reason
          FROM doc_pairs)
        SELECT reason, count(*) AS n FROM faults WHERE reason IS NOT NULL GROUP BY reason""",
    "stored_fields": """SELECT doc_id, text, CASE WHEN doc_id % 10 <> 0 THEN source END AS source,
          CASE WHEN doc_id % 10 = 0 THEN lang END AS lang, CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split
        FROM documents""",
    "prepare_job": f"""WITH {PREPARED}
        SELECT split, count(*) OVER (PARTITION BY split) AS reported, 'user' AS first_role, question,
               'assistant' AS second_role, answer FROM prepared""",
    "split_exact": """WITH r AS (SELECT doc_id, text, count(*) OVER () AS n,
            row_number() OVER (ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id) AS pos FROM documents)
        SELECT doc_id, text, CASE WHEN pos <= trunc(n * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM r""",
    "preview": f"""WITH {PREPARED}, first AS (SELECT * FROM prepared WHERE split = 'train' ORDER BY pos LIMIT 5), m AS (
          SELECT pos AS sample_no, doc_id, CAST(0 AS BIGINT) AS msg_idx, 'USER' AS role, question AS content FROM first
          UNION ALL SELECT pos, doc_id, 1, 'ASSISTANT', answer FROM first)
        SELECT sample_no, doc_id, msg_idx, role,
               CASE WHEN length(content) > 200 THEN left(content, 200) || '...' ELSE content END AS content FROM m""",
    "smoke_sample": """SELECT doc_id, text FROM documents
        ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 5""",
    "prepare_splits": f"""WITH {PREPARED}
        SELECT doc_id, split, 'user' AS first_role, question, 'assistant' AS second_role, answer FROM prepared""",
    "curate_chat": rf"""WITH {DIRTY_TURNS}, {messages('dirty_turns')}, r AS (
          SELECT conv_id, turn, role, {redact('content')} AS content FROM msgs), s AS (
          SELECT conv_id, {rendered(capital('role') + " || ': ' || content", 'chr(10)')},
                 string_agg(content, ' ' ORDER BY turn) AS joined, count(*) AS n,
                 bool_and(role IN ('user', 'assistant', 'system')) AS roles_ok
          FROM r GROUP BY conv_id)
        SELECT conv_id, text FROM s
        WHERE n >= 2 AND roles_ok AND len(regexp_extract_all(joined, '\S+')) <= 512""",
    "eval_prompts": f"WITH {EVAL_TURNS} SELECT sample_id, model_prompt, prompt_error AS error FROM prompts",
    "eval_results": f"WITH {EVAL_TURNS} SELECT * FROM results",
    "eval_preview": f"""WITH {EVAL_TURNS} SELECT sample_id, left(prompt, 100) || '...' AS prompt,
          left(response, 150) || '...' AS response FROM results WHERE error IS NULL""",
    "eval_summary": f"WITH {EVAL_TURNS} SELECT count(*) AS total, count(error) AS errors FROM results",
    "eval_by_category": f"WITH {EVAL_TURNS} SELECT category, count(*) AS n FROM results WHERE error IS NULL GROUP BY category",
    "first_responses": f"""WITH {EVAL_TURNS} SELECT sample_id, prompt, response FROM (
          SELECT * FROM results ORDER BY sample_id LIMIT 3) WHERE error IS NULL""",
}
