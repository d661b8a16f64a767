"""Check queries for the mail jobs: the expected result straight from documents."""

ADDRESS = "'user' || CAST(doc_id AS VARCHAR) || '@example.com'"
SENDER = f"CASE WHEN lang = 'de' THEN {ADDRESS} ELSE 'Some One <' || {ADDRESS} || '>' END"
SUBJECT = """CASE WHEN doc_id % 9 <> 0 THEN 'Subject ' || source
                  WHEN lang = 'fr' THEN 'An earlier subject' ELSE '' END"""
MESSAGE_ID = "'<m' || CAST(doc_id AS VARCHAR) || '@example.com>'"

NORMAL = f"""
    normal AS (
      SELECT 'msg_' || CAST(doc_id AS VARCHAR) AS gmail_message_id,
             'thread_' || CAST(doc_id AS VARCHAR) AS gmail_thread_id, {SENDER} AS from_address,
             CASE WHEN lang = 'en' THEN 'shop@example.com' END AS to_address,
             {SUBJECT} AS subject, substring(text, 1, 40) AS snippet,
             CASE WHEN lang = 'es' THEN '' ELSE text END AS body_text,
             {MESSAGE_ID} AS message_id_header, {ADDRESS} AS address
      FROM documents)"""

HITS = """
    questions AS (
      SELECT e.id, v.embedding, e.subject, e.body_text FROM emails e
      JOIN email_embeddings v ON v.email_id = e.id
      WHERE e.status = 'new' ORDER BY e.id DESC LIMIT 5),
    hits AS (
      SELECT q.id AS question_id, e.id AS email_id, e.subject, e.body_text,
             list_cosine_similarity(CAST(v.embedding AS DOUBLE[]),
                                    CAST(q.embedding AS DOUBLE[])) AS similarity,
             row_number() OVER (PARTITION BY q.id ORDER BY
               list_distance(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), e.id)
               AS rank
      FROM questions q, email_embeddings v JOIN emails e ON e.id = v.email_id),
    contexts AS (
      SELECT question_id, string_agg(
               '[#' || rank || ' sim=' || printf('%.3f', similarity) || '] subject: '
               || coalesce(nullif(subject, ''), '(no subject)') || chr(10)
               || substring(coalesce(body_text, ''), 1, 1500),
               chr(10) || chr(10) ORDER BY rank) AS context
      FROM hits WHERE rank <= 5 GROUP BY question_id)"""

SQL = {
    "similarity_search_many": """
        SELECT question_id, rank, email_id, round(similarity + 1e-9 * sign(similarity), 6) AS similarity FROM (
          SELECT q.id AS question_id, e.id AS email_id,
                 list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(w.embedding AS DOUBLE[])) AS similarity,
                 CAST(row_number() OVER (PARTITION BY q.id ORDER BY
                   list_distance(CAST(v.embedding AS DOUBLE[]), CAST(w.embedding AS DOUBLE[])), e.id) AS INTEGER) AS rank
          FROM emails q JOIN email_embeddings w ON w.email_id = q.id,
               email_embeddings v JOIN emails e ON e.id = v.email_id
          WHERE q.id % 100 = 0) WHERE rank <= 5""",
    "similarity_search_ann_recall": """
        SELECT count(*) FILTER (e.id % 100 = 0) AS questions,
               count(*) FILTER (e.id % 100 = 0) * least(5, count(*)) AS neighbours, TRUE AS recall_reached
        FROM email_embeddings v JOIN emails e ON e.id = v.email_id""",
    "select_unread_batch": """
        SELECT 'msg_' || CAST(doc_id AS VARCHAR) AS gmail_message_id,
               'thread_' || CAST(doc_id AS VARCHAR) AS gmail_thread_id
        FROM documents WHERE doc_id % 3 = 0 AND source NOT IN ('src5', 'src3', 'src7')
        ORDER BY doc_id DESC LIMIT 5""",
    "normalize_messages": f"WITH {NORMAL} SELECT * EXCLUDE (address) FROM normal",
    "reply_address": f"""
        WITH {NORMAL} SELECT gmail_message_id, address AS reply_address FROM normal""",
    "compose_reply": f"""
        WITH {NORMAL}, r AS (
          SELECT gmail_message_id, address AS to_address, message_id_header, body_text,
                 'Re: ' || CASE WHEN subject = '' THEN 'Your question' ELSE subject END AS subject
          FROM normal)
        SELECT gmail_message_id, to_address, subject,
               rtrim(translate(base64(encode(
                 'To: ' || to_address || chr(13) || chr(10) || 'Subject: ' || subject
                 || chr(13) || chr(10) || 'In-Reply-To: ' || message_id_header
                 || chr(13) || chr(10) || 'References: ' || message_id_header
                 || chr(13) || chr(10) || 'Content-Type: text/plain; charset=utf-8'
                 || chr(13) || chr(10) || chr(13) || chr(10) || body_text)), '+/', '-_'), '=') AS raw
        FROM r""",
    "similarity_search": f"""
        WITH {HITS} SELECT question_id, CAST(rank AS INTEGER) AS rank, email_id,
               round(similarity + 1e-9 * sign(similarity), 6) AS similarity
        FROM hits WHERE rank <= 5""",
    "build_context": f"WITH {HITS} SELECT question_id, context FROM contexts",
    "build_prompt": f"""
        WITH {HITS}
        SELECT question_id, 'You are an expert marketing analyst.' || chr(10) || chr(10)
               || 'Context (may be incomplete):' || chr(10) || context || chr(10) || chr(10)
               || 'Task: Answer the user''s question using only the provided context. If the context'
               || ' is insufficient, say what is missing and ask up to 1 clarifying question.'
               || ' Be concise.' || chr(10) || chr(10) || 'Question: '
               || coalesce(nullif(q.body_text, ''), nullif(q.subject, ''), '') AS prompt
        FROM contexts JOIN questions q ON q.id = question_id""",
    "reply_usage_stats": """
        SELECT 'model' AS kind, model AS name, count(*) AS items,
               CAST(sum(tokens_prompt) AS BIGINT) AS prompt_tokens,
               CAST(sum(tokens_completion) AS BIGINT) AS completion_tokens
        FROM email_replies GROUP BY model
        UNION ALL SELECT 'status', status, count(*), NULL, NULL FROM emails GROUP BY status""",
}
