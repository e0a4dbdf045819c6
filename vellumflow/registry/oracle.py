"""Reference SQL of each named query, for an independent engine."""

from __future__ import annotations

from string import Formatter

from vellumflow import vocabulary as V

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
SITE = "https://example.test/site"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def filled(template: str, **exprs: str) -> str:
    """A fixed text with SQL expressions in its places."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(text(literal))
        if name is not None:
            parts.append(f"CAST({exprs[name]} AS VARCHAR)")
    return f"concat({', '.join(parts)})"


K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"

def lead(column: str) -> str:
    """The first three sentences of a text column, empty without a sentence end."""
    return rf"regexp_extract({column}, '^(?:[^.!?]*[.!?]+){{1,3}}', 0)"


SHORT = f"trim(CASE WHEN {lead('text')} = '' THEN text ELSE {lead('text')} END)"

# Tables derived from the raw ones, in order of dependency.
VIEWS = {
    "job_events": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CONCAT(CASE a WHEN 1 THEN 'ExtractionJob' WHEN 2 THEN 'SummarizationJob' ELSE 'SharePointUpload' END,
              CASE event_type WHEN 'purchase' THEN 'Completed' WHEN 'error' THEN 'Failed' ELSE 'Started' END) AS event_type,
       (user_id * 100 + day(ts)) * 10 + a AS run_id,
       CASE a WHEN 1 THEN 'extraction_agent' WHEN 2 THEN 'summarization_agent' ELSE 'sharepoint_agent' END AS agent,
       CASE a WHEN 1 THEN 'EXTRACTION_SP' WHEN 2 THEN 'SUMMARIZATION_SP' ELSE 'SHAREPOINT_SP' END AS sp_used,
       CAST(user_id AS VARCHAR) AS triggered_by, ts AS timestamp,
       CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END AS status,
       props AS details
FROM (SELECT *, {K} % 3 + 1 AS a FROM events) e""",
    "linked_events": """
SELECT event_id, event_type, CASE WHEN agent = 'sharepoint_agent' THEN 0 ELSE run_id END AS run_id,
       agent, sp_used, triggered_by, timestamp, status,
       CASE agent
         WHEN 'extraction_agent' THEN concat('{"document_path":"/source_pdfs/patient_', run_id // 10, '.pdf"}')
         WHEN 'summarization_agent' THEN concat('{"extraction_run_id":', run_id - 1, '}')
         ELSE concat('{"summarization_run_id":', run_id - 1, '}') END AS details
FROM job_events""",
    "conversation_state": f"""
SELECT CAST(wf AS VARCHAR) AS state_id, CAST(user_id AS VARCHAR) AS user_id,
       CONCAT('/source_pdfs/patient_', CAST(wf AS VARCHAR), '.pdf') AS document_path,
       wf * 10 + 1 AS extraction_run_id,
       CASE WHEN last_a >= 2 THEN wf * 10 + 2 END AS summarization_run_id,
       CASE last_a WHEN 1 THEN 'extracting' WHEN 2 THEN 'summarizing' ELSE 'completed' END AS current_stage,
       triggered_at,
       CASE WHEN last_a = 3 THEN 'completed' ELSE 'in_progress' END AS status
FROM (SELECT user_id * 100 + day(ts) AS wf, user_id, MIN(ts) AS triggered_at, MAX({K} % 3 + 1) AS last_a
      FROM events GROUP BY user_id * 100 + day(ts), user_id) w""",
    "extracted_documents": """
SELECT CONCAT('extract_', CAST(doc_id AS VARCHAR)) AS extraction_id,
       ((doc_id % 150) * 100 + doc_id % 30 + 1) * 10 + 1 AS extraction_run_id,
       CONCAT('/source_pdfs/patient_', CAST(doc_id AS VARCHAR), '.pdf') AS document_path,
       text AS extracted_text,
       CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS INT) AS page_count,
       TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL '1' MINUTE AS extracted_at,
       'EXTRACTION_SP' AS extracted_by
FROM documents""",
    "summaries": f"""
SELECT CONCAT('summary_', CAST(doc_id AS VARCHAR)) AS summary_id,
       ((doc_id % 150) * 100 + doc_id % 30 + 1) * 10 + 2 AS summarization_run_id,
       ((doc_id % 150) * 100 + doc_id % 30 + 1) * 10 + 1 AS extraction_run_id,
       {SHORT} AS summary_text,
       CONCAT('{{"original_length": ', CAST(length(text) AS VARCHAR), ', "summary_length": ',
              CAST(length({SHORT}) AS VARCHAR), '}}') AS document_metadata,
       TIMESTAMP '2024-01-01 00:10:00' + doc_id * INTERVAL '1' MINUTE AS summarized_at,
       'SUMMARIZATION_SP' AS summarized_by
FROM documents""",
    "messages": """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, ts,
       CASE event_type
         WHEN 'signup'   THEN CONCAT('Extract /source_pdfs/patient_', CAST(user_id AS VARCHAR), '.pdf please')
         WHEN 'view'     THEN 'What''s the STATUS of my workflow?'
         WHEN 'click'    THEN 'Tell me about treatment protocols'
         WHEN 'purchase' THEN CONCAT('Extract /Volumes/c/s/source_pdfs/patient_', CAST(user_id AS VARCHAR), '.txt')
         ELSE 'Please refresh the data' END AS content
FROM events""",
    "job_status": """
SELECT CAST(run_id AS VARCHAR) AS run_id, triggered_by AS user_id,
       CASE WHEN run_id % 2 = 0 THEN CONCAT('conv_', triggered_by) END AS conversation_id,
       CASE agent WHEN 'extraction_agent' THEN 'extraction' WHEN 'summarization_agent' THEN 'summarization' ELSE 'sharepoint' END AS job_type,
       agent, status, sp_used, created_at, timestamp AS updated_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id ORDER BY timestamp DESC, event_id DESC) AS rn,
             MIN(timestamp) OVER (PARTITION BY run_id) AS created_at
      FROM job_events) j
WHERE rn = 1 AND timestamp >= TIMESTAMP '2024-01-16 00:00:00'""",
    "checkpoints": """
SELECT CAST(user_id AS VARCHAR) AS thread_id, '' AS checkpoint_ns,
       CONCAT('{"ts": "', CAST(ts AS VARCHAR), '", "k": ', regexp_extract(props, '[0-9]+', 0), '}') AS checkpoint
FROM events""",
    "agent_usage": f"""
SELECT CAST(event_id AS VARCHAR) AS invocation_id,
       CASE {K} % 3 WHEN 0 THEN 'extraction_agent' WHEN 1 THEN 'summarization_agent' ELSE 'sharepoint_agent' END AS agent_id,
       CAST(user_id AS VARCHAR) AS user_id, ts AS timestamp,
       {K} * 10 AS input_tokens, {K} * 3 AS output_tokens,
       CAST(value / 100 AS DECIMAL(10,4)) AS cost,
       CAST(floor(value * 10) AS INT) AS latency_ms,
       event_type <> 'error' AS success
FROM events""",
    "prompts": """
SELECT CONCAT('prompt_', CAST(user_id % 20 AS VARCHAR)) AS prompt_id,
       CAST(event_id AS INT) AS version, CONCAT('prompt body ', CAST(event_id AS VARCHAR)) AS content,
       CAST(user_id AS VARCHAR) AS approved_by, ts AS approved_at, event_type = 'purchase' AS active
FROM events""",
    "knowledge": """
SELECT e.vec_id, CONCAT('doc ', CAST(d.doc_id AS VARCHAR)) AS title, d.text AS content, d.source AS source, e.embedding
FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id""",
    "products": """
SELECT e.vec_id, p_name AS product_name, p_type AS category, p_retailprice AS price, e.embedding
FROM embeddings e JOIN part ON e.vec_id = p_partkey""",
}

NEEDS = {
    "linked_events": ["job_events"],
    "job_status": ["job_events"],
}


def with_views(names: str, body: str) -> str:
    """Prefix ``body`` with the derived tables it reads; ``body`` may start
    with further named subqueries after a leading comma."""
    wanted: list[str] = []
    for name in names.split():
        for n in [*NEEDS.get(name, []), name]:
            if n not in wanted:
                wanted.append(n)
    ordered = [n for n in VIEWS if n in wanted]
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered) + body


def newest(source: str, keys: str, by: str, tie: str, where: str = "TRUE") -> str:
    return (
        f"(SELECT * FROM {source} WHERE {where} "
        f"QUALIFY ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {by} DESC NULLS LAST, {tie} DESC) = 1)"
    )


def last_event(agent: V.Agent, source: str = "job_events") -> str:
    return newest(source, "run_id", "timestamp", "event_id", f"agent = '{agent.name}' AND run_id <> 0")


def status_case(event_type: str, agent: V.Agent) -> str:
    return (
        f"CASE WHEN {event_type} IS NULL THEN 'NOT_FOUND' WHEN {event_type} = '{agent.completed}' THEN 'COMPLETED' "
        f"WHEN {event_type} = '{agent.failed}' THEN 'FAILED' ELSE 'RUNNING' END"
    )


def elapsed(ts: str) -> str:
    return f"CAST((epoch_us({AS_OF}) - epoch_us({ts})) // 60000000 AS INT)"


def uuid_of(*parts: str) -> str:
    sized = ", ".join(f"concat(length(CAST({p} AS VARCHAR)), ':', CAST({p} AS VARCHAR))" for p in parts)
    return f"regexp_replace(md5(concat({sized})), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


def half_up(a: str, b: str) -> str:
    """Two-place quotient of integers, exact halves up."""
    return f"CASE WHEN {b} <> 0 THEN ((200 * {a} + {b}) // (2 * {b})) / 100.0 END"


def run_status_sql(agent: V.Agent, requested: str) -> str:
    e, s = elapsed("l.timestamp"), status_case("l.event_type", agent)
    return f"""
, r AS (SELECT q.run_id, {s} AS status, l.details, CASE WHEN {s} = 'RUNNING' THEN {e} END AS elapsed_min
        FROM ({requested}) q LEFT JOIN {last_event(agent)} l ON q.run_id = l.run_id)
, p AS (SELECT *, CASE WHEN status = 'RUNNING' THEN greatest(1, {agent.budget_minutes} - elapsed_min) END AS eta_min FROM r)
"""


def events_select(
    source: str, kind: str, agent: V.Agent, run: str, status: str, details: str, triggered_by: str = "triggered_by"
) -> str:
    return f"""
SELECT {uuid_of('run', 'kind', AS_OF, 'triggered_by', 'details')} AS event_id, kind AS event_type, run AS run_id,
       '{agent.name}' AS agent, '{agent.principal}' AS sp_used, triggered_by, {AS_OF} AS timestamp, status, details
FROM (SELECT {kind} AS kind, CAST({run} AS BIGINT) AS run, {status} AS status,
             {triggered_by} AS triggered_by, {details} AS details FROM {source}) z"""


def pending(hours: int) -> str:
    return newest(
        "conversation_state", "user_id", "triggered_at", "state_id",
        f"status = 'in_progress' AND triggered_at > {AS_OF} - INTERVAL '{hours}' HOUR",
    )


def steps(source: str) -> str:
    """Run status and action of each workflow row of ``source``."""
    return f"""
, j AS (SELECT w.*, CASE current_stage WHEN 'extracting' THEN {status_case('e.event_type', V.EXTRACTION)}
                                       WHEN 'summarizing' THEN {status_case('s.event_type', V.SUMMARIZATION)} END AS run_status,
               CASE current_stage WHEN 'extracting' THEN e.timestamp WHEN 'summarizing' THEN s.timestamp END AS event_at
        FROM {source} w
        LEFT JOIN {last_event(V.EXTRACTION)} e ON w.extraction_run_id = e.run_id
        LEFT JOIN {last_event(V.SUMMARIZATION)} s ON w.summarization_run_id = s.run_id)
, d AS (SELECT *, CASE
          WHEN current_stage = 'extracting' AND run_status = 'COMPLETED' THEN 'start_summarization'
          WHEN current_stage = 'summarizing' AND run_status = 'COMPLETED' THEN 'upload'
          WHEN current_stage IN ('extracting', 'summarizing') AND run_status = 'FAILED' THEN 'clear'
          WHEN current_stage IN ('extracting', 'summarizing') THEN 'wait'
          WHEN current_stage = 'completed' THEN 'clear' ELSE 'unknown_state' END AS action
        FROM j)
"""


STATE = "state_id, user_id, document_path, extraction_run_id, summarization_run_id, current_stage, triggered_at, status"
DOC_RUNS = "SELECT DISTINCT extraction_run_id AS run_id FROM extracted_documents"
SUMMARY_RUNS = "SELECT DISTINCT summarization_run_id AS run_id FROM summaries"
STATE_RUNS = "SELECT extraction_run_id AS run_id FROM conversation_state"

COLD = newest("job_events", "run_id", "timestamp", "event_id")
LAST_SUMMARY = newest("summaries", "summarization_run_id", "summarized_at", "summary_id")
LAST_EXTRACTION = newest("extracted_documents", "extraction_run_id", "extracted_at", "extraction_id")

MANIFEST = f"""
, m AS (SELECT r.run_id AS summarization_run_id, r.triggered_by,
               r.event_type = 'SummarizationJobCompleted' AS done,
               coalesce(length(s.summary_text), 0) > 0 AS has_text
        FROM {last_event(V.SUMMARIZATION)} r LEFT JOIN {LAST_SUMMARY} s ON r.run_id = s.summarization_run_id)
, manifest AS (SELECT summarization_run_id, triggered_by,
       CASE WHEN done AND has_text THEN concat('{SITE}/Documents/summary_', summarization_run_id, '.pdf') END AS url,
       CASE WHEN done AND has_text THEN 'SharePointUploadCompleted' WHEN done THEN 'SharePointUploadFailed' END AS event_type,
       CASE WHEN NOT done THEN {filled(V.MSG_NOT_COMPLETED, label="'Summarization'", run_id='summarization_run_id')}
            WHEN NOT has_text THEN {filled(V.MSG_NO_SUMMARY, run_id='summarization_run_id')} END AS reason
       FROM m)
"""

RENDERED = f"""
SELECT replace(summary_id, 'summary_', '') AS patient_id,
       concat('oncology_summary_', replace(summary_id, 'summary_', ''), '_20240131_000000.txt') AS file_name,
       concat(repeat('=', 80), chr(10), {text(V.SUMMARY_TITLE)}, replace(summary_id, 'summary_', ''), chr(10),
              repeat('=', 80), chr(10), 'Generated: 2024-01-31T00:00:00', chr(10),
              'Extraction Run ID: ', extraction_run_id, chr(10),
              'Summarization Run ID: ', summarization_run_id, chr(10), repeat('=', 80), chr(10), chr(10),
              summary_text) AS content
FROM summaries"""


METADATA = f"""
, m AS (SELECT s.summary_id, s.summarization_run_id, s.extraction_run_id, x.document_path, x.page_count,
               length(x.extracted_text) AS original_length, length(s.summary_text) AS summary_length
        FROM summaries s LEFT JOIN {LAST_EXTRACTION} x ON s.extraction_run_id = x.extraction_run_id)
"""

CENTROIDS = """
, parts AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
, means AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM parts GROUP BY label, pos)
, q AS (SELECT label AS query_id, list(x ORDER BY pos) AS v FROM means GROUP BY label)
"""


def topk(corpus: str, queries: str = CENTROIDS) -> str:
    return queries + f"""
, scored AS (SELECT q.query_id, c.*, list_cosine_similarity(q.v, CAST(c.embedding AS DOUBLE[])) AS sim FROM q, {corpus} c)
, ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, vec_id) AS rank FROM scored)
, hits AS (SELECT * FROM ranked WHERE rank <= 3)
"""


KNOWLEDGE_HITS = """
, shown AS (SELECT query_id, CAST(rank AS INT) AS rank, vec_id, round(sim, 6) AS score, title,
                   left(content, 200) AS preview, source FROM hits)
"""

PRICE = "format('{:,.2f}', p_retailprice)"


def contains_any(column: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), {text(w)})" for w in words) + ")"


INTENT = (
    "CASE "
    + " ".join(f"WHEN {contains_any('content', words)} THEN '{name}'" for name, words in V.INTENTS)
    + f" ELSE '{V.GENERAL_INTENT}' END"
)
SOURCE_PATH = r"nullif(regexp_extract(content, '/source_pdfs/[^\s]+\.pdf', 0), '')"
VOLUME_PATH = (
    "CASE WHEN contains(lower(content), 'extract') THEN "
    r"list_filter(regexp_split_to_array(content, '\s+'), lambda t: contains(t, '/Volumes/'))[1] END"
)
FIRST_PATH = f"coalesce({SOURCE_PATH}, {VOLUME_PATH})"


def job_message(agent: V.Agent, run: str) -> str:
    label = f"'{agent.label}'"
    e = elapsed("event_at")
    return (
        f"CASE run_status WHEN 'NOT_FOUND' THEN {filled(V.MSG_NOT_FOUND, job=text(agent.job), run_id=run)} "
        f"WHEN 'COMPLETED' THEN {filled(V.MSG_JOB_COMPLETED, label=label)} "
        f"WHEN 'FAILED' THEN {filled(V.MSG_JOB_FAILED, label=label)} "
        f"ELSE {filled(V.MSG_JOB_RUNNING, label=label, elapsed=e, eta=f'greatest(1, {agent.budget_minutes} - {e})')} END"
    )


ROUTED = (
    f", w AS {pending(168)}"
    + steps("w")
    + f"""
, a AS (SELECT user_id, action, extraction_run_id, summarization_run_id, current_stage,
               CASE WHEN current_stage = 'extracting' THEN {job_message(V.EXTRACTION, 'extraction_run_id')}
                    ELSE {job_message(V.SUMMARIZATION, 'summarization_run_id')} END AS message,
               CASE WHEN current_stage = 'extracting' THEN 'Extraction' ELSE 'Summarization' END AS label
        FROM d)
, b AS (SELECT user_id, action, CASE
          WHEN action = 'start_summarization' THEN {filled(V.MSG_TO_SUMMARY, message='message', run_id='extraction_run_id + 1', eta='10')}
          WHEN action = 'upload' THEN {filled(V.MSG_UPLOADED, url=f"concat('{SITE}/Documents/summary_', summarization_run_id, '.pdf')")}
          WHEN action = 'clear' AND current_stage = 'completed' THEN {text(V.MSG_PREVIOUS_DONE)}
          WHEN action = 'clear' THEN {filled(V.MSG_STAGE_FAILED, label='label', message='message')}
          WHEN action = 'wait' AND current_stage = 'extracting' THEN {filled(V.MSG_EXTRACTING, message='message')}
          WHEN action = 'wait' THEN {filled(V.MSG_SUMMARIZING, message='message')}
          ELSE {text(V.MSG_UNKNOWN_STATE)} END AS workflow_reply FROM a)
, routed AS (SELECT m.event_id, m.user_id,
       CASE WHEN b.user_id IS NOT NULL THEN 'workflow' ELSE {INTENT} END AS route, b.action, {SOURCE_PATH} AS path,
       CASE WHEN b.user_id IS NOT NULL THEN b.workflow_reply
            ELSE CASE {INTENT}
              WHEN 'extract_document' THEN
                CASE WHEN {SOURCE_PATH} IS NULL THEN {text(V.MSG_NO_PATH)}
                     ELSE {filled(V.MSG_STARTED, path=SOURCE_PATH, run_id='m.event_id * 10 + 1', eta='30', next_steps=text(V.MSG_NEXT_STEPS))} END
              WHEN 'check_status' THEN {text(V.MSG_NO_WORKFLOW)}
              WHEN 'search_knowledge' THEN {text(V.MSG_NO_KNOWLEDGE)}
              ELSE {text(V.MSG_GENERAL)} END END AS reply
       FROM messages m LEFT JOIN b ON m.user_id = b.user_id)
"""
)

def searched(messages: str, where: str) -> str:
    """The messages that have a vector, as queries."""
    return f", q AS (SELECT event_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM {messages} JOIN embeddings ON vec_id = event_id WHERE {where})"


# Message by message and user by user; a run that starts in the batch and has no event is running since now.
IN_ORDER = f"""
, r AS (SELECT query_id, string_agg({filled(V.KNOWLEDGE_HIT, title='title', preview='preview', source='source')},
                                    concat(chr(10), chr(10)) ORDER BY rank) AS results FROM shown GROUP BY query_id)
, w AS {pending(168)}
, asked AS (SELECT *, {INTENT} AS intent, {SOURCE_PATH} AS path, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM messages)
, origins AS (
    SELECT concat('u', user_id) AS key, current_stage, extraction_run_id AS e,
           CASE WHEN current_stage = 'extracting' THEN extraction_run_id + 1 ELSE summarization_run_id END AS s, false AS fresh FROM w
    UNION ALL
    SELECT concat('m', event_id), 'extracting', event_id * 10 + 1, event_id * 10 + 2, true FROM asked WHERE intent = 'extract_document' AND path IS NOT NULL)
, statuses AS (
    SELECT o.*, CASE WHEN x.run_id IS NULL AND fresh THEN 'RUNNING' ELSE {status_case('x.event_type', V.EXTRACTION)} END AS e_status,
           CASE WHEN x.run_id IS NULL AND fresh THEN {AS_OF} ELSE x.timestamp END AS e_at,
           CASE WHEN y.run_id IS NULL AND current_stage = 'extracting' THEN 'RUNNING' ELSE {status_case('y.event_type', V.SUMMARIZATION)} END AS s_status,
           CASE WHEN y.run_id IS NULL AND current_stage = 'extracting' THEN {AS_OF} ELSE y.timestamp END AS s_at
    FROM origins o LEFT JOIN {last_event(V.EXTRACTION)} x ON x.run_id = e LEFT JOIN {last_event(V.SUMMARIZATION)} y ON y.run_id = s)
, walk AS (
    SELECT a.user_id, 1::BIGINT AS n, (SELECT any_value(key) FROM statuses t WHERE t.key = concat('u', a.user_id)) AS key,
           (SELECT any_value(current_stage) FROM statuses t WHERE t.key = concat('u', a.user_id)) AS stage
    FROM asked a WHERE a.n = 1
    UNION ALL
    SELECT w.user_id, w.n + 1,
           CASE WHEN coalesce(content, '') = '' THEN w.key
                WHEN w.key IS NULL THEN CASE WHEN a.intent = 'extract_document' AND a.path IS NOT NULL THEN concat('m', a.event_id) END
                WHEN stage = 'completed' OR stage = 'extracting' AND t.e_status = 'FAILED' OR stage = 'summarizing' AND t.s_status = 'FAILED' THEN NULL
                ELSE w.key END,
           CASE WHEN coalesce(content, '') = '' THEN stage
                WHEN w.key IS NULL THEN 'extracting'
                WHEN stage = 'extracting' AND t.e_status = 'COMPLETED' THEN 'summarizing'
                WHEN stage = 'summarizing' AND t.s_status = 'COMPLETED' THEN 'completed'
                ELSE stage END
    FROM walk w JOIN asked a ON a.user_id = w.user_id AND a.n = w.n LEFT JOIN statuses t ON t.key = w.key)
, placed AS (
    SELECT a.*, w.key, w.stage AS current_stage, t.e AS extraction_run_id, t.s AS summarization_run_id,
           CASE w.stage WHEN 'extracting' THEN e_status WHEN 'summarizing' THEN s_status END AS run_status,
           CASE w.stage WHEN 'extracting' THEN e_at WHEN 'summarizing' THEN s_at END AS event_at
    FROM asked a JOIN walk w ON a.user_id = w.user_id AND a.n = w.n LEFT JOIN statuses t ON t.key = w.key)
, acted AS (
    SELECT *, CASE WHEN key IS NULL THEN NULL
        WHEN current_stage = 'extracting' AND run_status = 'COMPLETED' THEN 'start_summarization'
        WHEN current_stage = 'summarizing' AND run_status = 'COMPLETED' THEN 'upload'
        WHEN current_stage IN ('extracting', 'summarizing') AND run_status = 'FAILED' THEN 'clear'
        WHEN current_stage IN ('extracting', 'summarizing') THEN 'wait' WHEN current_stage = 'completed' THEN 'clear' ELSE 'unknown_state' END AS action,
      CASE WHEN current_stage = 'extracting' THEN {job_message(V.EXTRACTION, 'extraction_run_id')}
           ELSE {job_message(V.SUMMARIZATION, 'summarization_run_id')} END AS message,
      CASE WHEN current_stage = 'extracting' THEN 'Extraction' ELSE 'Summarization' END AS label
    FROM placed)
SELECT event_id, user_id, CASE WHEN key IS NOT NULL THEN 'workflow' ELSE intent END AS route, action, path,
       CASE WHEN key IS NULL THEN CASE intent
              WHEN 'extract_document' THEN CASE WHEN path IS NULL THEN {text(V.MSG_NO_PATH)}
                ELSE {filled(V.MSG_STARTED, path='path', run_id='event_id * 10 + 1', eta='30', next_steps=text(V.MSG_NEXT_STEPS))} END
              WHEN 'check_status' THEN {text(V.MSG_NO_WORKFLOW)}
              WHEN 'search_knowledge' THEN CASE WHEN results IS NULL THEN {text(V.MSG_NO_KNOWLEDGE)} ELSE {filled(V.KNOWLEDGE_REPLY, results='results')} END
              ELSE {text(V.MSG_GENERAL)} END
            WHEN action = 'start_summarization' THEN {filled(V.MSG_TO_SUMMARY, message='message', run_id='extraction_run_id + 1', eta='10')}
            WHEN action = 'upload' THEN {filled(V.MSG_UPLOADED, url=f"concat('{SITE}/Documents/summary_', summarization_run_id, '.pdf')")}
            WHEN action = 'clear' AND current_stage = 'completed' THEN {text(V.MSG_PREVIOUS_DONE)}
            WHEN action = 'clear' THEN {filled(V.MSG_STAGE_FAILED, label='label', message='message')}
            WHEN action = 'wait' AND current_stage = 'extracting' THEN {filled(V.MSG_EXTRACTING, message='message')}
            WHEN action = 'wait' THEN {filled(V.MSG_SUMMARIZING, message='message')}
            ELSE {text(V.MSG_UNKNOWN_STATE)} END AS reply
FROM acted LEFT JOIN r ON query_id = event_id"""


STAGE_RUNS = """
, s AS (SELECT run_id, agent, MIN(timestamp) AS started_at FROM {log}
        WHERE run_id <> 0 AND event_type LIKE '%Started' GROUP BY run_id, agent)
, runs AS (SELECT s.run_id, s.agent, s.started_at, MIN(e.timestamp) AS finished_at
        FROM s LEFT JOIN {log} e ON e.run_id = s.run_id AND e.agent = s.agent AND e.timestamp >= s.started_at
             AND (e.event_type LIKE '%Completed' OR e.event_type LIKE '%Failed')
        GROUP BY s.run_id, s.agent, s.started_at)
"""


def key_check(name: str, source: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, '{key}' AS key_column, CAST({key} AS VARCHAR) AS key, COUNT(*) AS n "
        f"FROM {source} GROUP BY {key} HAVING COUNT(*) > 1 OR {key} IS NULL"
    )


ORACLE: dict[str, str] = {}

ORACLE["read_documents"] = """
SELECT concat('doc_', doc_id, '.txt') AS file_name, text AS extracted_text FROM documents"""
ORACLE["list_summaries"] = with_views(
    "summaries", f", f AS ({RENDERED}) SELECT file_name, CAST(strlen(content) AS BIGINT) AS size FROM f"
)
ORACLE["get_summary"] = """
SELECT concat('doc_', c_custkey, '.txt') AS file_name,
       CASE WHEN doc_id IS NULL THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN doc_id IS NOT NULL THEN text END AS content
FROM customer LEFT JOIN documents ON c_custkey = doc_id"""
ORACLE["last_message"] = f"""
SELECT conv_id, role, CASE WHEN coalesce(text, '') = '' THEN {text(V.MSG_EMPTY)} ELSE text END AS content
FROM conversations QUALIFY ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC) = 1"""
ORACLE["hot_lookup"] = with_views(
    "job_status conversation_state",
    f" SELECT run_id, status, updated_at, sp_used FROM job_status WHERE run_id IN (SELECT CAST(run_id AS VARCHAR) FROM ({STATE_RUNS}) q)",
)
ORACLE["append_events"] = with_views(
    "conversation_state",
    events_select(
        "conversation_state", "'ExtractionJobStarted'", V.EXTRACTION, "extraction_run_id", "'RUNNING'",
        "CAST(json_object('document_path', document_path, 'sp_used', 'EXTRACTION_SP') AS VARCHAR)", "user_id",
    ),
)
ORACLE["store_workflow_state"] = with_views("messages", f"""
SELECT {uuid_of('user_id', 'event_id * 10 + 1', SOURCE_PATH)} AS state_id, user_id, {SOURCE_PATH} AS document_path,
       event_id * 10 + 1 AS extraction_run_id, CAST(NULL AS BIGINT) AS summarization_run_id,
       'extracting' AS current_stage, {AS_OF} AS triggered_at, 'in_progress' AS status
FROM messages WHERE {SOURCE_PATH} IS NOT NULL""")
ORACLE["update_workflow_stage"] = with_views("conversation_state", f"""
, c AS (SELECT user_id, CASE current_stage WHEN 'extracting' THEN 'summarizing' ELSE 'completed' END AS new_stage,
               CASE current_stage WHEN 'extracting' THEN extraction_run_id + 1 END AS new_run FROM {pending(744)})
SELECT state_id, s.user_id, document_path, extraction_run_id,
       CASE WHEN s.status = 'in_progress' THEN coalesce(new_run, summarization_run_id) ELSE summarization_run_id END AS summarization_run_id,
       CASE WHEN s.status = 'in_progress' THEN coalesce(new_stage, current_stage) ELSE current_stage END AS current_stage,
       triggered_at, status
FROM conversation_state s LEFT JOIN c ON s.user_id = c.user_id""")
ORACLE["clear_workflow_state"] = with_views(
    "conversation_state job_events",
    ", open_rows AS (SELECT * FROM conversation_state WHERE status = 'in_progress')" + steps("open_rows") + """
SELECT state_id, user_id, document_path, extraction_run_id, summarization_run_id, current_stage, triggered_at,
       CASE WHEN status = 'in_progress' AND user_id IN (SELECT user_id FROM d WHERE action = 'clear')
            THEN 'completed' ELSE status END AS status
FROM conversation_state""",
)
ORACLE["summary_files"] = with_views("summaries", RENDERED)
ORACLE["storage_replies"] = with_views("summaries", f""", f AS ({RENDERED})
SELECT file_name, CASE WHEN length(content) > 500 THEN {filled(V.MSG_NOT_SAVED, error="'file too large'")}
                       ELSE {filled(V.MSG_SAVED, name='file_name', path="concat('/summaries/', file_name)")} END AS message FROM f""")
ORACLE["upload_manifest"] = with_views("summaries job_events", MANIFEST + " SELECT * FROM manifest")
ORACLE["archive_old_jobs"] = with_views("job_status", f"""
SELECT *, CASE WHEN status IN ('SUCCESS', 'FAILED') AND updated_at < {AS_OF} - INTERVAL '7' DAY
               THEN 'archived' ELSE 'kept' END AS part FROM job_status""")
ORACLE["audit_tail"] = with_views(
    "job_events",
    " SELECT event_type, run_id, agent, sp_used, status, timestamp FROM job_events ORDER BY timestamp DESC, event_id DESC LIMIT 10",
)
ORACLE["extraction_preview"] = with_views(
    "extracted_documents",
    " SELECT extraction_id, document_path, left(extracted_text, 500) AS preview, extracted_by, extracted_at"
    " FROM extracted_documents ORDER BY extracted_at DESC, extraction_id DESC LIMIT 5",
)
ORACLE["events_for_run"] = with_views(
    "job_events conversation_state",
    " SELECT * FROM job_events WHERE agent = 'extraction_agent' AND run_id IN (SELECT extraction_run_id FROM conversation_state)",
)
ORACLE["audit_trail"] = with_views(
    "job_events", " SELECT triggered_by, timestamp, event_type, run_id, agent, sp_used, status, event_id FROM job_events"
)
ORACLE["active_workflows"] = with_views("conversation_state", f"""
SELECT user_id, document_path, extraction_run_id, summarization_run_id, current_stage, triggered_at,
       CAST((epoch_us({AS_OF}) - epoch_us(date_trunc('second', triggered_at))) // 60000000 AS INT) AS elapsed_minutes
FROM conversation_state WHERE status = 'in_progress' AND triggered_at > {AS_OF} - INTERVAL '168' HOUR""")
ORACLE["user_active_jobs"] = with_views(
    "job_status", " SELECT user_id, run_id, status, job_type, updated_at FROM job_status WHERE status IN ('PENDING', 'RUNNING')"
)
ORACLE["conversation_jobs"] = with_views(
    "job_status",
    " SELECT conversation_id, run_id, user_id, job_type, status, updated_at FROM job_status WHERE conversation_id IS NOT NULL",
)
ORACLE["validate_document_path"] = with_views("messages", f"""
, p AS (SELECT event_id, {FIRST_PATH} AS document_path FROM messages)
SELECT event_id, document_path,
       CASE WHEN NOT ends_with(document_path, '.pdf') THEN {text(V.BAD_SUFFIX)}
            WHEN NOT starts_with(document_path, '/source_pdfs/') THEN {text(V.BAD_PREFIX)} END AS reason
FROM p WHERE document_path IS NOT NULL""")
ORACLE["validate_required"] = with_views("job_status", """
SELECT run_id, concat_ws('; ',
         CASE WHEN coalesce(trim(user_id), '') = '' OR contains(user_id, 'SHAREPOINT') THEN 'user is required' END,
         CASE WHEN coalesce(trim(conversation_id), '') = '' OR contains(conversation_id, 'SHAREPOINT') THEN 'conversation is required' END,
         CASE WHEN coalesce(trim(sp_used), '') = '' OR contains(sp_used, 'SHAREPOINT') THEN 'principal is still a placeholder' END) AS errors
FROM job_status""")
ORACLE["job_status_latest"] = with_views("job_events", f"""
SELECT run_id, agent, sp_used, event_type AS latest_status, timestamp AS last_updated FROM {COLD} x""")
ORACLE["latest_event_per_run_agent"] = with_views(
    "linked_events",
    f" SELECT run_id, agent, event_id, event_type, sp_used, triggered_by, timestamp, status, details FROM {newest('linked_events', 'run_id, agent', 'timestamp', 'event_id')} x",
)
ORACLE["run_status"] = with_views("job_events conversation_state", run_status_sql(V.EXTRACTION, STATE_RUNS) + f"""
SELECT run_id, status, CASE status
         WHEN 'NOT_FOUND' THEN {filled(V.MSG_NOT_FOUND, job="'extraction'", run_id='run_id')}
         WHEN 'COMPLETED' THEN {filled(V.MSG_JOB_COMPLETED, label="'Extraction'")}
         WHEN 'FAILED' THEN {filled(V.MSG_JOB_FAILED, label="'Extraction'")}
         ELSE {filled(V.MSG_JOB_RUNNING, label="'Extraction'", elapsed='elapsed_min', eta='eta_min')} END AS message,
       CASE WHEN status IN ('COMPLETED', 'FAILED') THEN details END AS details,
       CASE status WHEN 'COMPLETED' THEN TRUE WHEN 'RUNNING' THEN FALSE END AS ready, elapsed_min, eta_min
FROM p""")
ORACLE["run_progress"] = with_views(
    "job_events summaries",
    run_status_sql(V.SUMMARIZATION, SUMMARY_RUNS) + " SELECT run_id, elapsed_min, eta_min FROM p WHERE status = 'RUNNING'",
)
ORACLE["ready_for_summarization"] = with_views("job_events extracted_documents", f"""
SELECT run_id FROM ({DOC_RUNS}) q WHERE run_id IN
  (SELECT run_id FROM {last_event(V.EXTRACTION)} l WHERE event_type = 'ExtractionJobCompleted')""")
ORACLE["ready_for_upload"] = with_views("job_events summaries", f"""
SELECT run_id FROM ({SUMMARY_RUNS}) q WHERE run_id IN
  (SELECT run_id FROM {last_event(V.SUMMARIZATION)} l WHERE event_type = 'SummarizationJobCompleted')""")
ORACLE["blocked_runs"] = with_views("job_events extracted_documents", f"""
SELECT q.run_id, {status_case('l.event_type', V.EXTRACTION)} AS status,
       {filled(V.MSG_NOT_COMPLETED, label="'Extraction'", run_id='q.run_id')} AS reason
FROM ({DOC_RUNS}) q LEFT JOIN {last_event(V.EXTRACTION)} l ON q.run_id = l.run_id
WHERE coalesce(l.event_type, '') <> 'ExtractionJobCompleted'""")
ORACLE["pending_workflow"] = with_views("conversation_state", f"""
SELECT user_id, state_id, document_path, extraction_run_id, summarization_run_id, current_stage FROM {pending(168)} x""")
ORACLE["workflow_advance"] = with_views(
    "conversation_state job_events",
    f", open_rows AS (SELECT * FROM conversation_state WHERE status = 'in_progress' AND triggered_at > {AS_OF} - INTERVAL '744' HOUR)"
    + steps("open_rows") + """
SELECT state_id, current_stage, run_status, action,
       CASE action WHEN 'start_summarization' THEN 'summarizing' WHEN 'upload' THEN 'completed' ELSE current_stage END AS next_stage,
       CASE action WHEN 'clear' THEN 'completed' ELSE status END AS next_status
FROM d""",
)
ORACLE["advance_state"] = with_views(
    "conversation_state job_events", f", w AS {pending(744)}" + steps("w") + """
SELECT s.state_id, s.user_id, s.document_path, s.extraction_run_id,
       CASE WHEN s.status = 'in_progress' AND action = 'start_summarization' THEN d.extraction_run_id + 1
            ELSE s.summarization_run_id END AS summarization_run_id,
       CASE WHEN s.status = 'in_progress' AND action = 'start_summarization' THEN 'summarizing'
            WHEN s.status = 'in_progress' AND action = 'upload' THEN 'completed' ELSE s.current_stage END AS current_stage,
       s.triggered_at,
       CASE WHEN s.status = 'in_progress' AND action = 'clear' THEN 'completed' ELSE s.status END AS status
FROM conversation_state s LEFT JOIN d ON s.user_id = d.user_id""",
)
ORACLE["workflow_state_from_events"] = with_views("linked_events", f"""
, e AS (SELECT run_id, min(timestamp) AS triggered_at, arg_max(event_type, timestamp) AS e,
               arg_min(triggered_by, timestamp) AS user_id, max(json_extract_string(details, '$.document_path')) AS document_path
        FROM linked_events WHERE agent = 'extraction_agent' GROUP BY run_id)
, s AS (SELECT CAST(json_extract_string(details, '$.extraction_run_id') AS BIGINT) AS extraction_run_id,
               arg_max(run_id, timestamp) AS summarization_run_id, arg_max(event_type, timestamp) AS s
        FROM linked_events WHERE agent = 'summarization_agent' GROUP BY 1)
, u AS (SELECT CAST(json_extract_string(details, '$.summarization_run_id') AS BIGINT) AS summarization_run_id,
               arg_max(event_type, timestamp) AS u
        FROM linked_events WHERE agent = 'sharepoint_agent' GROUP BY 1)
SELECT {uuid_of('e.run_id')} AS state_id, user_id, document_path, e.run_id AS extraction_run_id, s.summarization_run_id,
       CASE WHEN s IS NULL THEN 'extracting' WHEN s <> 'SummarizationJobCompleted' THEN 'summarizing'
            WHEN u = 'SharePointUploadCompleted' THEN 'completed' ELSE 'uploading' END AS current_stage,
       triggered_at,
       CASE WHEN s IS NULL AND e = 'ExtractionJobFailed' THEN 'failed'
            WHEN s = 'SummarizationJobFailed' THEN 'failed'
            WHEN s = 'SummarizationJobCompleted' AND u = 'SharePointUploadFailed' THEN 'failed'
            WHEN s = 'SummarizationJobCompleted' AND u = 'SharePointUploadCompleted' THEN 'completed'
            ELSE 'in_progress' END AS status
FROM e LEFT JOIN s ON e.run_id = s.extraction_run_id LEFT JOIN u ON s.summarization_run_id = u.summarization_run_id""")
ORACLE["job_status_lookup"] = with_views("conversation_state job_status", f"""
SELECT q.run_id, CASE WHEN h.run_id IS NOT NULL THEN 'hot' WHEN c.run_id IS NOT NULL THEN 'cold' END AS source,
       coalesce(h.status, c.status) AS status, coalesce(h.updated_at, c.timestamp) AS updated_at, coalesce(h.sp_used, c.sp_used) AS sp_used
FROM (SELECT DISTINCT CAST(run_id AS VARCHAR) AS run_id FROM ({STATE_RUNS}) r) q
LEFT JOIN job_status h ON q.run_id = h.run_id
LEFT JOIN {COLD} c ON q.run_id = CAST(c.run_id AS VARCHAR)""")
ORACLE["unified_status"] = with_views("job_status", f"""
SELECT run_id, status, updated_at, sp_used, 'hot' AS source FROM job_status
UNION ALL
SELECT CAST(run_id AS VARCHAR), status, timestamp, sp_used, 'cold' FROM {COLD} c
WHERE CAST(run_id AS VARCHAR) NOT IN (SELECT run_id FROM job_status)""")
ORACLE["tier_drift"] = with_views("job_status", f"""
SELECT h.run_id, h.status, c.status AS cold_status, CASE WHEN c.run_id IS NULL THEN 'missing' ELSE 'differs' END AS drift
FROM (SELECT run_id, CASE WHEN agent = 'summarization_agent' THEN 'CANCELLED' ELSE status END AS status FROM job_status
      UNION ALL SELECT concat('9', run_id, '0'), 'PENDING' FROM job_status WHERE agent = 'sharepoint_agent') h
LEFT JOIN {COLD} c
  ON h.run_id = CAST(c.run_id AS VARCHAR)
WHERE c.run_id IS NULL OR h.status IS DISTINCT FROM c.status""")
ORACLE["recent_checkpoints"] = with_views("checkpoints", """
SELECT thread_id, checkpoint_ns, CAST(json_extract_string(checkpoint, '$.ts') AS TIMESTAMP) AS timestamp
FROM checkpoints ORDER BY 3 DESC, 1 DESC LIMIT 10""")
ORACLE["latest_summary"] = with_views("summaries", f" SELECT summarization_run_id, summary_text FROM {LAST_SUMMARY} x")
ORACLE["summary_for_run"] = with_views("summaries conversation_state", f"""
SELECT w.summarization_run_id, x.summary_text FROM (SELECT DISTINCT summarization_run_id FROM conversation_state) w
LEFT JOIN {LAST_SUMMARY} x ON w.summarization_run_id = x.summarization_run_id
WHERE w.summarization_run_id IS NOT NULL""")
ORACLE["run_status_by_run"] = ORACLE["run_status"]
ORACLE["summary_by_run"] = with_views("summaries", f" SELECT summarization_run_id, summary_text FROM {LAST_SUMMARY} x")
ORACLE["extraction_for_run"] = with_views("extracted_documents conversation_state", f"""
SELECT w.extraction_run_id, x.extraction_id, x.document_path, x.extracted_text, x.page_count, x.extracted_at,
       x.extraction_id IS NOT NULL AS found
FROM (SELECT DISTINCT extraction_run_id FROM conversation_state) w
LEFT JOIN {LAST_EXTRACTION} x ON w.extraction_run_id = x.extraction_run_id""")
ORACLE["document_lineage"] = with_views("extracted_documents summaries linked_events", f"""
, u AS (SELECT CAST(json_extract_string(details, '$.summarization_run_id') AS BIGINT) AS run, event_type, timestamp
        FROM linked_events WHERE agent = 'sharepoint_agent'
        QUALIFY ROW_NUMBER() OVER (PARTITION BY run ORDER BY timestamp DESC, event_id DESC) = 1)
SELECT x.extraction_id, x.document_path, x.extraction_run_id,
       CASE WHEN e.run_id IS NOT NULL THEN {status_case('e.event_type', V.EXTRACTION)} END AS extraction_status,
       y.summary_id, y.summarization_run_id,
       CASE WHEN s.run_id IS NOT NULL THEN {status_case('s.event_type', V.SUMMARIZATION)} END AS summarization_status,
       CASE WHEN u.run IS NOT NULL THEN {status_case('u.event_type', V.UPLOAD)} END AS upload_status,
       u.timestamp AS uploaded_at
FROM extracted_documents x
LEFT JOIN {last_event(V.EXTRACTION, 'linked_events')} e ON x.extraction_run_id = e.run_id
LEFT JOIN {newest('summaries', 'extraction_run_id', 'summarized_at', 'summary_id')} y ON x.extraction_run_id = y.extraction_run_id
LEFT JOIN {last_event(V.SUMMARIZATION, 'linked_events')} s ON y.summarization_run_id = s.run_id
LEFT JOIN u ON y.summarization_run_id = u.run""")
ORACLE["recent_events"] = with_views("job_events", " SELECT * FROM job_events ORDER BY timestamp DESC, event_id DESC LIMIT 10")
ORACLE["recent_extractions"] = with_views(
    "extracted_documents", " SELECT * FROM extracted_documents ORDER BY extracted_at DESC, extraction_id DESC LIMIT 5"
)
ORACLE["document_stats"] = with_views("extracted_documents", """
SELECT extraction_id, CAST(length(extracted_text) AS INT) AS n_chars,
       CAST((length(extracted_text) - length(replace(extracted_text, concat(chr(10), chr(10)), ''))) // 2 + 1 AS INT) AS page_count,
       CAST(length(extracted_text) - length(replace(extracted_text, chr(10), '')) + 1 AS INT) AS line_count
FROM extracted_documents""")
ORACLE["compression_ratio"] = with_views("extracted_documents summaries", METADATA + f"""
SELECT summary_id, CAST(original_length AS INT) AS original_length, CAST(summary_length AS INT) AS summary_length,
       {half_up('original_length', 'summary_length')} AS compression_ratio,
       {half_up('summary_length', 'original_length')} AS summary_share FROM m""")
ORACLE["summary_metadata"] = with_views("extracted_documents summaries", METADATA + f"""
SELECT summary_id, summarization_run_id, CAST(json_object('document_path', document_path, 'extraction_run_id', extraction_run_id,
         'pages_summarized', page_count, 'original_length', original_length, 'summary_length', summary_length,
         'compression_ratio', CAST({half_up('original_length', 'summary_length')} AS DOUBLE), 'model_used', 'model-a') AS VARCHAR) AS document_metadata
FROM m""")
LEAD = lead("extracted_text")
SUMMARY = f"trim(CASE WHEN {LEAD} = '' THEN extracted_text ELSE {LEAD} END)"
ORACLE["summarize_documents"] = with_views(
    "extracted_documents",
    f" SELECT extraction_id, {SUMMARY} AS summary_text, CAST(NULL AS VARCHAR) AS error FROM extracted_documents",
)
ORACLE["knowledge_topk"] = with_views("knowledge", topk("knowledge") + KNOWLEDGE_HITS + " SELECT * FROM shown")
ORACLE["knowledge_reply"] = with_views("knowledge", topk("knowledge") + KNOWLEDGE_HITS + f"""
, r AS (SELECT query_id, string_agg({filled(V.KNOWLEDGE_HIT, title='title', preview='preview', source='source')},
                                    concat(chr(10), chr(10)) ORDER BY rank) AS results FROM shown GROUP BY query_id)
SELECT query_id, {filled(V.KNOWLEDGE_REPLY, results='results')} AS reply FROM r""")
ORACLE["product_topk"] = with_views("products", topk("products") + """
SELECT query_id, CAST(rank AS INT) AS rank, vec_id,
       concat('• **', product_name, '** (', category, ') - $', format('{:,.2f}', price)) AS line FROM hits""")
ORACLE["indexed_topk_exact"] = """
WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 50 = 0)
, scored AS (SELECT query_id, vec_id, list_cosine_similarity(v, CAST(embedding AS DOUBLE[])) AS sim FROM q, embeddings)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, vec_id) AS INT) AS rank, vec_id, round(sim, 6) AS score
FROM scored QUALIFY rank <= 3"""
ORACLE["product_lines"] = f"SELECT p_partkey, concat('• **', p_name, '** (', p_type, ') - $', {PRICE}) AS line FROM part"
ORACLE["request_volume"] = with_views("job_events", """
SELECT 'hour' AS grain, date_trunc('hour', timestamp) AS bucket_start, COUNT(*) AS requests FROM job_events GROUP BY 2
UNION ALL
SELECT 'day', CAST(date_trunc('day', timestamp) AS TIMESTAMP), COUNT(*) FROM job_events GROUP BY 2""")
ORACLE["latency_percentiles"] = with_views("agent_usage", """
SELECT agent_id, round(quantile_cont(latency_ms, 0.5), 4) AS p50, round(quantile_cont(latency_ms, 0.95), 4) AS p95,
       round(quantile_cont(latency_ms, 0.99), 4) AS p99 FROM agent_usage GROUP BY agent_id""")
ORACLE["error_rates"] = with_views("job_events", """
SELECT agent, event_type, COUNT(*) AS events, CAST(SUM(COUNT(*)) OVER (PARTITION BY agent) AS BIGINT) AS agent_events,
       event_type LIKE '%Failed' AS is_failure,
       round(COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY agent) AS DOUBLE), 6) AS rate
FROM job_events GROUP BY agent, event_type""")
ORACLE["cost_per_request"] = with_views("agent_usage", """
SELECT agent_id, COUNT(*) AS requests, CAST(SUM(cost) AS DOUBLE) AS total_cost, CAST(SUM(input_tokens) AS BIGINT) AS input_tokens,
       CAST(SUM(output_tokens) AS BIGINT) AS output_tokens, round(CAST(SUM(cost) AS DOUBLE) / COUNT(*), 6) AS avg_cost
FROM agent_usage GROUP BY agent_id""")
ORACLE["documents_processed"] = with_views("job_events", """
SELECT CAST(timestamp AS DATE) AS day, COUNT(DISTINCT run_id) AS documents FROM job_events
WHERE event_type = 'ExtractionJobCompleted' GROUP BY 1""")
ORACLE["top_queries"] = with_views("messages", r"""
SELECT lower(trim(regexp_replace(content, '\s+', ' ', 'g'))) AS message, COUNT(*) AS asked FROM messages
GROUP BY 1 ORDER BY asked DESC, message LIMIT 10""")
ORACLE["security_events"] = with_views("job_events", """
, h AS (SELECT sp_used, date_trunc('hour', timestamp) AS hour, COUNT(*) AS n,
               CAST(SUM(CASE WHEN event_type LIKE '%Failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed
        FROM job_events GROUP BY 1, 2)
, p AS (SELECT sp_used, avg(n) + 3 * stddev_pop(n) AS threshold FROM h GROUP BY sp_used)
SELECT h.sp_used, hour, n, failed, round(threshold, 4) AS threshold, n > threshold AS unusual
FROM h JOIN p ON h.sp_used = p.sp_used WHERE n > threshold OR failed > 0""")
ORACLE["budget_alerts"] = with_views("agent_usage", """
SELECT agent_id, CAST(timestamp AS DATE) AS day, CAST(SUM(cost) AS DOUBLE) AS cost FROM agent_usage
GROUP BY 1, 2 HAVING SUM(cost) > 20""")
ORACLE["rate_limit_violations"] = with_views("messages", """
SELECT user_id, date_trunc('hour', ts) AS window_start, COUNT(*) AS requests FROM messages GROUP BY 1, 2 HAVING COUNT(*) > 1""")
ORACLE["stage_durations"] = with_views("linked_events", STAGE_RUNS.format(log="linked_events") + """
SELECT *, (epoch_us(finished_at) - epoch_us(started_at)) / 1000000 AS duration_seconds FROM runs""")
ORACLE["event_gaps"] = with_views("job_events", """
, g AS (SELECT event_id, triggered_by, timestamp,
               LAG(timestamp) OVER (PARTITION BY triggered_by ORDER BY timestamp, event_id) AS prev_timestamp FROM job_events)
SELECT *, (epoch_us(timestamp) - epoch_us(prev_timestamp)) / 1000000 AS gap_seconds FROM g""")
ORACLE["stalled_runs"] = with_views("job_events", STAGE_RUNS.format(log="job_events") + f"""
, t AS (SELECT *, CASE agent WHEN 'extraction_agent' THEN 60 WHEN 'summarization_agent' THEN 30 END AS timeout_min FROM runs)
SELECT run_id, agent, started_at, finished_at, timeout_min, CASE WHEN finished_at IS NULL THEN 'open' ELSE 'late' END AS state
FROM t WHERE epoch_us(coalesce(finished_at, {AS_OF})) - epoch_us(started_at) > CAST(timeout_min AS BIGINT) * 60000000""")
ORACLE["key_violations"] = with_views(
    "job_events conversation_state extracted_documents summaries job_status",
    ", twice AS (SELECT * FROM summaries UNION ALL SELECT * FROM summaries) "
    + " UNION ALL ".join(
        [
            key_check("job_events", "job_events", "event_id"),
            key_check("conversation_state", "conversation_state", "state_id"),
            key_check("extracted_documents", "extracted_documents", "extraction_id"),
            key_check("extracted_documents by run", "extracted_documents", "extraction_run_id"),
            key_check("summaries", "summaries", "summary_id"),
            key_check("summaries appended twice", "twice", "summary_id"),
            key_check("job_status", "job_status", "run_id"),
            key_check("job_status by conversation", "job_status", "conversation_id"),
        ]
    ),
)
ORACLE["principal_isolation"] = with_views("job_events", """
SELECT agent, sp_used, COUNT(*) AS events,
       CASE agent WHEN 'extraction_agent' THEN 'EXTRACTION_SP' WHEN 'summarization_agent' THEN 'OTHER_SP' END AS expected_sp,
       agent = 'extraction_agent' AND sp_used = 'EXTRACTION_SP' AS isolated
FROM job_events GROUP BY agent, sp_used""")
ORACLE["active_prompt"] = with_views("prompts", f"""
SELECT prompt_id, version, content, approved_by, approved_at FROM {newest('prompts', 'prompt_id', 'version', 'approved_at', 'active')} x""")
ORACLE["pii_detect"] = "SELECT doc_id, " + ", ".join(
    f"CAST(len(regexp_extract_all(text, {text(p)})) AS INT) AS {n}_count" for n, p in V.PII_PATTERNS.items()
) + " FROM documents"
REDACTED = "text"
for _name, _pattern in V.PII_PATTERNS.items():
    REDACTED = f"regexp_replace({REDACTED}, {text(_pattern)}, '[{_name.upper()}]', 'g')"
ORACLE["pii_redact"] = f"SELECT doc_id, {REDACTED} AS text FROM documents"
ORACLE["input_limits"] = """
SELECT doc_id, concat_ws('; ', CASE WHEN length(text) > 5000 THEN 'too long' END,
         CASE WHEN lang NOT IN ('en', 'de') THEN 'type not allowed' END,
         CASE WHEN strlen(text) > 6000 THEN 'too large' END) AS reasons FROM documents"""
ORACLE["blocked_terms"] = """
SELECT doc_id, term, CAST((length(lower(text)) - length(replace(lower(text), term, ''))) // length(term) AS INT) AS n
FROM documents, (VALUES ('license'), ('copyright'), ('confidential'), ('the ')) t(term)
WHERE contains(lower(text), term)"""
ORACLE["classify_intent"] = with_views("messages", f" SELECT event_id, {INTENT} AS intent FROM messages")
ORACLE["classify_refresh"] = with_views(
    "messages",
    f" SELECT event_id, CASE WHEN {contains_any('content', V.REFRESH_WORDS)} THEN 'refresh' ELSE 'search' END AS target FROM messages",
)
ORACLE["extract_document_path"] = with_views("messages", f" SELECT event_id, {SOURCE_PATH} AS document_path FROM messages")
ORACLE["extract_volume_path"] = with_views("messages", f"""
SELECT event_id, {VOLUME_PATH} AS volume_path,
       CASE WHEN contains(lower(content), 'extract') AND {VOLUME_PATH} IS NULL THEN {text(V.MSG_NO_VOLUME_PATH)} END AS reply
FROM messages""")
ORACLE["parse_run_id"] = with_views(
    "job_events", " SELECT event_id, CASE WHEN status <> 'FAILED' THEN run_id END AS parsed_run_id FROM job_events"
)
ORACLE["event_details"] = with_views("job_events", """
SELECT event_id, CASE WHEN status = 'FAILED'
    THEN concat('{"run_id":', run_id, ',"sp_used":"', sp_used, '","error":"failed with ', json_extract_string(details, '$.k'), '"}')
    ELSE concat('{"run_id":', run_id, ',"sp_used":"', sp_used, '"}') END AS details FROM job_events""")
ORACLE["details_fields"] = with_views("job_events", """
SELECT event_id, CAST(json_extract_string(details, '$.k') AS INT) AS k,
       json_extract_string(details, '$.document_path') AS document_path FROM job_events""")
ORACLE["build_prompt"] = with_views("extracted_documents", f"""
SELECT extraction_id, 'system' AS first_role, {text(V.SYSTEM_PROMPT)} AS instruction, 'user' AS second_role,
       concat({text(V.USER_PROMPT)}, extracted_text) AS request FROM extracted_documents""")
ORACLE["text_helpers"] = with_views("messages", """
SELECT event_id, left(content, 20) AS preview, replace(content, '''', '''''') AS quoted,
       concat('extract_', event_id) AS composed_id, concat('user', user_id) AS user_name,
       strftime(ts, '%Y%m%d_%H%M%S') AS stamp, ts AS parsed_ts FROM messages""")
ORACLE["route_messages"] = with_views("messages conversation_state job_events", ROUTED + " SELECT * FROM routed")
ORACLE["route_in_order"] = "WITH RECURSIVE " + with_views("messages conversation_state job_events knowledge", searched("messages", f"{INTENT} = 'search_knowledge'")
    + topk("knowledge", "") + KNOWLEDGE_HITS + IN_ORDER).removeprefix("WITH ")
ORACLE["route_volume"] = with_views("messages", f"""
SELECT event_id, user_id, {VOLUME_PATH} AS path,
       CASE WHEN {VOLUME_PATH} IS NOT NULL THEN {filled(V.MSG_VOLUME_STARTED, path=VOLUME_PATH, run_id='event_id * 10 + 1')}
            WHEN contains(lower(content), 'extract') THEN {text(V.MSG_NO_VOLUME_PATH)} ELSE {text(V.MSG_VOLUME_HELP)} END AS reply
FROM messages""")
REFRESH = contains_any("content", V.REFRESH_WORDS)
ORACLE["route_catalog"] = with_views("messages", f"""
SELECT event_id, user_id, CASE WHEN {REFRESH} THEN 'refresh' ELSE 'search' END AS target,
       CASE WHEN {REFRESH} THEN {filled(V.MSG_REFRESH, run_id='event_id * 10 + 9')} ELSE {text(V.MSG_NO_PRODUCTS)} END AS reply
FROM messages""")
ORACLE["catalog_replies"] = with_views("messages products", searched("messages", f"NOT {REFRESH}") + topk("products", "") + f"""
, r AS (SELECT query_id, concat({text(V.PRODUCT_HEADER)}, chr(10), string_agg(
          concat('• **', product_name, '** (', category, ') - $', format('{{:,.2f}}', price), chr(10), '  ', p_brand, ', size ', p_size, ': ', p_name, chr(10)), chr(10) ORDER BY rank)) AS reply
        FROM hits JOIN part ON p_partkey = vec_id GROUP BY query_id)
SELECT event_id, user_id, CASE WHEN {REFRESH} THEN 'refresh' ELSE 'search' END AS target,
       CASE WHEN {REFRESH} THEN {filled(V.MSG_REFRESH, run_id='event_id * 10 + 9')} ELSE coalesce(reply, {text(V.MSG_NO_PRODUCTS)}) END AS reply
FROM messages LEFT JOIN r ON query_id = event_id""")
ORACLE["chat_response"] = with_views("messages conversation_state job_events", ROUTED + """
SELECT event_id, concat('response-', md5(concat(event_id, '|', reply))) AS id, 1 AS n_choices, 0 AS choice_index,
       'assistant' AS role, reply AS content, 'stop' AS finish_reason FROM routed""")
ORACLE["extract_batch"] = events_select(
    "documents", "'ExtractionJobCompleted'", V.EXTRACTION, "doc_id * 10 + 1", "'SUCCESS'",
    "CAST(json_object('document_path', concat('/source_pdfs/patient_', doc_id, '.pdf'),"
    " 'pages_extracted', length(text) - length(replace(text, chr(10), '')) + 1, 'characters_extracted', length(text),"
    " 'extraction_id', concat('extract_', doc_id * 10 + 1), 'sp_used', 'EXTRACTION_SP') AS VARCHAR)", "'batch'",
)
ORACLE["summarize_batch"] = with_views("job_events extracted_documents", f"""
, x AS (SELECT *, {SUMMARY} AS summary_text FROM {LAST_EXTRACTION} y WHERE extraction_run_id IN
        (SELECT run_id FROM {last_event(V.EXTRACTION)} l WHERE event_type = 'ExtractionJobCompleted'))
SELECT concat('summary_', extraction_run_id + 1) AS summary_id, extraction_run_id + 1 AS summarization_run_id, extraction_run_id, summary_text,
       CAST(json_object('document_path', document_path, 'extraction_run_id', extraction_run_id, 'pages_summarized', page_count,
         'original_length', length(extracted_text), 'summary_length', length(summary_text),
         'compression_ratio', CAST({half_up('length(extracted_text)', 'length(summary_text)')} AS DOUBLE),
         'model_used', 'leading_sentences') AS VARCHAR) AS document_metadata,
       {AS_OF} AS summarized_at, 'SUMMARIZATION_SP' AS summarized_by
FROM x""")
ORACLE["upload_batch"] = with_views("summaries job_events", MANIFEST + events_select(
    "manifest WHERE event_type IS NOT NULL", "event_type", V.UPLOAD, "0",
    "CASE WHEN event_type = 'SharePointUploadCompleted' THEN 'COMPLETED' ELSE 'FAILED' END",
    "CASE WHEN url IS NOT NULL THEN CAST(json_object('summarization_run_id', summarization_run_id, 'sharepoint_url', url, 'sp_used', 'SHAREPOINT_SP') AS VARCHAR)"
    " ELSE CAST(json_object('summarization_run_id', summarization_run_id, 'error', reason, 'sp_used', 'SHAREPOINT_SP') AS VARCHAR) END",
))
ORACLE["synced_status"] = with_views(
    "job_events", f" SELECT run_id, agent, sp_used, status, timestamp AS updated_at FROM {COLD} x"
)
ORACLE["dedup_events"] = with_views("job_events", " SELECT * FROM job_events")
ORACLE["live_volume"] = with_views("job_events", """
SELECT date_trunc('hour', timestamp) AS window_start, agent, COUNT(*) AS events,
       CAST(SUM(CASE WHEN event_type LIKE '%Failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       round(SUM(CASE WHEN event_type LIKE '%Failed' THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE), 6) AS error_rate
FROM job_events GROUP BY 1, 2""")
ORACLE["silent_runs"] = with_views("job_events", """
, mine AS (SELECT * FROM job_events WHERE agent = 'extraction_agent')
, gaps AS (SELECT *, timestamp >= LAG(timestamp) OVER (PARTITION BY run_id ORDER BY timestamp) + INTERVAL 60 MINUTE AS fresh FROM mine)
, numbered AS (SELECT *, SUM(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY timestamp) AS session FROM gaps)
, sessions AS (SELECT run_id, MAX(timestamp) + INTERVAL 60 MINUTE AS gave_up_at,
                      MAX(CASE WHEN event_type LIKE '%Started' THEN timestamp END) AS started_at,
                      MAX(CASE WHEN event_type NOT LIKE '%Started' THEN timestamp END) AS ended_at
               FROM numbered GROUP BY run_id, session)
SELECT run_id, started_at, gave_up_at FROM sessions
WHERE started_at IS NOT NULL AND (ended_at IS NULL OR ended_at < started_at)
  AND gave_up_at <= (SELECT MAX(timestamp) FROM mine)""")
ORACLE["paths_of_collection"] = with_views("extracted_documents", """
SELECT extraction_id, document_path FROM extracted_documents
WHERE document_path LIKE '%/source_pdfs/%' AND contains(document_path, 'patient_1')""")
HOT_CHANGES = """
, changes AS (
  SELECT run_id, user_id, NULL AS conversation_id, job_type, agent, 'SUCCESS' AS status, sp_used,
         updated_at AS created_at, TIMESTAMP '2024-01-31 00:00:00' AS updated_at FROM job_status WHERE agent <> 'sharepoint_agent'
  UNION ALL
  SELECT run_id, user_id, conversation_id, job_type, agent, 'PENDING', sp_used, created_at, created_at - INTERVAL 1 DAY FROM job_status)
"""
ORACLE["hot_upsert"] = with_views("job_status", HOT_CHANGES + """
SELECT h.run_id, h.user_id, h.conversation_id, h.job_type, h.agent, coalesce(c.status, h.status) AS status, h.sp_used,
       h.created_at, coalesce(c.updated_at, h.updated_at) AS updated_at
FROM job_status h LEFT JOIN changes c ON h.run_id = c.run_id AND c.status = 'SUCCESS'""")
ORACLE["hot_delete"] = with_views("job_status", f"""
SELECT * FROM job_status WHERE NOT (status IN ('SUCCESS', 'FAILED') AND updated_at < {AS_OF} - INTERVAL '7' DAY)""")
ORACLE["stage_trigger"] = with_views("linked_events", """
SELECT DISTINCT CASE WHEN agent = 'sharepoint_agent' THEN CAST(json_extract_string(details, '$.summarization_run_id') AS BIGINT) ELSE run_id END AS run_id, agent, CASE event_type WHEN 'ExtractionJobCompleted' THEN 'start_summarization'
                                               WHEN 'SummarizationJobCompleted' THEN 'upload' ELSE 'clear' END AS action
FROM linked_events WHERE event_type LIKE '%Completed' OR event_type LIKE '%Failed'""")
ORACLE["table_roundtrip"] = with_views("job_events", " SELECT * FROM job_events")
ORACLE["named_table"] = with_views("summaries", " SELECT * FROM summaries")
ORACLE["rows_to_frame"] = with_views("prompts", " SELECT prompt_id, version, CAST(NULL AS VARCHAR) AS content, active FROM prompts")
ORACLE["extract_pipeline"] = """
SELECT concat('extract_', doc_id * 10 + 1) AS extraction_id, doc_id * 10 + 1 AS extraction_run_id, text AS extracted_text,
       CAST((length(text) - length(replace(text, concat(chr(10), chr(10)), ''))) // 2 + 1 AS INT) AS page_count
FROM documents"""
ORACLE["summarize_pipeline"] = with_views("job_events extracted_documents", f"""
SELECT concat('summary_', extraction_run_id + 1) AS summary_id, extraction_run_id + 1 AS summarization_run_id, extraction_run_id,
       concat(length(extracted_text), ' characters') AS summary_text
FROM {LAST_EXTRACTION} y
WHERE NOT contains(extracted_text, '|') AND extraction_run_id IN
      (SELECT run_id FROM {last_event(V.EXTRACTION)} l WHERE event_type = 'ExtractionJobCompleted')""")
ORACLE["upload_pipeline"] = ORACLE["upload_batch"]

ORACLE["request_bursts"] = with_views("messages", """
, m AS (SELECT *, lag(ts, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS since FROM messages)
SELECT user_id, event_id, ts, since FROM m WHERE epoch_us(ts) - epoch_us(since) < 21600000000""")


def _over_budget(key: str, hours: int, budget: float) -> str:
    return with_views("agent_usage", f"""
, s AS (SELECT {key}, timestamp, invocation_id, sum(cost) OVER (
          PARTITION BY {key} ORDER BY timestamp RANGE BETWEEN INTERVAL {hours * 3600 * 1_000_000 - 1} MICROSECONDS PRECEDING AND CURRENT ROW) AS spent
        FROM agent_usage)
SELECT {key}, timestamp, invocation_id, CAST(spent AS DOUBLE) AS spent FROM s WHERE spent > {budget}""")


ORACLE["budget_by_user"] = _over_budget("user_id", 24, 0.5)
ORACLE["budget_by_agent"] = _over_budget("agent_id", 6, 5.0)
_STATE = ["state_id", "user_id", "document_path", "extraction_run_id", "summarization_run_id", "current_stage", "triggered_at", "status"]
_AFTER = f"SELECT * FROM ({ORACLE['advance_state']}) x WHERE status <> 'completed' OR current_stage <> 'completed'"
_CHANGED = "(" + " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in _STATE) + ")"


def _side(side: str, kind: str, where: str) -> str:
    shown = ", ".join(f"{side}.{c}" for c in _STATE)
    return (
        f"SELECT {shown}, '{kind}' AS change_type, CAST(1 AS BIGINT) AS change_version "
        f"FROM conversation_state b FULL JOIN after_ a ON a.state_id = b.state_id WHERE {where}"
    )


ORACLE["table_changes"] = with_views("conversation_state", f", after_ AS ({_AFTER}) " + " UNION ALL ".join([
    _side("a", "insert", "b.state_id IS NULL"), _side("b", "delete", "a.state_id IS NULL"),
    _side("b", "update_before", f"a.state_id IS NOT NULL AND b.state_id IS NOT NULL AND {_CHANGED}"),
    _side("a", "update_after", f"a.state_id IS NOT NULL AND b.state_id IS NOT NULL AND {_CHANGED}"),
]))
ORACLE["replayed_changes"] = f"SELECT {', '.join(_STATE)} FROM ({_AFTER}) y"

# Sketches are exact up to sketches.K values, so this holds while no agent has more in a day.
ORACLE["latency_by_hour"] = with_views("agent_usage", """
, g AS (SELECT 'hour' AS grain, date_trunc('hour', timestamp) AS bucket_start, agent_id, latency_ms FROM agent_usage
        UNION ALL
        SELECT 'day', CAST(date_trunc('day', timestamp) AS TIMESTAMP), agent_id, latency_ms FROM agent_usage)
, r AS (SELECT *, row_number() OVER (PARTITION BY grain, bucket_start, agent_id ORDER BY latency_ms) AS rn,
               COUNT(*) OVER (PARTITION BY grain, bucket_start, agent_id) AS n FROM g WHERE latency_ms IS NOT NULL)
SELECT grain, bucket_start, agent_id, MAX(n) AS requests, CAST(MIN(CASE WHEN rn >= 0.5 * n THEN latency_ms END) AS DOUBLE) AS p50,
       CAST(MIN(CASE WHEN rn >= 0.95 * n THEN latency_ms END) AS DOUBLE) AS p95,
       CAST(MIN(CASE WHEN rn >= 0.99 * n THEN latency_ms END) AS DOUBLE) AS p99 FROM r GROUP BY 1, 2, 3""")
ORACLE["listed_terms"] = """
WITH RECURSIVE terms AS (SELECT DISTINCT lower(w) AS term FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark) x WHERE length(w) >= 6)
, texts AS (SELECT doc_id, lower(text) AS body FROM documents)
, hits AS (SELECT doc_id, term, body[instr(body, term) + 1:] AS rest FROM texts, terms WHERE contains(body, term)
           UNION ALL
           SELECT doc_id, term, rest[instr(rest, term) + 1:] FROM hits WHERE contains(rest, term))
SELECT doc_id, term, COUNT(*) AS n FROM hits GROUP BY 1, 2"""
ORACLE["silent_runs_timed"] = ORACLE["silent_runs"]
ORACLE["live_bursts"] = with_views("job_events", """
, m AS (SELECT triggered_by, event_id, timestamp AS ts, lag(timestamp, 2) OVER (PARTITION BY triggered_by ORDER BY timestamp, event_id) AS since FROM job_events)
SELECT triggered_by, event_id, ts, since FROM m WHERE epoch_us(ts) - epoch_us(since) < 21600000000""")
ORACLE["folded_status"] = ORACLE["synced_status"]
