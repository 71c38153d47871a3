"""The same results in plain SQL over the given tables, for checking the queries."""

from __future__ import annotations

LOG_EVENTS = """log_events AS (
SELECT event_id, ts, event_type, user_id, value,
  CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 60 WHEN 2 THEN -300 ELSE 600 END AS offset_minutes,
  CASE event_type WHEN 'view' THEN 'Verbose' WHEN 'click' THEN 'Debug' WHEN 'purchase' THEN 'Information'
    WHEN 'signup' THEN 'Warning' ELSE CASE WHEN event_id % 5 = 0 THEN 'Fatal' ELSE 'Error' END END AS level,
  CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2
    WHEN 'signup' THEN 3 ELSE CASE WHEN event_id % 5 = 0 THEN 5 ELSE 4 END END AS level_rank,
  CASE event_id % 3 WHEN 0 THEN '{EventType} by {UserId}' WHEN 1 THEN 'Value {Value:0.00} for {UserId}'
    ELSE '{Missing} {{literal}} {EventType}' END AS message_template,
  CASE WHEN event_id % 17 = 0 THEN '{"k":"s' || event_id || '"}' ELSE props END AS props,
  CASE WHEN event_type = 'error' THEN 1 + event_id % 25 ELSE 0 END AS chain_len,
  CASE WHEN event_id % 97 = 0 THEN 400 WHEN event_id % 89 = 0 THEN 429 ELSE 201 END AS status
FROM events)"""

DAILY = "'logstash-' || strftime(ts, '%Y.%m.%d')"
BYTES = "octet_length(encode({}))"

# Buffer files and byte positions of their lines.
FILE_NAME = "'buf-' || strftime(ts, '%Y%m%d') || CASE WHEN event_id % 2 = 0 THEN '' ELSE '_001' END || '.json'"
LINES = f"""lines AS (
SELECT {FILE_NAME} AS file_name, strftime(ts, '%Y%m%d') AS file_date, event_id % 2 AS seq, event_id, user_id, ts, status,
  props AS line, octet_length(encode(props)) AS n_bytes FROM log_events)"""
FILES = """files AS (
SELECT file_name, file_date, seq, CAST(sum(n_bytes) AS BIGINT) AS size_bytes, count(*) AS n_lines
FROM lines GROUP BY file_name, file_date, seq)"""


def offsets(keys: str) -> str:
    return f"""ends AS (
SELECT *, CAST(sum(n_bytes + 1) OVER (PARTITION BY {keys} ORDER BY event_id) AS BIGINT) AS e FROM lines),
placed AS (
SELECT *, CASE WHEN e - n_bytes - 1 = 0 THEN 0 ELSE e - n_bytes - 1 + 3 END AS start_offset, e + 3 AS next_offset FROM ends)"""


# Batches of 50 per daily index.
BATCHED = f"""numbered AS (
SELECT *, {DAILY} AS index, row_number() OVER (PARTITION BY {DAILY} ORDER BY ts, event_id) - 1 AS place FROM log_events),
batched AS (
SELECT *, index || '#' || (place // 50) AS batch_id, CAST(place % 50 AS INTEGER) AS pos FROM numbered)"""

# Parts of a document.
VALUE = "CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END"
MEMBERS = f"""'"EventType":"' || event_type || '","UserId":' || user_id || ',"Value":' || {VALUE} || ',"k":' || CAST(json_extract(props, '$.k') AS VARCHAR)"""
MESSAGE = """CASE event_id % 3 WHEN 0 THEN '"' || event_type || '" by ' || user_id
  WHEN 1 THEN 'Value ' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || ' for ' || user_id
  ELSE '{Missing} {literal} "' || event_type || '"' END"""
TIME = """strftime(ts + offset_minutes * INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '0' || CASE WHEN offset_minutes < 0 THEN '-' ELSE '+' END
  || lpad(CAST(abs(offset_minutes) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(abs(offset_minutes) % 60 AS VARCHAR), 2, '0')"""
RENDERINGS = """CASE WHEN event_id % 3 = 1
  THEN '{"Value":[{"Format":"0.00","Rendering":"' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || '"}]}' END"""
METHOD = """'{"Name":"Method' || (d % 4) || '","AssemblyName":"Asm' || (d % 2) || '","AssemblyVersion":"1.' || (d % 3)
  || '.0.0","AssemblyCulture":"","ClassName":"App.Class' || (d % 3) || '","Signature":"Void Method' || (d % 4) || '()","MemberType":8}'"""
EXCEPTION = f"""'"Depth":' || d || ',"ClassName":"E' || (d % 3) || '","Message":"m' || d || '","Source":' || CASE WHEN d % 2 = 0 THEN '"app"' ELSE 'null' END
  || ',"StackTraceString":' || CASE WHEN d % 4 <> 3 THEN '"at A\\n\\nat B"' ELSE 'null' END
  || ',"RemoteStackTraceString":null,"RemoteStackIndex":0' || CASE WHEN d % 5 = 4 THEN '' ELSE ',"ExceptionMethod":' || {METHOD} END
  || ',"HResult":' || (-d) || ',"HelpURL":null'"""
EXCEPTIONS = f"""CASE WHEN chain_len > 0 THEN ',"exceptions":['
  || array_to_string(list_transform(range(least(chain_len, 21)), lambda d: '{{' || {EXCEPTION} || '}}'), ',') || ']' ELSE '' END"""
DEPTHS = "depths AS (SELECT event_id, unnest(range(least(chain_len, 21))) AS d FROM log_events)"


def document(template: bool = True, message: bool = True, inline: bool = False) -> str:
    """A document's members as a SQL string expression."""
    parts = [f"""'"@timestamp":"' || {TIME} || '","level":"' || level || '"'"""]
    if template:
        parts.append("""',"messageTemplate":' || CAST(to_json(message_template) AS VARCHAR)""")
    if message:
        parts.append(f"""',"message":' || CAST(to_json({MESSAGE}) AS VARCHAR)""")
    parts.append(EXCEPTIONS)
    parts.append(f"',' || {MEMBERS}" if inline else f"""',"fields":{{' || {MEMBERS} || '}}'""")
    parts.append(f"""coalesce(',"renderings":' || {RENDERINGS}, '')""")
    return " || ".join(parts)


TARGETS = """targets(target, version, type_name, registration_ok, recovery) AS (VALUES
  ('t0', '8.0.0', 'my', true, 'IndexAnyway'), ('t1', '7.17.5', NULL, false, 'IndexAnyway'), ('t2', '6.8.1', 'my', true, 'IndexAnyway'),
  ('t3', '6.8.1', NULL, false, 'IndexToDeadletterIndex'), ('t4', '8.0.0', NULL, false, 'FailSink')),
targeted AS (SELECT e.*, t.* FROM log_events e JOIN targets t ON t.target = 't' || (e.user_id % 5))"""
TYPE_NAME = "CASE WHEN CAST(split_part(version, '.', 1) AS INTEGER) < 7 THEN coalesce(type_name, 'logevent') END"

FIELDS = f"""fields AS (
SELECT event_id, ts, {DAILY} AS index, 'fields.k' AS path,
  CASE json_type(props, '$.k') WHEN 'VARCHAR' THEN 'string' ELSE 'long' END AS type FROM log_events)"""
MAPPED = "mapped AS (SELECT index, path, arg_min(type, (ts, event_id)) AS mapped_type FROM fields GROUP BY index, path)"

STUB_STATUS = "CASE WHEN event_id % 17 = 0 THEN 400 WHEN user_id % 89 = 0 THEN 429 ELSE 201 END"
ERROR_TYPE = "CASE status WHEN 400 THEN 'mapper_parsing_exception' WHEN 429 THEN 'rejected' END"
DOC_ID = "CASE WHEN status = 429 AND event_id % 2 = 0 THEN 'x' ELSE CAST(pos AS VARCHAR) END || '_' || md5(CAST(event_id AS VARCHAR))"


def after(*steps: str, recursive: bool = False) -> str:
    """A ``WITH`` of the log events and the given steps."""
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join([LOG_EVENTS, *steps]) + "\n"


def _action(op: str, with_id: bool) -> str:
    members = [
        f"""coalesce('"_type":"' || {TYPE_NAME} || '",', '')""",
        f"""'"_index":"' || {DAILY} || '"'""",
        """CASE WHEN target = 't0' THEN ',"pipeline":"my-pipeline"' ELSE '' END""",
    ]
    if with_id:
        members.append("""',"_id":"' || event_id || '"'""")
    return f"""'{{"{op}":{{' || """ + " || ".join(members) + " || '}}'"


PER_INDEX = f"""SELECT {DAILY} AS index, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM log_events"""

ORACLES: dict[str, str] = {
    "buffer_file_catalog": after(LINES, FILES)
    + "SELECT file_name, file_date, seq, size_bytes, n_lines, row_number() OVER (ORDER BY file_date, seq) AS rank FROM files",
    "buffer_line_offsets": after(LINES, offsets("file_name"))
    + "SELECT file_name, event_id, start_offset, next_offset FROM placed",
    "stream_ship_counts": after(LINES)
    + "SELECT file_name, count(*) AS n_lines, CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM lines GROUP BY file_name",
    "resume_from_bookmark": after(LINES, offsets("user_id % 5, file_name"))
    + """SELECT 't' || (user_id % 5) AS source, file_name, event_id, start_offset FROM placed
WHERE CASE WHEN user_id % 5 = 0 AND EXISTS (SELECT 1 FROM lines WHERE user_id % 5 = 0 AND file_name = 'buf-20240105.json')
  THEN (file_date, seq, start_offset) >= ('20240105', 0, 120)
  WHEN user_id % 5 = 3 AND EXISTS (SELECT 1 FROM lines WHERE user_id % 5 = 3 AND file_name = 'buf-20240120_001.json')
  THEN (file_date, seq, start_offset) >= ('20240120', 1, 0) ELSE true END""",
    "read_index_pattern": after()
    + f"""SELECT {DAILY} AS _index, level, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM log_events
WHERE {DAILY} LIKE 'logstash-2024.01.1%' GROUP BY 1, 2""",
    "filter_min_level": after() + "SELECT event_id, level, level_rank FROM log_events WHERE level_rank >= 2",
    "filter_level_switch_asof": after(
        "control(effective_from, min_rank) AS (VALUES (TIMESTAMP '2024-01-01', 2), (TIMESTAMP '2024-01-10', 0), (TIMESTAMP '2024-01-20', 4))")
    + """SELECT event_id, level_rank FROM log_events ASOF LEFT JOIN control ON ts >= effective_from
WHERE level_rank >= coalesce(min_rank, 0)""",
    "drop_oversized": after()
    + "SELECT event_id, octet_length(encode(props)) AS n_bytes, octet_length(encode(props)) <= 9 AS kept FROM log_events",
    "admission_limit": after()
    + """SELECT event_id, bucket FROM (SELECT event_id, strftime(ts, '%Y-%m-%d %H') AS bucket,
  row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d %H') ORDER BY ts, event_id) AS rn FROM log_events) WHERE rn <= 10""",
    "admission_counts": after()
    + """SELECT strftime(ts, '%Y-%m-%d %H') AS bucket, least(count(*), 10) AS admitted, greatest(count(*) - 10, 0) AS dropped
FROM log_events GROUP BY 1""",
    "document_envelope": after()
    + f"""SELECT event_id, {TIME} AS "@timestamp", level, message_template AS "messageTemplate", {MESSAGE} AS message FROM log_events""",
    "document_no_message": after()
    + f"SELECT event_id, '{{' || {document(template=False, message=False)} || '}}' AS doc FROM log_events",
    "document_inline_fields": after() + f"SELECT event_id, '{{' || {document(inline=True)} || '}}' AS doc FROM log_events",
    "document_delimited": after(f"d AS (SELECT event_id, {document(message=False)} AS members FROM log_events)")
    + "SELECT event_id, members, '{' || members || '};' || chr(10) AS delimited FROM d",
    "build_document": after() + f"SELECT event_id, '{{' || {document()} || '}}' AS doc FROM log_events",
    "documents_read_back": after()
    + f"""SELECT event_id, epoch_us(ts) AS micros, level, {MESSAGE} AS message, CAST(least(chain_len, 21) AS INTEGER) AS n_exceptions FROM log_events""",
    "document_renderings": after() + f"SELECT event_id, {RENDERINGS} AS renderings FROM log_events",
    "render_message": after() + f"SELECT event_id, {MESSAGE} AS message FROM log_events",
    "render_precise_numbers": f"""SELECT event_id, CAST(CAST(x AS DECIMAL(30,2)) AS VARCHAR) AS n0, lpad(CAST(CAST(x AS DECIMAL(30,3)) AS VARCHAR), CAST(greatest(7, length(CAST(CAST(x AS DECIMAL(30,3)) AS VARCHAR))) AS INTEGER), '0') AS n1,
  CAST(CAST(x AS DECIMAL(30,12)) AS VARCHAR) AS n2, CAST(CAST(x AS DECIMAL(30,4)) AS VARCHAR) AS n3, '2.67' AS half
FROM (SELECT event_id, CAST(CAST(value / 7 AS DECIMAL(30,17)) AS VARCHAR) || '49' AS x FROM events)""",
    "template_token_usage": after(
        r"tokens AS (SELECT unnest(regexp_extract_all(message_template, '\{\{|\}\}|\{[^{}]+\}')) AS token FROM log_events)")
    + "SELECT token, count(*) AS n FROM tokens WHERE token NOT IN ('{{', '}}') GROUP BY token",
    "route_index_daily": after()
    + "SELECT event_id, lower('DailyIndex-' || strftime(ts, '%Y.%m.%d') || '-MyCompany') AS index FROM log_events",
    "route_index_by_level": after()
    + "SELECT event_id, 'logstash-' || level || '-' || strftime(ts, '%Y.%m.%d') AS index FROM log_events",
    "route_index_by_file_date": after(LINES)
    + f"SELECT event_id, file_name, {DAILY} AS index FROM lines",
    "route_dead_letter": after(TARGETS)
    + f"""SELECT event_id, target, CASE WHEN NOT registration_ok AND recovery = 'IndexToDeadletterIndex'
  THEN 'DeadLetter-' || strftime(ts, '%Y.%m.%d') ELSE {DAILY} END AS index
FROM targeted WHERE registration_ok OR recovery <> 'FailSink'""",
    "direct_end_to_end": after(TARGETS, f"""sent AS (SELECT target, CASE WHEN NOT registration_ok AND recovery = 'IndexToDeadletterIndex'
  THEN 'DeadLetter-' || strftime(ts, '%Y.%m.%d') ELSE {DAILY} END AS index, {TYPE_NAME} AS doc_type
FROM targeted WHERE level_rank >= 2 AND (registration_ok OR recovery <> 'FailSink'))""")
    + """SELECT target, index, doc_type, count(*) AS n, CAST(least(count(*), 50) - 1 AS INTEGER) AS last_pos, (count(*) + 49) // 50 AS batches FROM sent GROUP BY 1, 2, 3
UNION ALL SELECT target, NULL, NULL, count(*), NULL, NULL FROM targeted
WHERE level_rank >= 2 AND NOT registration_ok AND recovery = 'FailSink' GROUP BY target""",
    "route_pipeline": after()
    + "SELECT event_id, CASE level WHEN 'Fatal' THEN 'alerts' WHEN 'Verbose' THEN NULL ELSE 'main' END AS pipeline FROM log_events",
    "resolve_type_name": after(TARGETS)
    + f"SELECT target, {TYPE_NAME} AS resolved_type, count(*) AS n FROM targeted GROUP BY 1, 2",
    "match_index_template": after(
        "templates(name, pattern, priority) AS (VALUES ('a', 'logstash-*', 1), ('b', 'logstash-2024.01.1*', 2), ('c', 'dailyindex-*-mycompany', 1))",
        f"indices AS (SELECT {DAILY} AS index, count(*) AS n FROM log_events GROUP BY 1)")
    + """SELECT index, n, arg_max(name, priority) AS template, 'dailyindex-*-mycompany' AS daily_pattern
FROM indices LEFT JOIN templates ON index LIKE replace(pattern, '*', '%') GROUP BY index, n""",
    "bulk_action_lines": after(TARGETS)
    + f"SELECT event_id, {_action('index', False)} AS index_action, {_action('create', True)} AS create_action FROM targeted",
    "bulk_payload_lines": after()
    + f"""SELECT event_id, 0 AS line_no, '{{"index":{{"_index":"' || {DAILY} || '"}}}}' AS line FROM log_events
UNION ALL SELECT event_id, 1 AS line_no, props AS line FROM log_events""",
    "bulk_batches": after(BATCHED)
    + """SELECT batch_id, index, count(*) AS n, max(pos) AS last_pos, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM batched GROUP BY batch_id, index""",
    "bulk_durable_ids": after(LINES, offsets("file_name"))
    + """SELECT event_id, ((row_number() OVER (PARTITION BY file_name ORDER BY event_id) - 1) % 50)
  || '_' || md5(file_name || ':' || start_offset) AS doc_id FROM placed""",
    "bulk_request_bodies": after(
        BATCHED,
        """bodies AS (SELECT batch_id, count(*) AS n_events, string_agg('{"index":{"_index":"' || index || '"}}' || chr(10) || props, chr(10) ORDER BY pos)
  || chr(10) AS body FROM batched GROUP BY batch_id)""")
    + "SELECT batch_id, n_events, octet_length(encode(body)) AS n_bytes, md5(body) AS digest FROM bodies",
    "bulk_apply_index": after(
        "latest AS (SELECT user_id AS doc_id, arg_max(props, (ts, event_id)) AS payload FROM log_events GROUP BY user_id)")
    + """SELECT coalesce(l.doc_id, s.s_suppkey) AS doc_id, coalesce(l.payload, s.s_name) AS payload
FROM latest l FULL JOIN supplier s ON l.doc_id = s.s_suppkey""",
    "bulk_apply_create": after(
        "first AS (SELECT user_id AS doc_id, arg_min(props, (ts, event_id)) AS payload FROM log_events GROUP BY user_id)")
    + """SELECT coalesce(s.s_suppkey, f.doc_id) AS doc_id, coalesce(s.s_name, f.payload) AS payload
FROM first f FULL JOIN supplier s ON f.doc_id = s.s_suppkey""",
    "bulk_create_conflicts": after(
        "ranked AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM log_events)")
    + "SELECT event_id, user_id AS doc_id FROM ranked WHERE rn > 1 OR user_id IN (SELECT s_suppkey FROM supplier)",
    "sink_round_trip": after()
    + f"""SELECT {DAILY} AS index, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum,
  CAST(sum(length({document(message=False)}) + 2) AS BIGINT) AS n_chars FROM log_events GROUP BY 1""",
    "deliver_with_stub": after(BATCHED) + f"SELECT batch_id, pos, {STUB_STATUS} AS status FROM batched",
    "parse_bulk_response": after(BATCHED)
    + """SELECT batch_id, bool_or(status >= 300) AS errors, count(*) AS n_items, count(*) FILTER (status >= 300) AS n_failed
FROM batched GROUP BY batch_id""",
    "correlate_by_position": after(BATCHED)
    + f"SELECT event_id, batch_id, pos, status, {ERROR_TYPE} AS error_type FROM batched WHERE status >= 300",
    "correlate_by_id_prefix": after(BATCHED)
    + f"""SELECT batch_id, {DOC_ID} AS _id, CASE WHEN status = 429 AND event_id % 2 = 0 THEN NULL ELSE event_id END AS event_id, status,
  CASE status WHEN 400 THEN 'type: mapper_parsing_exception, reason: bad field' ELSE 'type: rejected, reason: Unknown' END AS error_text
FROM batched WHERE status >= 300""",
    "route_failures": after()
    + """SELECT route, event_id, status FROM log_events CROSS JOIN (VALUES ('self_log'), ('failure_sink')) r(route) WHERE status >= 300""",
    "handle_failed_batches": after(BATCHED, """failed AS (SELECT event_id, CASE WHEN (place // 50) % 7 = 3 THEN 503 ELSE status END AS status
  FROM batched WHERE status >= 300 OR (place // 50) % 7 = 3)""")
    + """SELECT route, event_id, CAST(status AS INTEGER) AS status, (SELECT count(*) FROM failed WHERE status = 503) > 0 AS stopped
FROM failed CROSS JOIN (VALUES ('self_log'), ('failure_sink')) r(route)
UNION ALL SELECT 'self_log', -1, 0, (SELECT count(*) FROM failed WHERE status = 503) > 0""",
    "clean_and_resend": after()
    + f"""SELECT event_id, {STUB_STATUS} AS first_status, CASE WHEN user_id % 89 = 0 THEN 429 ELSE 201 END AS second_status
FROM log_events WHERE {STUB_STATUS} >= 300""",
    "invalid_payload_dump": after(BATCHED)
    + """SELECT batch_id, 200 AS http_status, max(status) AS item_status, count(*) AS n_rejected,
  'invalid-200-' || md5(batch_id) || '.json' AS file_name,
  string_agg('{"index":{"_index":"' || index || '"}}' || chr(10) || props, chr(10) ORDER BY pos) AS payload
FROM batched WHERE status = 400 OR (status = 429 AND event_id % 2 = 1) GROUP BY batch_id""",
    "retry_schedule": """WITH attempts AS (
SELECT 't' || (user_id % 5) AS target, event_id AS attempt_no, ts, event_type <> 'error' AS success FROM events),
islands AS (
SELECT *, sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (PARTITION BY target ORDER BY ts, attempt_no) AS island FROM attempts),
runs AS (
SELECT target, attempt_no, CAST(sum(CASE WHEN success THEN 0 ELSE 1 END) OVER (PARTITION BY target, island ORDER BY ts, attempt_no) AS BIGINT)
  AS failures_in_a_row FROM islands)
SELECT target, attempt_no, failures_in_a_row,
  CASE WHEN failures_in_a_row <= 1 THEN 2.0::DOUBLE ELSE least(600.0, 5.0 * pow(2, failures_in_a_row - 1))::DOUBLE END AS delay_seconds
FROM runs""",
    "committed_position": after(
        LINES, offsets("file_name"),
        "stops AS (SELECT file_name, min(event_id) AS stop FROM placed WHERE status = 429 AND event_id % 2 = 1 GROUP BY file_name)")
    + """SELECT p.file_name AS file, coalesce(max(p.next_offset) FILTER (s.stop IS NULL OR p.event_id < s.stop), 0) AS committed
FROM placed p LEFT JOIN stops s ON p.file_name = s.file_name GROUP BY p.file_name""",
    "durable_rejects": after(
        f"""named AS (SELECT CASE event_id % 50 WHEN 0 THEN 'junk.txt' WHEN 1 THEN 'buf-2024x101.json' ELSE {FILE_NAME} END AS file_name,
  event_id, ts FROM log_events)""")
    + f"""SELECT 'rejected' AS kind, 'no date in file name ' || file_name AS detail, count(*) AS n FROM named WHERE event_id % 50 < 2 GROUP BY 2
UNION ALL SELECT 'sent', {DAILY}, count(*) FROM named WHERE event_id % 50 > 1 GROUP BY 2""",
    "diagnostics_summary": after(TARGETS)
    + """SELECT 'oversized' AS kind, CAST(octet_length(encode(props)) AS VARCHAR) AS detail, count(*) AS n
FROM log_events WHERE octet_length(encode(props)) > 9 GROUP BY 2
UNION ALL SELECT 'rejected', CAST(status AS VARCHAR), count(*) FROM log_events WHERE status >= 300 GROUP BY 2
UNION ALL SELECT 'not sent', target, count(*) FROM targeted WHERE NOT registration_ok AND recovery = 'FailSink' GROUP BY 2""",
    "retention_by_size": after(LINES, FILES,
                               """newest AS (SELECT file_name, row_number() OVER (ORDER BY file_date DESC, seq DESC) AS rank,
  CAST(sum(size_bytes) OVER (ORDER BY file_date DESC, seq DESC) AS BIGINT) AS running_bytes FROM files)""")
    + "SELECT file_name, rank, running_bytes, rank <= 2 OR running_bytes <= 50000 AS keep FROM newest",
    "retention_invalid_payloads": after(
        """dumps AS (SELECT strftime(ts, '%Y%m%d') AS day, status, sum(octet_length(encode(props))) AS size_bytes, max(ts) AS modified
  FROM log_events WHERE status >= 300 GROUP BY 1, 2)""",
        """newest AS (SELECT day, status, row_number() OVER (ORDER BY modified DESC) AS rank,
  CAST(sum(size_bytes) OVER (ORDER BY modified DESC) AS BIGINT) AS running_bytes FROM dumps)""")
    + "SELECT day, status, rank, running_bytes, running_bytes <= 800 AS keep FROM newest",
    "retention_by_count": after(LINES, FILES,
                                "newest AS (SELECT file_name, row_number() OVER (ORDER BY file_date DESC, seq DESC) AS rank FROM files)")
    + "SELECT file_name, rank, rank <= 31 AS keep FROM newest",
    "evict_shipped_files": after(
        f"rows AS (SELECT unnest([strftime(ts, '%Y%m%d'), event_type]) AS source, {FILE_NAME} AS file_name, octet_length(encode(props)) + 1 AS b FROM log_events)",
        "files AS (SELECT source, file_name, CAST(sum(b) AS BIGINT) AS size_bytes FROM rows GROUP BY 1, 2)",
        """per AS (SELECT source, count(*) AS n_files, min(file_name) AS first_file, max(file_name) AS last_file FROM files GROUP BY source)""",
        # What is left to send of the file where each source stands; a source without a known mark stands at the start of its first file.
        """state AS (SELECT p.*, source = 'signup' AS at_last,
  CASE WHEN source IN ('view', 'error') OR TRY_CAST(source AS BIGINT) % 3 = 0 THEN (SELECT size_bytes FROM files f WHERE f.source = p.source AND f.file_name = first_file)
    WHEN source = 'purchase' THEN (SELECT size_bytes - 5 FROM files f WHERE f.source = p.source AND f.file_name = first_file) ELSE 0 END AS unsent FROM per p)""")
    + """SELECT source, n_files, CASE WHEN unsent > 0 THEN 'wait' WHEN n_files > 2 THEN 'delete' WHEN n_files = 2 AND NOT at_last THEN 'advance' ELSE 'wait' END AS action,
  CASE WHEN unsent > 0 THEN NULL WHEN n_files > 2 THEN first_file WHEN n_files = 2 AND NOT at_last THEN last_file END AS file FROM state""",
    "rolling_buckets": after()
    + """SELECT 'Day' AS interval, strftime(ts, '%Y%m%d') AS bucket, count(*) AS n FROM log_events GROUP BY 2
UNION ALL SELECT 'Hour', strftime(ts, '%Y%m%d%H'), count(*) FROM log_events GROUP BY 2
UNION ALL SELECT 'Minute', strftime(ts, '%Y%m%d%H%M'), count(*) FROM log_events GROUP BY 2""",
    "rolling_size_sequence": after(
        """numbered AS (SELECT strftime(ts, '%Y%m%d') AS bucket, event_id, octet_length(encode(props)) AS b,
  row_number() OVER (PARTITION BY strftime(ts, '%Y%m%d') ORDER BY event_id) AS rn FROM log_events)""",
        """fold(bucket, event_id, rn, used, sequence) AS (
SELECT bucket, event_id, rn, CAST(b AS BIGINT), CAST(0 AS BIGINT) FROM numbered WHERE rn = 1
UNION ALL
SELECT n.bucket, n.event_id, n.rn, CASE WHEN f.used >= 500 THEN n.b ELSE f.used + n.b END,
  CASE WHEN f.used >= 500 THEN f.sequence + 1 ELSE f.sequence END
FROM fold f JOIN numbered n ON n.bucket = f.bucket AND n.rn = f.rn + 1)""", recursive=True)
    + "SELECT bucket, event_id, sequence FROM fold",
    "infer_field_types": after(FIELDS) + "SELECT path, type, count(*) AS n FROM fields GROUP BY path, type",
    "document_structured_fields": after()
    + """SELECT event_id, '"fields":{"User":{' || CASE WHEN event_id % 3 > 0 THEN '"_typeTag":"Account",' ELSE '' END || '"Id":' || user_id || ',"Last Type":"' || event_type
  || '"},"Steps":[' || event_id || ',null,2],"Seats":{"20":["a\\"b","' || level || '"],"3":[]}}' AS fields FROM log_events""",
    "document_custom_formatter": after()
    + """SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN '{"severity":"' || level || '","body":' || props || '}' END AS doc FROM log_events""",
    "resolve_caller_mapping": after(FIELDS) + """SELECT path, type, count(*) AS n, CASE WHEN type = 'string' THEN 'words' ELSE 'k' END AS rule,
  CASE WHEN type = 'string' THEN 'keyword' ELSE 'double' END AS mapped_type, CASE WHEN type = 'string' THEN 10 END AS raw_limit FROM fields GROUP BY path, type""",
    "infer_deep_fields": f"""SELECT path, type, n FROM (
  SELECT 'fields.three.l1.l2.l3' AS path, 'boolean' AS type, count(*) AS n FROM events
  UNION ALL SELECT 'fields.ten.l1.l2.l3.l4.l5.l6.l7.l8.l9.l10', CASE WHEN event_id % 7 = 0 THEN 'string' ELSE 'long' END, count(*) FROM events GROUP BY 2
  UNION ALL SELECT 'fields.none', 'object', count(*) FROM events
  UNION ALL SELECT 'fields.list', 'long', 2 * count(*) FROM events
  UNION ALL SELECT 'fields.list.a', 'double', count(*) FROM events)""",
    "first_mapping_wins": after(FIELDS, MAPPED) + "SELECT index, path, mapped_type FROM mapped",
    "mapping_conflicts": after(FIELDS, MAPPED)
    + """SELECT event_id, index, path, type, mapped_type FROM fields JOIN mapped USING (index, path) WHERE type <> mapped_type""",
    "resolve_dynamic_mapping": after(FIELDS, """found AS (SELECT path, type, count(*) AS n FROM (
  SELECT path, type FROM fields UNION ALL SELECT 'fields.' || (user_id % 15), 'long' FROM log_events) GROUP BY path, type)""")
    + r"""SELECT path, type, n,
  CASE WHEN regexp_matches(path, '^fields\.[\d+]$') THEN 'numerics_in_fields' WHEN type = 'string' THEN 'string_fields' END AS rule,
  CASE WHEN regexp_matches(path, '^fields\.[\d+]$') OR type = 'string' THEN 'text' ELSE type END AS mapped_type,
  CASE WHEN NOT regexp_matches(path, '^fields\.[\d+]$') AND type = 'string' THEN 256 END AS raw_limit FROM found""",
    "apply_explicit_mapping": after()
    + """SELECT event_id, message_template AS message, event_id % 7 <> 0 AS fits,
  CASE WHEN event_id % 7 <> 0 THEN CAST(-event_id AS INTEGER) END AS hresult FROM log_events""",
    "raw_keyword_field": "SELECT doc_id, CASE WHEN length(text) <= 256 THEN text END AS raw FROM documents",
    "field_count_limit": after()
    + f"""SELECT {DAILY} AS index, count(DISTINCT user_id) AS n_fields, count(DISTINCT user_id) > 120 AS over_limit FROM log_events GROUP BY 1""",
    "count_by_index": after()
    + f"SELECT {DAILY} AS index, count(*) AS n FROM log_events WHERE level_rank >= 2 GROUP BY 1",
    "flatten_exceptions": after(
        """links AS (SELECT event_id, event_id * 100 + d AS exc_id, CASE WHEN d + 1 < chain_len THEN event_id * 100 + d + 1 END AS inner_exc_id,
  'E' || (d % 3) AS class_name, 'm' || d AS message FROM (SELECT event_id, chain_len, unnest(range(chain_len)) AS d FROM log_events))""",
        """walk(event_id, exc_id, inner_exc_id, depth, class_name, message) AS (
SELECT event_id, exc_id, inner_exc_id, 0, class_name, message FROM links
WHERE exc_id NOT IN (SELECT inner_exc_id FROM links WHERE inner_exc_id IS NOT NULL)
UNION ALL
SELECT l.event_id, l.exc_id, l.inner_exc_id, w.depth + 1, l.class_name, l.message FROM walk w JOIN links l ON l.exc_id = w.inner_exc_id WHERE w.depth < 20)""",
        recursive=True)
    + "SELECT event_id, exc_id, depth, class_name, message FROM walk",
    "nest_exceptions": after()
    + f"""SELECT event_id, array_to_string(list_transform(range(chain_len), lambda d: '{{' || {EXCEPTION}), ',"innerException":')
  || repeat('}}', chain_len) AS exception FROM log_events WHERE chain_len > 0""",
    "exception_fields": after(DEPTHS)
    + f"SELECT event_id, CAST(d AS INTEGER) AS depth, '{{' || {EXCEPTION} || '}}' AS json FROM depths",
    "stack_trace_lines": after(DEPTHS)
    + """SELECT event_id, CAST(d AS INTEGER) AS depth, CASE WHEN d % 4 <> 3 THEN '["at A","at B"]' ELSE '[]' END AS stack_trace FROM depths""",
    "exceptions_by_method": after(DEPTHS)
    + """SELECT 'Asm' || (d % 2) AS assembly, '1.' || (d % 3) || '.0.0' AS version, 'Method' || (d % 4) AS method, 8 AS member_type, count(*) AS n
FROM depths WHERE d % 5 <> 4 GROUP BY 1, 2, 3""",
    "exceptions_table": after(DEPTHS)
    + """SELECT event_id, CAST(d AS INTEGER) AS depth, 'E' || (d % 3) AS class_name, 'm' || d AS message,
  CASE WHEN d % 2 = 0 THEN 'app' END AS source, CAST(-d AS INTEGER) AS hresult FROM depths""",
    "stream_direct": after() + PER_INDEX + " WHERE level_rank >= 2 GROUP BY 1",
    "stream_direct_requests": after()
    + f"""SELECT {DAILY} AS index, level, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(sum(CASE WHEN status >= 300 THEN 1 ELSE 0 END) AS BIGINT) AS n_failed
FROM log_events WHERE level_rank >= 2 GROUP BY 1, 2""",
    "stream_level_switch": after()
    + """SELECT minimum, level, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM log_events JOIN (VALUES ('Error', 4), ('Debug', 1)) m(minimum, rank)
ON level_rank >= rank GROUP BY 1, 2""",
    "stream_durable_restart": after() + PER_INDEX + " GROUP BY 1",
    "stream_late_events": after() + PER_INDEX + " GROUP BY 1",
}
# Lines of three sources in rolling files, steps of 200 lines per source, payloads of 50 lines of one file.
SOURCE_LINES = f"""lines AS (
SELECT 's' || (user_id % 3) AS source, {FILE_NAME} AS file_name, strftime(ts, '%Y%m%d') AS file_date, event_id % 2 AS seq, event_id, ts,
  octet_length(encode(event_id || '|' || props)) AS n_bytes FROM log_events)"""
STEPS = """stepped AS (
SELECT *, (row_number() OVER (PARTITION BY source ORDER BY file_date, seq, event_id) - 1) // 200 AS step FROM placed),
in_step AS (
SELECT *, row_number() OVER (PARTITION BY source, file_name, step ORDER BY event_id) - 1 AS place FROM stepped)"""
ORACLES |= {
    "stream_ship_ordered": after(SOURCE_LINES, offsets("source, file_name"), STEPS)
    + "SELECT source, file_name, event_id, start_offset, next_offset, place // 50 AS payload, CAST(place % 50 AS INTEGER) AS pos, step FROM in_step",
    "stream_durable_positions": after(
        SOURCE_LINES, offsets("source, file_name"), STEPS,
        """payloads AS (
SELECT *, dense_rank() OVER (PARTITION BY source ORDER BY step, file_date, seq, place // 50) - 1 AS payload, n_bytes <= 13 AS fits FROM in_step),
sent AS (
SELECT *, CAST(sum(CASE WHEN fits THEN 1 ELSE 0 END) OVER (PARTITION BY source, payload ORDER BY start_offset) AS BIGINT) - 1 AS pos FROM payloads),
reached AS (
SELECT source, max((file_date, seq, next_offset, file_name)) AS last FROM placed GROUP BY source)""")
    + f"""SELECT source, payload, pos, event_id, start_offset, next_offset, {DAILY} AS index,
  pos || '_' || md5(source || '/' || file_name || ':' || start_offset) AS doc_id, last[4] AS at_file, last[3] AS at_offset
FROM sent JOIN reached USING (source) WHERE fits""",
    "stream_retry_after_delay": f"""WITH retried AS ({ORACLES["retry_schedule"]})
SELECT r.target, r.attempt_no, e.props AS payload, r.failures_in_a_row, r.delay_seconds, true AS waited
FROM retried r JOIN events e ON e.event_id = r.attempt_no WHERE e.event_type = 'error'""",
    "stream_commit_once": after() + "SELECT level, count(*) AS n, count(*) AS n_events, CAST(sum(event_id) AS BIGINT) AS id_sum FROM log_events GROUP BY level",
    "stream_admission": ORACLES["admission_limit"],
    "stream_without_replays": after() + f"SELECT event_id, {DAILY} AS index FROM log_events",
}
# Number formats; a value has two decimals.
ORACLES |= {
    "render_number_formats": after("cents AS (SELECT event_id, user_id, CAST(value AS DECIMAL(18,2)) AS v FROM log_events)")
    + r"""SELECT event_id, CASE WHEN v < 0 THEN '-' ELSE '' END || format('{:,}', CAST(trunc(abs(v)) AS BIGINT)) || '.' ||
    regexp_replace(lpad(CAST(CAST(round((abs(v) - trunc(abs(v))) * 100) AS INTEGER) AS VARCHAR), 2, '0'), '(\d)0$', '\1') AS pattern,
  CASE WHEN CAST(v AS DECIMAL(18,1)) < 0 THEN '-' ELSE '' END ||
    regexp_replace(regexp_replace(CAST(CAST(abs(v) AS DECIMAL(18,1)) AS VARCHAR), '\.0$', ''), '^0', '') AS bare,
  format('{:,}', CAST(v * 100 AS BIGINT)) || '.0 %' AS percent,
  regexp_replace(format('{:.6E}', CAST(v AS DOUBLE)), 'E([+-])(\d\d)$', 'E\1' || '0' || '\2') AS exponent,
  printf('%04X', user_id) AS hexadecimal FROM cents""",
    "unsupported_formats": """SELECT '{Value:C2} {UserId:0.0} {When:HH:mm}' AS message_template, unnest(['C2', 'HH:mm']) AS format, n
FROM (SELECT count(*) AS n FROM events WHERE event_id % 5 = 0)""",
}
# What a caller brings.
ORACLES |= {
    "clean_rejected_documents": after(BATCHED)
    + r"""SELECT batch_id, pos, event_id, status,
  CASE WHEN status = 400 THEN regexp_replace(props, '"k":"s(\d+)"', '"k":\1') ELSE props || ' ' END AS doc
FROM batched WHERE status = 400 OR (status = 429 AND event_id % 2 = 1)""",
    "custom_serializers": after()
    + """SELECT event_id, '"' || event_type || '"' AS event_type,
  CASE WHEN user_id % 2 = 0 THEN '"user-' || user_id || '"' ELSE CAST(user_id AS VARCHAR) END AS user FROM log_events""",
}
# What is kept between runs.
ORACLES |= {
    "mapping_registry_updates": after(FIELDS, MAPPED)
    + """SELECT index, path, type, count(*) AS n, any_value(mapped_type) AS mapped_type, any_value(kinds) > 1 AS mixed
FROM fields JOIN mapped USING (index, path) JOIN (SELECT index, path, count(DISTINCT type) AS kinds FROM fields GROUP BY index, path) USING (index, path)
GROUP BY index, path, type""",
    "indexed_store_create": f"SELECT doc_id, payload, 'i' || (doc_id % 3) AS index FROM ({ORACLES['bulk_apply_create']})",
    "indexed_store_replace": f"SELECT doc_id, payload, 'i' || (doc_id % 3) AS index FROM ({ORACLES['bulk_apply_index']})",
    "match_many_templates": after("""templates AS (
SELECT 's' || s_suppkey AS name, 'logstash-2024.01.' || lpad(CAST(s_suppkey % 40 AS VARCHAR), 2, '0') || CASE WHEN s_suppkey % 3 = 0 THEN '*' ELSE '' END AS pattern,
  s_suppkey % 7 AS priority FROM supplier
UNION ALL VALUES ('a', 'logstash-*', 1), ('b', '*.01.1*', 6), ('c', 'dailyindex-*', 9))""", f"indices AS (SELECT DISTINCT {DAILY} AS index FROM log_events)",
        """best AS (SELECT index, arg_min(name, (-priority, name)) AS template FROM indices JOIN templates ON index LIKE replace(pattern, '*', '%') GROUP BY index)""")
    + f"SELECT event_id, {DAILY} AS index, template FROM log_events LEFT JOIN best ON index = {DAILY}",
}
# The same results by the ways of large tables.
ORACLES |= {f"{name}_ranged": ORACLES[name] for name in (
    "buffer_line_offsets", "admission_limit", "bulk_batches", "retry_schedule", "mapping_conflicts", "filter_level_switch_asof")}
