"""For each registered query, the same result in plain SQL on the sample tables."""

from __future__ import annotations

_TOPIC = """CASE event_id % 9 WHEN 0 THEN 'RawEvents' WHEN 1 THEN 'PassportEvents' WHEN 2 THEN 'SessionsRes'
  WHEN 3 THEN 'RecommendationReq' WHEN 4 THEN 'RecommendationRes' WHEN 5 THEN 'ContextualizedEvents'
  WHEN 6 THEN 'ProfiledEvents' WHEN 7 THEN 'RecomendationsRnow' ELSE 'RecomendationsSend' END"""

_VALUE = """concat('{"eid":"', CASE event_type WHEN 'click' THEN 'upsert_session' WHEN 'view' THEN 'track_event'
    ELSE event_type END, '"',
  CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 7 = 0 THEN ',"passport":{}'
    ELSE concat(',"passport":{"sid":"s', CAST(user_id % 50 AS VARCHAR), '"}') END,
  CASE WHEN event_id % 11 = 0 THEN '' ELSE concat(',"userId":"u', CAST(user_id AS VARCHAR), '"') END, '}')"""

_DIRTY_VALUE = f"""CASE WHEN event_id % 101 = 0 THEN 'not json' WHEN event_id % 103 = 0 THEN '{{"eid":5}}'
  WHEN event_id % 107 = 0 THEN '{{"passport":null}}' ELSE {_VALUE} END"""

_REASON = """CASE WHEN event_id % 101 = 0 THEN 'MALFORMED_JSON' WHEN event_id % 103 = 0 THEN 'EID_NOT_STRING'
  WHEN event_id % 107 = 0 THEN 'PASSPORT_NULL' END"""


def _messages(value: str = _VALUE, rows: str = "events") -> str:
    return f"""m AS (SELECT {_TOPIC} AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id // 9 AS "offset",
  ts AS "timestamp", {value} AS value, {_REASON} AS reason FROM {rows})"""


def _events(kind: str = "CAST(NULL AS VARCHAR)", sid: str = "$.passport.sid") -> str:
    return f"""e AS (SELECT topic, "partition", "offset", "timestamp" AS arrived, value->>'$.eid' AS eid,
  CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS name, coalesce(value->>'{sid}', '') AS "sessionId",
  CAST(NULL AS VARCHAR) AS "timestamp", {kind} AS type, value->>'$.userId' AS "userId" FROM m)"""


_M = "WITH " + _messages()
_E = f"{_M}, {_events()}"
_TAG = """CASE topic WHEN 'RawEvents' THEN 'rawEvent' WHEN 'PassportEvents' THEN 'passportEvent'
  WHEN 'SessionsRes' THEN 'sessionRes' END"""
_TAGGED = f"{_M}, {_events(_TAG)}"
_DIRTY_EVENTS = f"WITH {_messages(rows='events WHERE reason IS NULL')}, {_events()}"

_SECOND, _MINUTE, _HOUR, _DAY = 1_000_000, 60_000_000, 3_600_000_000, 86_400_000_000


def _starts(rows: str, ts: str, window: int, slide: int) -> str:
    """Each row of ``rows`` with the start, in microseconds, of every window it falls in."""
    if slide > window:
        return f"""k AS (SELECT *, (epoch_us({ts}) // {slide} + 1) * {slide} - {window} AS st FROM {rows}
  WHERE epoch_us({ts}) >= (epoch_us({ts}) // {slide} + 1) * {slide} - {window})"""
    copies = -(-window // slide)
    return f"""k AS (SELECT * FROM (SELECT x.*, (epoch_us({ts}) // {slide}) * {slide} - i * {slide} AS st
    FROM {rows} x, range(0, {copies}) r(i)) WHERE epoch_us({ts}) < st + {window})"""


def _span(window: int) -> str:
    return f"make_timestamp(st) AS window_start, make_timestamp(st + {window}) AS window_end"


_KINDS = """count(*) FILTER (eid = 'upsert_session') AS upsert_session,
  count(*) FILTER (eid = 'track_event') AS track_event"""


def _counts(prefix: str, rows: str, ts: str, window: int, slide: int, by: str = "", kinds: bool = False) -> str:
    key = f"{by}, " if by else ""
    more = f", {_KINDS}" if kinds else ""
    return f"""{prefix}, {_starts(rows, ts, window, slide)}
SELECT {key}{_span(window)}, count(*) AS count{more} FROM k GROUP BY {key}st"""


_COUNT_BY_KIND = _counts(_E, "e", "arrived", 10 * _HOUR, 4 * _HOUR, "topic", True)


def _concat(window: int, slide: int, segment: int = 1_000) -> str:
    return f"""{_M}, {_starts("m", '"timestamp"', window, slide)}
SELECT topic, {_span(window)}, "partition", "offset" // {segment} AS segment, count(*) AS n,
  string_agg(value, '/n' ORDER BY "offset") AS value FROM k GROUP BY topic, st, 4, 5"""


def _archive(window: int, slide: int, columns: str = '"partition", "offset", value') -> str:
    return f"""{_M}, {_starts("m", '"timestamp"', window, slide)}
SELECT topic, strftime(make_timestamp(st + {window}), '%Y-%m-%d') AS dt,
  CAST((st + {window}) // 1000 AS BIGINT) AS window_end_ms, {columns} FROM k"""


_TOKENS = """SELECT t.value AS value, count(*) AS count
FROM (SELECT unnest(CASE WHEN {c} = '' THEN [''] WHEN rtrim({c}, ' ') = '' THEN CAST([] AS VARCHAR[])
  ELSE string_split(rtrim({c}, ' '), ' ') END) AS value FROM {t} WHERE {c} IS NOT NULL) t GROUP BY t.value"""

_RANGES = """r AS (SELECT topic, "partition", min("offset") AS from_offset, max("offset") + 1 AS until_offset,
  count(*) AS n FROM m GROUP BY topic, "partition")"""

_EVENT_SOURCE = """concat('{"eid":', to_json(eid), ',"email":null,"name":null,"sessionId":', to_json("sessionId"),
  ',"timestamp":null,"type":null,"userId":', coalesce(CAST(to_json("userId") AS VARCHAR), 'null'), '}')"""

_ISLANDS = """i AS (SELECT topic, "partition", min("offset") AS from_offset, max("offset") + 1 AS until_offset,
  count(*) AS n FROM (SELECT *, "offset" - row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS g FROM m)
  GROUP BY topic, "partition", g)"""

# Each message with the first and last window it is in (x), and the windows at which something changes (r).
_CHANGES = """x AS (SELECT topic, length(value) AS chars, (epoch_us("timestamp") - {window}) // {slide} + 1 AS k0,
    epoch_us("timestamp") // {slide} AS k1 FROM m),
  r AS (SELECT topic, k, lead(k) OVER (PARTITION BY topic ORDER BY k) AS until_k FROM
    (SELECT topic, k0 AS k FROM x UNION SELECT topic, k1 + 1 FROM x))"""


def _answers(join: str) -> str:
    side = "SELECT \"userId\", arrived, \"partition\", \"offset\" FROM e WHERE topic = '{}'"
    return f"""{_E}, a AS ({side.format("RecommendationReq")}), b AS ({side.format("RecommendationRes")})
SELECT a."userId", a.arrived AS request_at, a."partition" AS request_partition, a."offset" AS request_offset,
  b.arrived AS response_at, b."partition" AS response_partition, b."offset" AS response_offset
FROM a {join} b ON a."userId" = b."userId" AND b.arrived BETWEEN a.arrived AND a.arrived + INTERVAL 12 HOUR"""


SQL: dict[str, str] = {
    "message_values": f'{_M} SELECT topic, "partition", "offset", value FROM m',
    "messages_by_topic": f"{_M} SELECT topic, count(*) AS n FROM m GROUP BY topic",
    "topic_subset": f"""{_M} SELECT CAST(NULL AS VARCHAR) AS key, value, topic, "partition", "offset", "timestamp"
FROM m WHERE topic IN ('RawEvents', 'PassportEvents', 'SessionsRes')""",
    "first_messages": f'''{_M} SELECT topic, "partition", "offset", value FROM m
ORDER BY topic, "partition", "offset" LIMIT 10''',
    "offset_ranges": f"{_M}, {_RANGES} SELECT * FROM r",
    "offsets_encoded": f"""{_M}, {_RANGES} SELECT topic,
  string_agg(concat("partition", ':', until_offset), ',' ORDER BY "partition") AS offsets FROM r GROUP BY topic""",
    "offsets_roundtrip": f'{_M}, {_RANGES} SELECT topic, "partition", until_offset AS "offset" FROM r',
    "resume_from": f"""{_M}, p AS (SELECT topic, "partition", max("offset") + 1 AS start FROM m
  WHERE "timestamp" < TIMESTAMP '2024-01-16' GROUP BY topic, "partition")
SELECT m.topic, m."partition", m."offset", m.value FROM m LEFT JOIN p USING (topic, "partition")
WHERE start IS NULL OR "offset" >= start""",
    "event_projection": f"{_E} SELECT * FROM e",
    "event_projection_flat": f"{_M}, {_events(chr(39) + 'flat' + chr(39), '$.sid')} SELECT * FROM e",
    "event_projection_dirty": f"{_DIRTY_EVENTS} SELECT * FROM e",
    "event_quarantine": f"""WITH {_messages(_DIRTY_VALUE)}
SELECT value, topic, "partition", "offset", "timestamp", reason FROM m WHERE reason IS NOT NULL""",
    "event_type_tag": f"{_TAGGED} SELECT * FROM e",
    "event_of_kind": f"{_E} SELECT * FROM e WHERE eid IN ('upsert_session', 'track_event')",
    "event_render": f"""{_TAGGED} SELECT topic, "partition", "offset",
  concat('{{"eid":', to_json(eid), ',"sessionId":', to_json("sessionId"), ',"name":null,"type":',
    coalesce(CAST(to_json(type) AS VARCHAR), 'null'), ',"userId":',
    coalesce(CAST(to_json("userId") AS VARCHAR), 'null'), '}}') AS line FROM e""",
    "event_render_compat": f"""{_TAGGED} SELECT topic, "partition", "offset",
  concat('{{"eid":"', coalesce(eid, 'null'), '","sessionId":"', coalesce("sessionId", 'null'),
    '","name":"null","type":"', coalesce(type, 'null'), '","userId":"', coalesce("userId", 'null'), '"}}') AS line
FROM e""",
    "events_sql_view": f'{_E} SELECT eid, count(*) AS n, count("userId") AS n_users FROM e GROUP BY eid',
    "count_sliding": _counts(_M, "m", '"timestamp"', 10 * _SECOND, 4 * _SECOND),
    "count_by_kind": _COUNT_BY_KIND,
    "count_tumbling": _counts(_E, "e", "arrived", _DAY, _DAY, kinds=True),
    "count_sampled": _counts(_M, "m", '"timestamp"', 2 * _HOUR, 6 * _HOUR),
    "count_dense": f"""{_M}, c AS (SELECT topic, (epoch_us("timestamp") // {5 * _MINUTE}) * {5 * _MINUTE} AS st,
    count(*) AS n FROM m GROUP BY ALL),
  s AS (SELECT topic, unnest(range(min(st), max(st) + 1, {5 * _MINUTE})) AS st FROM c GROUP BY topic)
SELECT topic, {_span(5 * _MINUTE)}, coalesce(n, 0) AS count FROM s LEFT JOIN c USING (topic, st)""",
    "count_dense_by_type": f"""{_TAGGED}, c AS (SELECT type, (epoch_us(arrived) // {5 * _MINUTE}) * {5 * _MINUTE} AS st,
    count(*) AS n FROM e GROUP BY ALL),
  s AS (SELECT type, unnest(range(min(st), max(st) + 1, {5 * _MINUTE})) AS st FROM c GROUP BY type)
SELECT s.type, {_span(5 * _MINUTE)}, coalesce(n, 0) AS count
FROM (SELECT s.type, s.st, n FROM s LEFT JOIN c ON s.st = c.st AND s.type IS NOT DISTINCT FROM c.type) s""",
    "count_dense_sliding": f"""{_E}, {_starts("e", "arrived", 10 * _MINUTE, 4 * _MINUTE)},
  c AS (SELECT st, count(*) AS n, {_KINDS} FROM k GROUP BY st),
  s AS (SELECT unnest(range(min(st), max(st) + 1, {4 * _MINUTE})) AS st FROM c)
SELECT {_span(10 * _MINUTE)}, coalesce(n, 0) AS count, coalesce(upsert_session, 0) AS upsert_session,
  coalesce(track_event, 0) AS track_event FROM s LEFT JOIN c USING (st)""",
    "count_labels": f"""WITH labelled AS ({_counts(_E, "e", "arrived", 10 * _HOUR, 4 * _HOUR, kinds=True)})
SELECT window_start, window_end, concat('Total: ', count) AS count,
  concat('Eventos RawEvent: ', upsert_session) AS upsert_session,
  concat('Eventos track_device: ', track_event) AS track_event FROM labelled""",
    "token_counts": _TOKENS.format(c="text", t="documents"),
    "token_counts_messages": f"{_M} {_TOKENS.format(c='value', t='m')}",
    "concat_tumbling": _concat(30 * _SECOND, 30 * _SECOND),
    "concat_daily": _concat(_DAY, _DAY),
    "concat_sliding": _concat(10 * _HOUR, 4 * _HOUR),
    "concat_sampled": _concat(2 * _HOUR, 6 * _HOUR),
    "concat_segments": _concat(_DAY, _DAY, 32),
    "archive_rows": _archive(10 * _HOUR, 4 * _HOUR),
    "archive_paths": f"""WITH a AS ({_archive(_HOUR, _HOUR)})
SELECT concat('/archive/', topic, '/', replace(dt, '-', '/'), '/', window_end_ms) AS path, count(*) AS n
FROM a GROUP BY ALL""",
    "bulk_documents": """SELECT concat('{"index":{"_index":"library","_id":"', doc_id, '"}}') AS action,
  CAST(to_json(struct_pack(doc_id := doc_id, text := text, lang := lang, source := source, n_chars := n_chars))
    AS VARCHAR) AS source FROM documents""",
    "bulk_event_documents": f"""{_E} SELECT concat('{{"index":{{"_index":"events","_type":"event","_id":"', topic, '-',
  "partition", '-', "offset", '"}}}}') AS action, {_EVENT_SOURCE} AS source FROM e""",
    "bulk_map_documents": """SELECT concat('{"index":{"_index":"spark","_type":"docs","_id":"', event_id, '"}}')
    AS action, concat('{"user":"', user_id, '","kind":', to_json(event_type), ',"props":', to_json(props), '}') AS source
FROM events""",
    "raw_dump": f"{_M} SELECT concat('(null,', value, ')') AS line FROM m",
    "token_counts_stream": _TOKENS.format(c="text", t="documents"),
    "stream_equals_batch": _COUNT_BY_KIND,
    "concat_stream": f"""{_M}, {_starts("m", '"timestamp"', _DAY, _DAY)}
SELECT topic, {_span(_DAY)}, "partition", "offset" // 32 AS segment, count(*) AS n,
  string_agg(value, '/n' ORDER BY "offset") AS value FROM k GROUP BY topic, st, "partition", "offset" // 32""",
    "archive_stream": _archive(10 * _HOUR, 4 * _HOUR),
    "archive_text_stream": _archive(_DAY, _DAY, "value"),
    "events_parquet_roundtrip": f"""{_DIRTY_EVENTS} SELECT eid, email, name, "sessionId", "timestamp", type, "userId",
  topic, strftime(arrived, '%Y-%m-%d') AS dt FROM e""",
    "bulk_stream": f"""{_E} SELECT unnest([concat('{{"index":{{"_index":"events","_id":"', topic, '-', "partition", '-',
    "offset", '"}}}}'), concat('{{"eid":', to_json(eid), ',"sessionId":', to_json("sessionId"),
    coalesce(concat(',"userId":' || CAST(to_json("userId") AS VARCHAR)), ''), '}}')]) AS value FROM e""",
    "dump_stream": f"{_M} SELECT concat('(null,', value, ')') AS line FROM m",
    "ledger_stream": f'{_M}, {_RANGES} SELECT topic, "partition", until_offset AS "offset" FROM r',
    "restart_no_duplicates": _archive(_DAY, _DAY),
    "offset_islands": f"{_M}, {_ISLANDS} SELECT * FROM i",
    "offset_gaps": f"""{_M}, g AS (SELECT topic, "partition", "offset" + 1 AS from_offset,
    lead("offset") OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS until_offset FROM m)
SELECT *, until_offset - from_offset AS n FROM g WHERE until_offset > from_offset""",
    "safe_offsets": f"""{_M}, {_ISLANDS}
SELECT topic, "partition", arg_min(until_offset, from_offset) AS "offset" FROM i GROUP BY ALL""",
    "ledger_islands_stream": f"{_M}, {_ISLANDS} SELECT * FROM i",
    "window_runs": f"""{_M}, {_CHANGES.format(window=_DAY, slide=_SECOND)}
SELECT r.topic, make_timestamp(r.k * {_SECOND}) AS first_start, make_timestamp((until_k - 1) * {_SECOND}) AS last_start,
  until_k - r.k AS windows, count(*) AS count, sum(chars)::BIGINT AS chars
FROM r JOIN x ON r.topic = x.topic AND r.k BETWEEN x.k0 AND x.k1 GROUP BY r.topic, r.k, until_k""",
    "window_sums": f"""WITH {_messages()}, {_starts("m", '"timestamp"', 10 * _MINUTE, 4 * _MINUTE)}
SELECT topic, {_span(10 * _MINUTE)}, count(*) AS count, sum(length(value))::BIGINT AS chars FROM k GROUP BY topic, st""",
    "cogroup_topics": f"""{_E}, s AS (SELECT "userId", "offset" // 64 AS segment, topic, eid, "partition", "offset"
    FROM e WHERE topic IN ('RecommendationReq', 'RecommendationRes')),
  a AS (SELECT "userId", segment, count(*) AS n, string_agg(eid, ',' ORDER BY "partition", "offset") AS v FROM s
    WHERE topic = 'RecommendationReq' GROUP BY ALL),
  b AS (SELECT "userId", segment, count(*) AS n, string_agg(eid, ',' ORDER BY "partition", "offset") AS v FROM s
    WHERE topic = 'RecommendationRes' GROUP BY ALL)
SELECT CASE WHEN a.n IS NULL THEN b."userId" ELSE a."userId" END AS "userId", coalesce(a.segment, b.segment) AS segment,
  coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right, coalesce(a.v, '') AS left_values, coalesce(b.v, '') AS right_values
FROM a FULL JOIN b ON a."userId" IS NOT DISTINCT FROM b."userId" AND a.segment = b.segment""",
    "running_sessions_stream": f"""{_E}, o AS (SELECT *, row(arrived, concat(topic, ':', "partition", ':',
    lpad(CAST("offset" AS VARCHAR), 20, '0'))) AS place FROM e)
SELECT "sessionId", count(*) AS n, min(arrived) AS first_at, arg_min(eid, place) AS first, max(arrived) AS last_at,
  arg_max(eid, place) AS last FROM o GROUP BY ALL""",
    "answers_inner": _answers("JOIN"),
    "answers_outer": _answers("LEFT JOIN"),
    "answers_inner_stream": _answers("JOIN"),
    "answers_outer_stream": _answers("LEFT JOIN"),
    "redelivered_stream": f'{_M} SELECT topic, "partition", "offset", value FROM m',
    "archive_untimed_stream": f"""{_M} SELECT topic, "partition", "offset", value,
  CASE WHEN "offset" % 7 = 0 THEN 'NO_TIME' END AS reason FROM m""",
}
SQL["archive_compacted_stream"] = SQL["restart_no_duplicates"]
SQL["progress_stream"] = f"""{_M} SELECT count(*) + 9 AS n, CAST(0 AS BIGINT) AS late FROM m"""
SQL["count_dense_stream"] = SQL["count_dense_sliding"]
SQL["concat_append_stream"] = SQL["concat_stream"]
