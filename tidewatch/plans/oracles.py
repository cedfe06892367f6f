"""Reference SQL for the registered queries, for an independent engine.

The SQL states the expected result from the fields the inputs are made of; it
never parses the documents the Spark queries parse.
"""

from __future__ import annotations

from tidewatch.plans import derived as d
from tidewatch.plans.queries import AFTER, AS_OF, DAY_BEFORE, KEEP_BYTES, KEEP_N, LINES_OF_FILE, PACK_BYTES, PACK_N, PARTS

_SPARSE = """'{"demo_seq":' || seq || ',"rule":{"level":' || level || '}}'"""
_ODD = "shape = 2"
_FULL = "shape IN (0, 3, 4, 5)"

# Expected finding columns of every alert copy, and the rejected messages.
_ALERTS = f"""WITH {d.MESSAGES},
alerts AS (
  SELECT CASE WHEN shape = 1 THEN '' ELSE mgr END AS manager,
         CASE WHEN shape = 1 THEN 'sha256:' || sha256({_SPARSE})
              WHEN {_ODD} THEN CAST(seq AS VARCHAR) ELSE own_id END AS alert_id,
         CASE WHEN shape IN (0, 4, 5) THEN date_trunc('milliseconds', ts) END AS ts,
         CASE WHEN {_ODD} THEN rid || '.0' WHEN {_FULL} THEN rid END AS rule_id,
         CAST(CASE WHEN shape = 4 THEN NULL ELSE level END AS INT) AS rule_level,
         CASE WHEN {_FULL} THEN descr END AS rule_description,
         CASE WHEN {_ODD} THEN 'one|2|True' WHEN {_FULL} THEN grps ELSE '' END AS rule_groups,
         CASE WHEN {_ODD} THEN 'T9999' WHEN {_FULL} THEN mitre ELSE '' END AS mitre_ids,
         CASE WHEN {_FULL} THEN tactics ELSE '' END AS mitre_tactics,
         CASE WHEN {_FULL} THEN aid END AS agent_id,
         CASE WHEN {_FULL} THEN aname END AS agent_name,
         CASE WHEN {_FULL} THEN aip END AS agent_ip,
         CASE WHEN {_FULL} THEN dec END AS decoder,
         CASE WHEN {_ODD} THEN 'True' WHEN shape = 5 THEN '/data/' || chr(65533) WHEN {_FULL} THEN log_path END AS location,
         CASE WHEN {_FULL} THEN ip END AS src_ip,
         CASE WHEN {_FULL} THEN login END AS src_user,
         '{d.TOPIC}' AS source_topic, source_partition, source_offset, seq
  FROM msgs WHERE shape <> 9),
junks AS (
  SELECT '{d.TOPIC}' AS source_topic, source_partition, source_offset,
         CASE junk WHEN 0 THEN 'not_json' WHEN 1 THEN 'not_object' WHEN 2 THEN 'null_value'
                   WHEN 3 THEN 'invalid_utf8' WHEN 5 THEN 'unencodable' ELSE 'not_json' END AS reject_reason,
         junk
  FROM msgs WHERE shape = 9),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY manager, alert_id
            ORDER BY source_topic, source_partition, source_offset) AS copy_no FROM alerts),
findings AS (SELECT * FROM ranked WHERE copy_no = 1),
messages AS (
  SELECT source_partition, source_offset, CASE WHEN copy_no = 1 THEN 'inserted' ELSE 'duplicate' END AS disposition,
         CAST(NULL AS VARCHAR) AS reject_reason FROM ranked
  UNION ALL SELECT source_partition, source_offset, 'rejected', reject_reason FROM junks)
"""
_COLUMNS = (
    "manager, alert_id, ts, rule_id, rule_level, rule_description, rule_groups, mitre_ids, "
    "mitre_tactics, agent_id, agent_name, agent_ip, decoder, location, src_ip, src_user, "
    "source_topic, source_partition, source_offset"
)
_TAG = """CASE WHEN rule_level BETWEEN 0 AND 4 THEN 'low' WHEN rule_level BETWEEN 5 AND 7 THEN 'med'
WHEN rule_level BETWEEN 8 AND 11 THEN 'HIGH' WHEN rule_level BETWEEN 12 AND 16 THEN 'CRIT' ELSE '?' END"""
_TAG0 = _TAG.replace("rule_level", "coalesce(rule_level, 0)")

_SEEN = _ALERTS + """, received AS (
  SELECT source_partition AS partition, source_offset AS "offset", seq FROM alerts),
seen AS (SELECT DISTINCT seq FROM received),
missing AS (
  SELECT n AS seq FROM (SELECT unnest(range(1, (SELECT max(seq) FROM seen) + 1)) AS n) AS all_numbers
  WHERE n NOT IN (SELECT seq FROM seen))
"""
_AUDIT = _SEEN + """, totals AS (
  SELECT count(*) AS received, count(DISTINCT seq) AS unique_seqs, max(seq) AS highest FROM received),
verdict AS (
  SELECT *, received - unique_seqs AS duplicates, highest - unique_seqs AS gaps FROM totals)
SELECT received, unique_seqs, highest, duplicates, gaps, gaps > 0 AS has_gaps,
       '[audit] received=' || received || ' unique=' || unique_seqs || ' highest=' || highest ||
       ' duplicates=' || duplicates || ' | ' ||
       CASE WHEN gaps = 0 THEN 'NO GAPS' ELSE '!! ' || gaps || ' GAP(S): [' ||
         (SELECT string_agg(CAST(seq AS VARCHAR), ', ' ORDER BY seq) FROM (SELECT seq FROM missing ORDER BY seq LIMIT 10) AS f)
         || ']' END AS line
FROM verdict"""

_DELIVERY = f"""WITH lines AS ({d.DELIVERIES}), checkpoints AS ({d.CHECKPOINTS}),
marked AS (SELECT *, outcome IN ('blank', 'malformed', 'undeliverable', 'delivered') AS settled FROM lines),
gaps AS (SELECT source, min(seq) FILTER (WHERE NOT settled) AS gap FROM marked GROUP BY source),
committed AS (
  SELECT m.source, max(seq) FILTER (WHERE gap IS NULL OR seq < gap) AS last_seq,
         count(*) FILTER (WHERE seq >= gap) AS in_flight
  FROM marked m JOIN gaps g ON m.source IS NOT DISTINCT FROM g.source GROUP BY m.source),
positions AS (
  SELECT c.source, CASE WHEN c.last_seq IS NULL THEN i.file_id ELSE m.file_id END AS file_id,
         coalesce(CASE WHEN c.last_seq IS NULL THEN i."offset" ELSE m.end_offset END, 0) AS "offset",
         in_flight
  FROM committed c LEFT JOIN marked m ON m.source IS NOT DISTINCT FROM c.source AND m.seq = c.last_seq
  LEFT JOIN checkpoints i ON i.source IS NOT DISTINCT FROM c.source
  UNION ALL SELECT source, file_id, "offset", 0 FROM checkpoints i
  WHERE NOT EXISTS (SELECT 1 FROM lines l WHERE l.source IS NOT DISTINCT FROM i.source))
"""
_QUEUE = f"WITH queue AS ({d.for_duckdb(d.QUEUE)})"


def _limited(rows: str, order: str, limit: int, size: int) -> str:
    first = f"AND n <= {limit}" if limit else ""
    return f"""{_QUEUE}, ranked AS (
      SELECT source, queue_key, size, row_number() OVER w AS n,
             sum(size) OVER (PARTITION BY source ORDER BY queue_key {order} ROWS UNBOUNDED PRECEDING) AS held
      FROM queue {rows} WINDOW w AS (PARTITION BY source ORDER BY queue_key {order})),
    kept AS (SELECT source, queue_key, size FROM ranked WHERE (held <= {size} OR n = 1) {first})
    """


_OUTCOME = f"""WITH attempts AS ({d.ATTEMPTS}), judged AS (
  SELECT batch_id, CASE WHEN status IS NULL THEN 'retryable' WHEN status BETWEEN 200 AND 299 THEN 'ok'
    WHEN status IN (401, 403) THEN 'unauthorized' WHEN status IN (408, 429) OR status >= 500 THEN 'retryable'
    ELSE 'permanent' END AS outcome FROM attempts),
outcomes AS (
  SELECT batch_id, outcome, CASE outcome WHEN 'ok' THEN 'ack' WHEN 'unauthorized' THEN 'halt'
    WHEN 'permanent' THEN 'dead' ELSE 'retry' END AS disposition FROM judged)
"""
_CONFIG = f"""WITH files AS ({d.FILES}), topics AS ({d.TOPICS}), rotated AS ({d.ROTATED}),
existing AS ({d.EXISTING}), lines AS ({d.ROUTED}),
routes AS (
  SELECT f.name, f.path, t.topic, r.rotated_glob FROM files f JOIN topics t ON f.name = t.name
  LEFT JOIN rotated r ON r.name = f.name WHERE f.path <> '' AND t.topic <> ''),
checks AS (
  SELECT 'files-' || nation AS name, path <> '' AS ok,
         name || CASE WHEN path = '' THEN ' has no path' ELSE ' set' END AS detail FROM files)
"""


def _owed(start_from: str) -> str:
    fresh = "0" if start_from == "beginning" else "size"
    return f"""WITH manifest AS ({d.MANIFESTS}), saved AS ({d.SAVED}),
live AS (SELECT * FROM manifest WHERE is_live),
rotated AS (SELECT * FROM manifest WHERE NOT is_live AND path NOT LIKE '%.gz' AND device = home_device),
state AS (
  SELECT s.source, s.file_id AS saved_id, s."offset" AS saved_offset, l.file_id AS live_id,
         coalesce(l.file_id = s.file_id AND l.resumable, false) AS in_live, r.mtime AS saved_mtime
  FROM saved s LEFT JOIN live l ON l.source = s.source
  LEFT JOIN rotated r ON r.source = s.source AND r.file_id = s.file_id AND r.resumable),
owed AS (
  SELECT l.source, l.path, l.file_id, CASE WHEN s.in_live THEN s.saved_offset
         WHEN s.source IS NOT NULL THEN 0 ELSE {fresh} END AS start_offset, 3 AS phase, l.mtime
  FROM live l LEFT JOIN state s ON s.source = l.source
  UNION ALL
  SELECT r.source, r.path, r.file_id, CASE WHEN r.file_id = s.saved_id THEN s.saved_offset ELSE 0 END,
         CASE WHEN r.file_id = s.saved_id THEN 1 ELSE 2 END, r.mtime
  FROM rotated r JOIN state s ON s.source = r.source
  WHERE NOT s.in_live AND s.saved_mtime IS NOT NULL
    AND ((r.file_id = s.saved_id AND r.resumable)
      OR (r.mtime > s.saved_mtime AND r.file_id <> s.saved_id AND r.file_id IS DISTINCT FROM s.live_id)))
"""


_HEX = "instr('0123456789abcdef', substr(digest, 17, 1)) - 1"
_JOURNAL = f"""WITH lines AS ({d.for_duckdb(d.JOURNAL)}),
hashed AS (SELECT *, sha256(cursor_text) AS digest FROM lines)
"""
_ENVELOPES = f"""WITH sent AS ({d.SENT}),
received AS (
  SELECT agent AS agent_id, id, CAST('2024-02-01' AS TIMESTAMP) AS sent_at, ts, event_type FROM sent WHERE NOT cut
  UNION ALL
  SELECT agent, id, CAST('2024-02-02' AS TIMESTAMP), ts, event_type FROM sent WHERE NOT cut AND sent_twice),
allowed AS (SELECT * FROM received WHERE agent_id NOT IN ({d.REVOKED})),
once AS (
  SELECT agent_id, id, ts, row_number() OVER (PARTITION BY agent_id ORDER BY ts, id) - 1 AS place
  FROM allowed WHERE sent_at = CAST('2024-02-01' AS TIMESTAMP))
"""

# Rows arrive in parts, by number; a copy in an earlier part wins.
_STREAMED = _ALERTS + f"""SELECT manager, alert_id, ts, rule_level, mitre_ids, agent_name, location FROM (
  SELECT *, row_number() OVER (PARTITION BY manager, alert_id
            ORDER BY CAST(floor(source_offset / 4) AS BIGINT) % {PARTS}, source_topic, source_partition, source_offset) AS arrival
  FROM alerts) AS a WHERE arrival = 1"""

_STATS = """SELECT count(*) AS consumed, count(*) FILTER (WHERE disposition = 'inserted') AS inserted,
count(*) FILTER (WHERE disposition = 'duplicate') AS duplicates,
count(*) FILTER (WHERE disposition = 'rejected') AS rejected FROM messages"""

_BATCH_STATS = _ALERTS + f"""SELECT part AS batch_id, count(*) AS consumed,
    count(*) FILTER (WHERE state = 1) AS inserted, count(*) FILTER (WHERE state > 1) AS duplicates,
    count(*) FILTER (WHERE state = 0) AS rejected FROM (
      SELECT CAST(floor(source_offset / 4) AS BIGINT) % {PARTS} AS part, row_number() OVER (PARTITION BY manager, alert_id
        ORDER BY CAST(floor(source_offset / 4) AS BIGINT) % {PARTS}, source_topic, source_partition, source_offset) AS state FROM alerts
      UNION ALL SELECT CAST(floor(source_offset / 4) AS BIGINT) % {PARTS}, 0 FROM junks) AS m GROUP BY part"""

_SEVERE = _ALERTS + f"""SELECT ts, rule_level, agent_name, rule_description, mitre_ids, alert_id
        FROM findings WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
        ORDER BY rule_level DESC NULLS FIRST, ts DESC, manager, alert_id LIMIT 20"""
_TECHNIQUE = _ALERTS + """SELECT agent_name, count(*) AS alerts, max(rule_level) AS worst FROM findings
        WHERE list_contains(string_split(mitre_ids, '|'), 'X34') GROUP BY agent_name"""

_ENTRIES = _JOURNAL + f"""SELECT substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-4' || substr(digest, 14, 3) || '-' ||
          substr('89ab', ({_HEX}) % 4 + 1, 1) || substr(digest, 18, 3) || '-' || substr(digest, 21, 12) AS id,
        'auth.journald' AS source, make_timestamp(micros) AS timestamp, cursor_text AS cursor
        FROM hashed WHERE kind NOT IN (1, 2, 3, 4, 5) AND facility IN ('4', '10')"""

ORACLES = {
    "normalize_alerts": _ALERTS + f"SELECT {_COLUMNS} FROM alerts",
    "rejects_by_reason": _ALERTS + """SELECT reject_reason, count(*) AS messages, min(source_offset) AS first_offset
        FROM junks GROUP BY reject_reason""",
    "reject_rows": _ALERTS + "SELECT source_topic, source_partition, source_offset, reject_reason FROM junks",
    "line_checks": _ALERTS + """SELECT partition, status, count(*) AS lines, max(source_offset) AS last_offset FROM (
        SELECT source_partition AS partition, source_offset, 'valid' AS status FROM alerts
        UNION ALL SELECT source_partition, source_offset,
          CASE WHEN junk IN (1, 5) THEN 'valid' ELSE 'malformed' END FROM junks) AS l GROUP BY partition, status""",
    "findings_first_copy": _ALERTS + f"SELECT {_COLUMNS} FROM findings",
    "message_dispositions": _ALERTS + "SELECT * FROM messages",
    "new_rows": _ALERTS + """, batch AS (
        SELECT manager, alert_id, min(source_offset) AS source_offset FROM alerts
        WHERE source_offset % 8 >= 4 GROUP BY manager, alert_id)
        SELECT * FROM batch WHERE NOT EXISTS (SELECT 1 FROM alerts a WHERE a.source_offset % 8 < 4
          AND a.manager = batch.manager AND a.alert_id = batch.alert_id)""",
    "top_severe_recent": _SEVERE,
    "layout_severe": _SEVERE,
    "layout_agent": _ALERTS + f"""SELECT manager, alert_id, ts FROM findings WHERE agent_name = 'node-2'
        AND ts > TIMESTAMP '{DAY_BEFORE}' AND ts <= TIMESTAMP '{AS_OF}'""",
    "technique_rollup": _ALERTS + """SELECT technique, count(*) AS alerts, count(DISTINCT agent_name) AS agents
        FROM (SELECT unnest(string_split(mitre_ids, '|')) AS technique, agent_name FROM findings WHERE mitre_ids <> '') AS t
        GROUP BY technique""",
    "table_audit": _ALERTS + """SELECT count(*) AS "rows", count(DISTINCT seq) AS unique_seqs,
        max(seq) - count(DISTINCT seq) AS gaps FROM findings""",
    "findings_counts": _ALERTS + """SELECT count(*) AS "rows", count(DISTINCT alert_id) AS distinct_alerts,
        min(source_offset) AS min_offset FROM findings""",
    "severity_tags": _ALERTS + f"SELECT {_TAG} AS tag, count(*) AS alerts, max(rule_level) AS max_level FROM findings GROUP BY 1",
    "alert_display": _ALERTS + f"""SELECT source_topic, source_partition, source_offset,
        printf('#%-6s %-4s L%-2s %-8s %-52s %s%s', CAST(seq AS VARCHAR), {_TAG0}, CAST(coalesce(rule_level, 0) AS VARCHAR),
          coalesce(agent_name, '?'), substr(coalesce(rule_description, '?'), 1, 52),
          CASE WHEN mitre_ids = '' THEN '-' ELSE replace(mitre_ids, '|', ', ') END,
          CASE WHEN again > 1 THEN '  [duplicate]' ELSE '' END) AS line
        FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY source_partition, source_offset) AS again FROM alerts) AS a""",
    "findings_sql": _TECHNIQUE,
    "layout_technique": _TECHNIQUE,
    "ingest_offsets": _ALERTS + f"""SELECT '{d.TOPIC}' AS topic, source_partition AS partition,
        max(source_offset) + 1 AS next_offset FROM messages GROUP BY source_partition""",
    "ingest_stats": _ALERTS + _STATS,
    "start_offsets": _ALERTS + f"""SELECT '{d.TOPIC}' AS topic, source_partition AS partition,
        coalesce(max(source_offset) FILTER (WHERE source_partition < 2 AND source_offset % 16 < 12) + 1, min(source_offset)) AS start_offset,
        source_partition < 2 AS resumed,
        coalesce(max(source_offset) FILTER (WHERE source_partition < 2 AND source_offset % 16 < 12), max(source_offset)) + 1 AS start_at_end
        FROM messages GROUP BY source_partition""",
    "stream_ingest_exactly_once": _STREAMED,
    "stream_ingest_new_checkpoint": _STREAMED,
    "stream_ingest_counters": _ALERTS + _STATS,
    "stream_ingest_restarts": _STREAMED,
    "stream_ingest_cadence": _BATCH_STATS,
    "ingest_stamps": _ALERTS + f"""SELECT CAST(floor(source_offset / 4) AS BIGINT) % {PARTS} AS batch_id, count(*) AS stamped
        FROM messages GROUP BY 1""",
    "stream_batch_counters": _BATCH_STATS,
    "stream_state_new_checkpoint": _STREAMED,
    "stream_state_counters": _BATCH_STATS,
    "stream_ingest_with_state": _STREAMED,
    "stream_state_offsets": _ALERTS + f"""SELECT '{d.TOPIC}' AS topic, source_partition AS partition,
        max(source_offset) + 1 AS next_offset FROM messages GROUP BY source_partition""",
    "stream_committed_prefix": _DELIVERY + 'SELECT source, file_id, "offset", in_flight FROM positions',
    "streaming_seq_audit": _AUDIT,
    "seq_audit": _AUDIT,
    "seq_gaps": _SEEN + "SELECT seq FROM missing",
    "seq_first_gaps": _SEEN + "SELECT seq FROM missing ORDER BY seq LIMIT 10",
    "seq_duplicate_marks": _SEEN + """SELECT partition, "offset", seq,
        row_number() OVER (PARTITION BY seq ORDER BY partition, "offset") > 1 AS is_duplicate FROM received""",
    "committed_prefix": _DELIVERY + 'SELECT source, file_id, "offset", in_flight FROM positions',
    "forwarder_stats": _DELIVERY + """, counters AS (
        SELECT source, count(*) FILTER (WHERE outcome IN ('delivered', 'failed', 'pending')) AS produced,
          count(*) FILTER (WHERE outcome = 'delivered') AS acked,
          count(*) FILTER (WHERE outcome IN ('undeliverable', 'failed')) AS failed,
          count(*) FILTER (WHERE outcome = 'malformed') AS parse_errors FROM lines GROUP BY source)
        SELECT p.source, coalesce(produced, 0) AS produced, coalesce(acked, 0) AS acked, coalesce(failed, 0) AS failed,
        coalesce(parse_errors, 0) AS parse_errors, in_flight, file_id, "offset"
        FROM positions p LEFT JOIN counters c ON p.source IS NOT DISTINCT FROM c.source""",
    "acknowledged_lines": _DELIVERY + "SELECT source, seq, outcome = 'delivered' AS settled FROM lines",
    "delivery_outcome": _OUTCOME + "SELECT batch_id, outcome, disposition FROM outcomes",
    "batch_pack": _limited("WHERE body NOT LIKE '{corrupt%'", "ASC", PACK_N, PACK_BYTES) + "SELECT * FROM kept",
    "batch_pack_by_bytes": _limited("", "ASC", 0, KEEP_BYTES) + "SELECT * FROM kept",
    "retention_keep": _limited("", "DESC", PACK_N, PACK_BYTES) + "SELECT * FROM kept",
    "retention_report": _limited("", "DESC", KEEP_N, KEEP_BYTES) + """SELECT q.source, k.kept, k.kept_bytes,
        q.events - k.kept AS dropped FROM (SELECT source, count(*) AS events FROM queue GROUP BY source) AS q
        JOIN (SELECT source, count(*) AS kept, CAST(sum(size) AS BIGINT) AS kept_bytes FROM kept GROUP BY source) AS k
        ON k.source IS NOT DISTINCT FROM q.source""",
    "queue_depth": _QUEUE + "SELECT source, count(*) AS events, CAST(sum(size) AS BIGINT) AS bytes FROM queue GROUP BY source",
    "fifo_order": _QUEUE + """SELECT source, queue_key,
        row_number() OVER (PARTITION BY source ORDER BY queue_key) AS place FROM queue""",
    "dead_letters": _OUTCOME + f""", queue AS ({d.for_duckdb(d.QUEUE)})
        SELECT source, queue_key, 'corrupt' AS why FROM queue WHERE body LIKE '{{corrupt%'
        UNION ALL SELECT source, queue_key, 'refused' FROM queue JOIN outcomes ON event_id = batch_id WHERE disposition = 'dead'""",
    "route_table": _CONFIG + "SELECT * FROM routes",
    "route_violations": _CONFIG + """SELECT name, 'missing_path' AS problem FROM files WHERE path = ''
        UNION ALL SELECT name, 'missing_topic' FROM files WHERE name NOT IN (SELECT name FROM topics WHERE topic <> '')
        UNION ALL SELECT name, 'unknown_rotated' FROM rotated WHERE name NOT IN (SELECT name FROM files)
        UNION ALL SELECT name, 'empty_rotated' FROM rotated WHERE name IN (SELECT name FROM files) AND rotated_glob = ''""",
    "route_lines": _CONFIG + "SELECT o_orderkey, source, topic FROM lines JOIN routes ON name = source",
    "missing_topics": _CONFIG + "SELECT DISTINCT topic FROM routes WHERE topic NOT IN (SELECT topic FROM existing)",
    "check_rollup": _CONFIG + """SELECT name, bool_and(ok) AS ok, count(*) FILTER (WHERE NOT ok) AS failed,
        count(*) AS parts FROM checks GROUP BY name""",
    "check_details": _CONFIG + """SELECT name, all_ok AS ok, detail FROM (
        SELECT *, bool_and(ok) OVER (PARTITION BY name) AS all_ok FROM checks) AS c WHERE all_ok OR NOT ok""",
    "check_report": _CONFIG + """SELECT name, bool_and(all_ok) AS ok, string_agg(detail, '; ' ORDER BY detail) AS report FROM (
        SELECT *, bool_and(ok) OVER (PARTITION BY name) AS all_ok FROM checks) AS c WHERE all_ok OR NOT ok GROUP BY name""",
    "rotating_ndjson_follow": "SELECT event_id, user_id FROM events",
    "follow_rounds": "SELECT event_id, user_id FROM events",
    "open_lines_withheld": f"""SELECT event_id, user_id FROM events
        WHERE event_id NOT IN (SELECT max(event_id) FROM events GROUP BY CAST(floor(event_id / {LINES_OF_FILE}) AS BIGINT))""",
    "open_lines_after_rotation": "SELECT event_id, user_id FROM events",
    "rotating_ndjson_bounded": "SELECT event_id, user_id FROM events",
    "line_boundaries": f"""WITH positions AS ({d.POSITIONS.replace(" AS offset", ' AS "offset"')}) SELECT event_id,
        "offset" <= size AND ("offset" IN (0, size) OR byte_before = 'nl') AS resumes FROM positions""",
    "stripped_lines": "SELECT event_id, props AS value FROM events",
    "ndjson_round_trip": "SELECT event_id, event_type, props FROM events",
    "queue_keys": """SELECT event_id, lpad(CAST(epoch_us(ts) * 1000 AS VARCHAR), 20, '0') || '-ev' || event_id AS queue_key FROM events""",
    "queue_folder": "SELECT 'q' AS source, CAST(event_id AS INT) AS event_id FROM events",
    "ledger_view": _ALERTS + "SELECT agent_name, count(*) AS alerts FROM findings GROUP BY agent_name",
    "owed_generations": _owed("end") + "SELECT source, path, file_id, start_offset, phase FROM owed",
    "lost_ranges": _owed("end") + """SELECT source, saved_id AS file_id, saved_offset AS lost_after_offset,
        CASE WHEN live_id IS NULL THEN 'no_live_file' WHEN live_id = saved_id THEN 'not_a_line_boundary'
             ELSE 'generation_missing' END AS reason FROM state WHERE NOT in_live AND saved_mtime IS NULL""",
    "drain_order": _owed("beginning") + """SELECT source, file_id, start_offset,
        row_number() OVER (PARTITION BY source ORDER BY phase, mtime, file_id) AS position FROM owed""",
    "rotated_candidates": _owed("end") + "SELECT source, path FROM rotated",
    "line_offsets": f"""WITH lines AS ({d.FILE_LINES}) SELECT source, file_id, line_no,
        CAST(sum(length(value) + 1) OVER (PARTITION BY source, file_id ORDER BY line_no) AS BIGINT) AS end_offset FROM lines""",
    "rotating_ndjson_scan": """SELECT event_id, user_id,
        CAST(length('{"event_id":' || event_id || ',"user_id":' || user_id || '}') AS BIGINT) AS bytes FROM events""",
    "journal_events": _JOURNAL + f"""SELECT substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-4' || substr(digest, 14, 3) || '-' ||
          substr('89ab', ({_HEX}) % 4 + 1, 1) || substr(digest, 18, 3) || '-' || substr(digest, 21, 12) AS id,
        'auth.journald' AS source, make_timestamp(micros) AS timestamp, cursor_text AS cursor,
        facility AS syslog_facility, CASE WHEN comm <> '' THEN comm END AS comm,
        CASE WHEN NOT pid_is_number THEN '42' END AS pid, message
        FROM hashed WHERE kind NOT IN (1, 2, 3, 4, 5) AND facility IN ('4', '10')""",
    "journal_resume": _ENTRIES,
    "journal_after": _ENTRIES + f" AND event_id > {AFTER}",
    "journal_rejects": _JOURNAL + """SELECT event_id, CASE kind WHEN 3 THEN 'missing_cursor' WHEN 4 THEN 'bad_timestamp'
        ELSE 'not_json' END AS reject_reason FROM lines WHERE kind IN (1, 3, 4, 5)""",
    "ingest_envelopes": _ENVELOPES + 'SELECT agent_id, id, sent_at, ts AS timestamp, event_type AS kind FROM allowed',
    "unique_events": _ENVELOPES + """SELECT agent_id, id, CAST('2024-02-01' AS TIMESTAMP) AS sent_at, agent_id AS host FROM once""",
    "envelope_rejects": _ENVELOPES + """SELECT DISTINCT agent, block, copy, 'bad_body' AS reject_reason FROM (
        SELECT agent, block, CAST(1 AS INT) AS copy FROM sent WHERE cut
        UNION ALL SELECT agent, block, 2 FROM sent WHERE cut AND sent_twice) AS b""",
    "envelope_batches": _ENVELOPES + """SELECT agent_id, CAST(floor(place / 100) AS BIGINT) AS batch_no, CAST(count(*) AS INT) AS events,
        arg_min(id, place) AS first_id, arg_max(id, place) AS last_id FROM once GROUP BY 1, 2""",
    "envelope_files": _ENVELOPES + "SELECT agent_id, id, ts AS timestamp FROM once",
}
