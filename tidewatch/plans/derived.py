"""Inputs for the registered queries, derived from the given tables.

Each input is one SQL text that both engines can run, apart from a few function
names. Nothing here orders or numbers rows: every value follows from its own
row. Only large tables of events are dealt out anew before records are made of
them, so that a task's share does not grow with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.functions.json_text import computed_once
from tidewatch.operators.shuffles import dealt

TOPIC = "security-alerts"
# Events whose records one task makes; a record takes some thirty times the bytes of its event.
TASK_EVENTS = 100_000
# Journal entries of an export file, about, where there are many.
TASK_ENTRIES = 500_000

# seq, kind (0 first delivery, 1 re-delivery, 2 junk), shape of the document and
# the fields it is made of. seq has gaps; offsets have holes, as in a compacted
# log. Shapes: 1 no identity, 2 odd types, 3 time without zone, 4 level too high,
# 5 an escaped NUL in the location.
MESSAGES = f"""
numbered AS (
  SELECT event_id + 1 AS seq, ts, user_id, event_type, CAST((event_id * 5 + user_id) % 23 AS INT) AS cls,
         CAST(user_id % 3 AS INT) AS source_partition
  FROM events WHERE (event_id + 1) % 53 <> 0),
copies AS (
  SELECT numbered.*, 0 AS kind FROM numbered
  UNION ALL SELECT numbered.*, 1 AS kind FROM numbered WHERE seq % 41 = 0
  UNION ALL SELECT numbered.*, 2 AS kind FROM numbered WHERE seq % 97 = 0),
msgs AS (
  SELECT copies.*, (seq + 20 * kind) * 4 + kind AS source_offset,
         CASE WHEN kind = 2 THEN 9 WHEN seq % 31 = 0 THEN 1 WHEN seq % 29 = 0 THEN 2
              WHEN seq % 37 = 0 THEN 3 WHEN seq % 43 = 0 THEN 4 WHEN seq % 47 = 0 THEN 5 ELSE 0 END AS shape,
         CASE WHEN kind = 1 AND seq % 82 = 0 THEN '/data/again.log' ELSE '/data/' || event_type || '.log' END AS log_path,
         'mgr-' || (user_id % 2) AS mgr, 'a-' || (seq * 3) AS own_id,
         '203.0.113.' || (user_id % 250) AS ip, 'u' || (user_id % 7) AS login,
         CASE WHEN kind = 2 THEN CAST(floor(seq / 97) AS BIGINT) % 10 END AS junk,
         (cls * 7) % 19 AS level, CAST(700 + cls AS VARCHAR(9)) AS rid, event_type || ' event of class ' || cls AS descr,
         event_type AS dec, CASE WHEN cls % 4 = 0 THEN event_type ELSE event_type || '|class-' || (cls % 4) END AS grps,
         CASE WHEN cls % 6 = 0 THEN '' WHEN cls % 5 = 0 THEN 'X' || (30 + cls % 9) || '|X' || (50 + cls % 7)
              ELSE 'X' || (30 + cls % 9) END AS mitre,
         CASE WHEN cls % 6 = 0 THEN '' ELSE 'Aim ' || (cls % 5) END AS tactics,
         CAST(user_id % 6 AS VARCHAR(9)) AS aid, 'node-' || (user_id % 6) AS aname, '192.0.2.' || (user_id % 6) AS aip
  FROM copies)
"""


def _json_list(column: str) -> str:
    return (
        f"CASE WHEN {column} = '' THEN '[]' "
        f"ELSE '[\"' || replace({column}, '|', '\",\"') || '\"]' END"
    )


_TEXT = f"""
CASE shape
WHEN 1 THEN '{{"demo_seq":' || seq || ',"rule":{{"level":' || level || '}}}}'
WHEN 2 THEN '{{"timestamp":1704067200,"id":' || seq || ',"demo_seq":' || seq || ',"rule":{{"level":" ' || level ||
  ' ","id":' || rid || '.0,"description":null,"groups":["one",2,null,{{"k":1}},true],"mitre":{{"id":"T9999","tactic":7}}}},'
  || '"agent":"none","manager":{{"name":"' || mgr || '"}},"location":true,"data":[1]}}'
ELSE '{{"timestamp":"' || stamp || CASE WHEN shape = 3 THEN '' ELSE '+0000' END || '","id":"' || own_id ||
  '","demo_seq":' || seq || ',"rule":{{"level":' || CASE WHEN shape = 4 THEN 99999 ELSE level END ||
  ',"description":"' || descr || '","id":"' || rid || '","groups":' || {_json_list('grps')} ||
  ',"mitre":{{"id":' || {_json_list('mitre')} || ',"tactic":' || {_json_list('tactics')} || '}}}},"agent":{{"id":"' || aid ||
  '","name":"' || aname || '","ip":"' || aip || '"}},"manager":{{"name":"' || mgr || '"}},"decoder":{{"name":"' || dec ||
  '"}},"location":"' || CASE WHEN shape = 5 THEN concat('/data/', chr(92), 'u0000') ELSE log_path END || '","full_log":"login of ' || login || ' from ' || ip ||
  '","data":{{"srcip":"' || ip || '","srcuser":"' || login || '"}}}}'
END
"""

# Junk by number, as bytes.
_JUNK = r"""
CASE CAST(junk AS INT)
WHEN 0 THEN CAST('not json' AS BINARY)
WHEN 1 THEN CAST('[1,2]' AS BINARY)
WHEN 2 THEN CAST(NULL AS BINARY)
WHEN 3 THEN X'FFFE'
WHEN 4 THEN CAST('{"demo_seq":' || seq || '} tail' AS BINARY)
WHEN 6 THEN CAST('{"demo_seq":' || seq || '}]' AS BINARY)
WHEN 7 THEN CAST('{"demo_seq":' || seq || '}],[7' AS BINARY)
WHEN 8 THEN CAST('{"demo_seq":' || seq || '},0] x' AS BINARY)
WHEN 9 THEN CAST('{"id":NaN}' AS BINARY)
ELSE CAST(concat('{"id":"bad","rule":{"description":"x ', chr(92), 'ud800 y"}}') AS BINARY)
END
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run SQL with the named tables in its FROM clauses."""
    return spark.sql(
        "WITH " + ", ".join(f"{name} AS (SELECT * FROM {{{name}}})" for name in tables) + " " + sql, **tables
    )


def _escape(sql: str) -> str:
    return sql.replace("{", "{{").replace("}", "}}")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker-shaped alert records: gaps, re-deliveries, junk, odd documents."""
    sql = _escape(
        ", " + MESSAGES
        + f""", texts AS (
          SELECT *, date_format(ts, 'yyyy-MM-dd''T''HH:mm:ss.SSS') AS stamp FROM msgs)
        SELECT '{TOPIC}' AS topic, source_partition AS partition, source_offset AS offset,
               CAST(ts AS TIMESTAMP) AS timestamp, CAST(NULL AS BINARY) AS key,
               made.value
        FROM texts LATERAL VIEW inline(array(struct(
               CASE WHEN shape = 9 THEN {_JUNK} ELSE CAST({_TEXT} AS BINARY) END AS value))) made AS value"""
    )
    return _query(spark, sql, events=dealt(table(spark, sf_dir, "events"), ["event_id"], TASK_EVENTS))


# Delivery of forwarded lines. One source holds more than a third of them, one has
# nothing settled yet, and one has no name.
DELIVERIES = """
SELECT CASE WHEN event_id > 0.99 * top THEN 'src-new' WHEN event_id % 13 = 6 THEN NULL
            WHEN event_id % 3 = 0 THEN 'src-0' ELSE 'src-' || (event_id % 7) END AS source,
       event_id AS seq, CAST(floor(event_id / 1000) AS BIGINT) AS file_id,
       (event_id % 1000 + 1) * 100 AS end_offset,
       CASE WHEN event_id > 0.99 * top THEN 'pending'
            WHEN event_id % 101 = 7 THEN 'blank'
            WHEN event_id % 103 = 5 THEN 'malformed'
            WHEN event_id % 107 = 9 THEN 'undeliverable'
            WHEN event_id > 0.75 * top AND event_id % 11 = 3 THEN 'failed'
            WHEN event_id > 0.85 * top AND event_id % 13 = 5 THEN 'pending'
            ELSE 'delivered' END AS outcome
FROM events, (SELECT max(event_id) AS top FROM events) AS t
"""
CHECKPOINTS = """
SELECT DISTINCT CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'src-new' WHEN 1 THEN 'src-0' WHEN 4 THEN NULL ELSE 'src-idle-' || (event_id % 5) END AS source,
       CAST(77 AS BIGINT) AS file_id, CAST(4242 AS BIGINT) AS offset FROM events
"""
QUEUE = """
SELECT CASE WHEN user_id % 13 = 5 THEN NULL WHEN user_id % 3 = 0 THEN 'host-0' ELSE 'host-' || (user_id % 5) END AS source,
       lpad(CAST({micros} * 1000 AS VARCHAR(30)), 20, '0') || '-ev' || lpad(CAST(event_id AS VARCHAR(30)), 12, '0') AS queue_key,
       CAST(length(props) + event_id % 50 AS BIGINT) AS size,
       CASE WHEN event_id % 61 = 0 THEN '{corrupt' ELSE props END AS body,
       event_id
FROM events
"""
ATTEMPTS = """
SELECT event_id AS batch_id,
       CASE WHEN user_id % 10 = 0 THEN NULL
            ELSE CASE CAST(event_id % 12 AS INT) WHEN 0 THEN 200 WHEN 1 THEN 202 WHEN 2 THEN 204 WHEN 3 THEN 301
                 WHEN 4 THEN 400 WHEN 5 THEN 401 WHEN 6 THEN 403 WHEN 7 THEN 404 WHEN 8 THEN 408
                 WHEN 9 THEN 429 WHEN 10 THEN 500 ELSE 503 END END AS status
FROM events
"""
# Kinds of journal lines: 1 garbage, 2 blank, 3 no cursor, 4 bad time, 5 a list.
JOURNAL = """
SELECT event_id, {micros} AS micros, CAST(event_id % 50 AS INT) AS kind,
       CASE CAST(event_id % 3 AS INT) WHEN 0 THEN '10' WHEN 1 THEN '4' ELSE '3' END AS facility,
       CASE WHEN event_id % 7 = 0 THEN '' ELSE 'sshd' END AS comm,
       event_id % 5 = 0 AS pid_is_number, 's=a;i=' || event_id AS cursor_text,
       'login of user' || user_id AS message
FROM events
"""
# Sent batches: some twice, some cut short; agents by user.
SENT = """
SELECT 'agent-' || (user_id % 20) AS agent, CAST(floor(event_id / 64) AS BIGINT) AS block,
       event_id, user_id, ts, event_type, 'ev-' || event_id AS id,
       CAST(floor(event_id / 64) AS BIGINT) % 9 = 4 AS sent_twice,
       CAST(floor(event_id / 64) AS BIGINT) % 13 = 6 AS cut
FROM events
"""
REVOKED = """
SELECT DISTINCT 'agent-' || (user_id % 20) AS agent_id FROM events WHERE user_id % 20 IN (3, 7)
"""
MANIFESTS = """
SELECT 'host-' || user_id AS source, user_id,
       '/logs/host-' || user_id || '/alerts.json' ||
         CASE WHEN event_id = newest AND user_id % 17 <> 0 THEN ''
              ELSE '.' || event_id || CASE WHEN event_id % 9 = 0 THEN '.gz' ELSE '' END END AS path,
       event_id * 10 + 1 AS file_id,
       CAST(CASE WHEN event_id % 13 = 0 THEN 2 ELSE 1 END AS BIGINT) AS device,
       CAST(1 AS BIGINT) AS home_device, ts AS mtime,
       500 + event_id % 400 AS size,
       event_id = newest AND user_id % 17 <> 0 AS is_live,
       event_id % 6 <> 5 AS resumable
FROM events JOIN (SELECT user_id AS newest_user, max(event_id) AS newest FROM events GROUP BY user_id) AS n
  ON user_id = newest_user
"""
SAVED = """
SELECT 'host-' || user_id AS source,
       CASE WHEN user_id % 7 = 2 THEN -5
            WHEN user_id % 11 = 1 THEN max(event_id) * 10 + 1
            ELSE coalesce(max(CASE WHEN event_id % 4 = 1 THEN event_id END), min(event_id)) * 10 + 1 END AS file_id,
       100 + user_id AS offset
FROM events WHERE user_id % 5 <> 0 GROUP BY user_id
"""
# Checkpointed positions: where the offset lies in its file and the byte before it.
POSITIONS = """
SELECT event_id, event_id % 600 AS offset, CAST(500 AS BIGINT) AS size,
       CASE WHEN event_id % 600 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'nl' ELSE 'x' END AS byte_before
FROM events
"""
ENDED = """
SELECT event_id, props || CASE CAST(event_id % 4 AS INT) WHEN 0 THEN '' WHEN 1 THEN chr(10) WHEN 2 THEN chr(13) || chr(10)
       ELSE chr(10) || chr(13) || chr(10) END AS value FROM events
"""
FILES = """
SELECT 'c-' || c_custkey AS name,
       CASE WHEN c_custkey % 41 = 0 THEN '' ELSE '/logs/' || c_custkey || '.json' END AS path, c_nationkey AS nation
FROM customer
"""
TOPICS = """
SELECT 'c-' || c_custkey AS name,
       CASE WHEN c_custkey % 29 = 0 THEN '' ELSE 'logs-' || lower(c_mktsegment) END AS topic
FROM customer WHERE c_custkey % 23 <> 0
"""
ROTATED = """
SELECT CASE WHEN c_custkey % 50 = 0 THEN 'x-' ELSE 'c-' END || c_custkey AS name,
       CASE WHEN c_custkey % 70 = 0 THEN '' ELSE '/old/' || c_custkey || '-*.json' END AS rotated_glob
FROM customer WHERE c_custkey % 10 = 0
"""
EXISTING = """
SELECT DISTINCT 'logs-' || lower(c_mktsegment) AS topic FROM customer WHERE c_mktsegment NOT LIKE 'A%'
"""
ROUTED = "SELECT 'c-' || o_custkey AS source, o_orderkey, o_orderstatus AS value FROM orders"
FILE_LINES = """
SELECT CASE WHEN user_id % 13 = 5 THEN NULL WHEN event_id % 3 = 0 THEN 'host-0' ELSE 'host-' || (user_id % 4) END AS source,
       CAST(floor(event_id / 5000) AS BIGINT) AS file_id, event_id AS line_no, props || event_type AS value
FROM events
"""

_MICROS = {"spark": "unix_micros(CAST(ts AS TIMESTAMP))", "duckdb": "epoch_us(ts)"}


def for_duckdb(sql: str) -> str:
    return sql.replace("{micros}", _MICROS["duckdb"])


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """One of the inputs above as a DataFrame."""
    text = _escape(sql.replace("{micros}", _MICROS["spark"]))
    names = [name for name in ("events", "customer", "orders") if f"FROM {name}" in sql]
    return _query(spark, text, **{name: table(spark, sf_dir, name) for name in names})


def journal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    def quoted(name: str, column) -> object:
        return F.concat(F.lit(f',"{name}":"'), column, F.lit('"'))

    pid = F.when(F.col("pid_is_number"), F.lit(',"_PID":42')).otherwise(F.lit(',"_PID":"42"'))
    body = F.concat(
        quoted("SYSLOG_FACILITY", F.col("facility")), quoted("_COMM", F.col("comm")), pid,
        quoted("MESSAGE", F.col("message")), F.lit("}"),
    )
    time = F.when(F.col("kind") == 4, F.lit("soon")).otherwise(F.col("micros").cast("string"))
    start = F.when(F.col("kind") == 3, F.lit('{"x":1')).otherwise(
        F.concat(F.lit('{"__CURSOR":"'), F.col("cursor_text"), F.lit('"'))
    )
    line = (
        F.when(F.col("kind") == 1, F.lit("{garbage"))
        .when(F.col("kind") == 2, F.lit("   "))
        .when(F.col("kind") == 5, F.lit("[1,2]"))
        .otherwise(F.concat(start, quoted("__REALTIME_TIMESTAMP", time), body))
    )
    return computed_once(derive(spark, sf_dir, JOURNAL), value=line).select("event_id", "value")


def envelope_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope texts; a batch holds at most 64 events."""
    sent = derive(spark, sf_dir, SENT)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    event = F.struct(
        "id",
        F.lit("auth.journald").alias("source"),
        stamp.alias("timestamp"),
        stamp.alias("collected_at"),
        F.col("agent").alias("host"),
        F.create_map(F.lit("kind"), F.col("event_type")).alias("payload"),
    )
    batches = sent.groupBy("agent", "block", "sent_twice", "cut").agg(
        F.collect_list(event).alias("events")
    )
    copies = batches.withColumn(
        "copy", F.explode(F.when(F.col("sent_twice"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    )
    body = F.to_json(
        F.struct(
            F.col("agent").alias("agent_id"),
            F.concat(F.lit("2024-02-0"), F.col("copy").cast("string"), F.lit("T00:00:00Z")).alias("sent_at"),
            F.lit(1).alias("schema_version"),
            "events",
        )
    )
    return copies.select(
        "agent",
        "block",
        "copy",
        F.when(F.col("cut"), F.substring(body, 1, 40)).otherwise(body).alias("value"),
    )
