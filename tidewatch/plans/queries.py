"""The registered queries: one callable per operator, (spark, sf_dir) -> DataFrame.

Arrays are joined to text and zoned times shown without zone, so that results
compare between engines.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.functions.json_text import member_int, strip_line_end
from tidewatch.functions.labels import queue_key
from tidewatch.operators import (
    audit,
    delivery,
    envelopes,
    findings as fq,
    generations,
    journal,
    queueing,
    routes,
)
from tidewatch.operators.normalize import alerts_of, check_lines, classify, normalize_alerts
from tidewatch.operators.shuffles import first_copy
from tidewatch.plans import derived as d
from tidewatch.session import checkpoint_dir, configure
from tidewatch.sinks import ledger as lg
from tidewatch.sinks.files import rotate_files, write_envelopes, write_ndjson, write_texts
from tidewatch.sinks.layout import Layout
from tidewatch.sources import journal_export, rotating_ndjson
from tidewatch.sources.files import read_queue
from tidewatch.sources.topics import topic_partitions
from tidewatch.streaming import follow, ingest as streams
from tidewatch.streaming.restart import run_until_done

AS_OF = "2024-01-15 12:00:00"
DAY_BEFORE = "2024-01-14 12:00:00"
PACK_N, PACK_BYTES = 256, 8192
KEEP_N, KEEP_BYTES = 5000, 100_000
# Lines of the files whose last line has no end.
LINES_OF_FILE = 64
# The number of the entry after which the journal is read.
AFTER = 321
# Parts in which the streaming queries receive the records, and the running audit.
PARTS, AUDIT_PARTS = 4, 8
# Records of a file that the streaming queries receive, about, where there are many.
FILE_RECORDS = 25_000


def _text(*names: str) -> list:
    return [F.array_join(name, "|").alias(name) for name in names]


def _plain(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


def _show(findings: DataFrame) -> DataFrame:
    """Finding columns without the document, in comparable types."""
    return findings.select(
        "manager", "alert_id", _plain("ts"), "rule_id",
        F.col("rule_level").cast("int").alias("rule_level"), "rule_description",
        *_text("rule_groups", "mitre_ids", "mitre_tactics"),
        "agent_id", "agent_name", "agent_ip", "decoder", "location", "src_ip", "src_user",
        "source_topic", "source_partition", "source_offset",
    )


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return classify(d.records(spark, sf_dir))


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_copy(alerts_of(_classified(spark, sf_dir)), lg.KEYS, lg.POSITION)


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of one batch over everything, without writing it."""
    return lg.dispose(_classified(spark, sf_dir))


def _sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return audit.sequence_numbers(d.records(spark, sf_dir))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- alerts and findings ---------------------------------------------------------


def normalize_query(spark, sf_dir):
    configure(spark)
    return _show(normalize_alerts(d.records(spark, sf_dir))[0])


def rejects_by_reason(spark, sf_dir):
    configure(spark)
    rejects = normalize_alerts(d.records(spark, sf_dir))[1]
    return rejects.groupBy("reject_reason").agg(
        F.count("*").alias("messages"), F.min("source_offset").alias("first_offset")
    )


def reject_rows(spark, sf_dir):
    configure(spark)
    return normalize_alerts(d.records(spark, sf_dir))[1].select(
        "source_topic", "source_partition", "source_offset", "reject_reason"
    )


def line_checks(spark, sf_dir):
    configure(spark)
    lines = d.records(spark, sf_dir)
    return check_lines(lines).groupBy("partition", "status").agg(
        F.count("*").alias("lines"), F.max("offset").alias("last_offset")
    )


def findings_first_copy(spark, sf_dir):
    return _show(_findings(spark, sf_dir))


def message_dispositions(spark, sf_dir):
    return _ledger(spark, sf_dir).select(
        "source_partition", "source_offset", "disposition", "reject_reason"
    )


def new_rows_query(spark, sf_dir):
    """Second half of the records against a history of the first half."""
    alerts = alerts_of(_classified(spark, sf_dir))
    history = alerts.filter("source_offset % 8 < 4")
    batch = first_copy(alerts.filter("source_offset % 8 >= 4"), lg.KEYS, lg.POSITION)
    return lg.new_rows(batch, history).select("manager", "alert_id", "source_offset")


def top_severe_recent(spark, sf_dir):
    return fq.top_severe(_findings(spark, sf_dir), AS_OF, hours=24).select(
        _plain("ts"), F.col("rule_level").cast("int").alias("rule_level"), "agent_name",
        "rule_description", *_text("mitre_ids"), "alert_id",
    )


def technique_rollup(spark, sf_dir):
    return fq.technique_rollup(_findings(spark, sf_dir))


def table_audit(spark, sf_dir):
    return fq.table_audit(_findings(spark, sf_dir))


def findings_counts(spark, sf_dir):
    return fq.findings_counts(_findings(spark, sf_dir))


def severity_tags(spark, sf_dir):
    return fq.severity_counts(_findings(spark, sf_dir)).withColumn(
        "max_level", F.col("max_level").cast("int")
    )


def alert_display(spark, sf_dir):
    alerts = alerts_of(_classified(spark, sf_dir))
    marked = audit.mark_duplicates(
        alerts.select(
            F.col("source_topic").alias("topic"),
            F.col("source_partition").alias("partition"),
            F.col("source_offset").alias("offset"),
            member_int(F.col("raw"), "demo_seq").alias("seq"),
            "rule_level", "agent_name", "rule_description", "mitre_ids",
            "source_topic", "source_partition", "source_offset",
        )
    )
    return fq.display(marked, F.col("seq"), F.col("is_duplicate"))


def findings_sql(spark, sf_dir):
    """Plain SQL over the registered view."""
    fq.register_view(_findings(spark, sf_dir), "findings")
    return spark.sql(
        "SELECT agent_name, count(*) AS alerts, max(rule_level) AS worst FROM findings "
        "WHERE array_contains(mitre_ids, 'X34') GROUP BY agent_name"
    ).withColumn("worst", F.col("worst").cast("int"))


# --- ledger -----------------------------------------------------------------------


def ingest_offsets(spark, sf_dir):
    return lg.next_offsets(_ledger(spark, sf_dir))


def ingest_stats(spark, sf_dir):
    return lg.ingest_stats(_ledger(spark, sf_dir))


def ledger_view(spark, sf_dir):
    """SQL over the catalog's view of a ledger of two batches, declared twice."""
    configure(spark)
    target, name = _scratch(spark, "target"), f"ledger_{uuid.uuid4().hex}"
    view = lg.create_tables(spark, target, name)
    records = d.records(spark, sf_dir)
    commit = lg.commit_batch(target)
    for number in (0, 1):
        commit(records.filter(f"offset div 4 % 2 = {number}"), number)
    lg.create_tables(spark, target, name)
    return spark.sql(f"SELECT agent_name, count(*) AS alerts FROM {view} GROUP BY agent_name")


def _layout(spark, sf_dir) -> Layout:
    """A ledger of three batches, of which two are compacted into many files."""
    configure(spark)
    target = _scratch(spark, "target")
    commit = lg.commit_batch(target)
    records = d.records(spark, sf_dir)
    for number in range(3):
        commit(records.filter(f"offset div 4 % 3 = {number}"), number)
    layout = Layout(spark, target, file_rows=max(100, records.count() // 32))
    layout.compact()
    return layout


def layout_severe(spark, sf_dir):
    found = _layout(spark, sf_dir).read(since=DAY_BEFORE)
    return fq.top_severe(found, AS_OF, hours=24).select(
        _plain("ts"), F.col("rule_level").cast("int").alias("rule_level"), "agent_name",
        "rule_description", *_text("mitre_ids"), "alert_id",
    )


def layout_agent(spark, sf_dir):
    found = _layout(spark, sf_dir).read(since=DAY_BEFORE, until=AS_OF, agent="node-2")
    return found.select("manager", "alert_id", _plain("ts"))


def layout_technique(spark, sf_dir):
    found = _layout(spark, sf_dir).read(technique="X34")
    return found.groupBy("agent_name").agg(F.count("*").alias("alerts"), F.max("rule_level").cast("int").alias("worst"))


def start_offsets(spark, sf_dir):
    configure(spark)
    records = d.records(spark, sf_dir)
    read_so_far = records.filter("partition < 2 AND offset % 16 < 12").groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset")
    )
    begin = lg.resolve_start(topic_partitions(records), read_so_far, "beginning")
    end = lg.resolve_start(topic_partitions(records), read_so_far, "end")
    return begin.join(
        end.select("topic", "partition", F.col("start_offset").alias("start_at_end")),
        ["topic", "partition"],
    )


def _part(rows: DataFrame, part: int, parts: int) -> DataFrame:
    return rows.filter(F.expr(f"offset div 4 % {parts}") == part)


def _files_of_part(spark, sf_dir, parts: int) -> int:
    """Files in which a part of the records is written, so that each holds as many of them."""
    return -(-d.table(spark, sf_dir, "events").count() // (parts * FILE_RECORDS))


def _even(rows: DataFrame, files: int) -> DataFrame:
    """Rows of several files by hash: re-deliveries and junk are made in tasks of their own, and a stream
    that packs their small files with large ones leaves most records to half of its tasks."""
    return rows.repartition(files, "partition", "offset") if files > 1 else rows


def _drain(spark, source: str, starter, target: str, state: str) -> None:
    stream = (
        spark.readStream.schema(spark.read.parquet(source).schema)
        .option("maxFilesPerTrigger", 100_000)
        .parquet(source)
    )
    starter(stream, target, state).awaitTermination()


def _ledger_through_stream(spark, sf_dir, starter, again: bool = False, parts: int = PARTS) -> str:
    """Drain the records through a streaming job, one batch for each part, and return its folder.

    At the end the job is started once more, with nothing new. again: the last
    part is left to a job with a new checkpoint, which reads all parts anew.
    """
    configure(spark)
    source, target, state = (_scratch(spark, name) for name in ("records", "target", "state"))
    records, files = d.records(spark, sf_dir), _files_of_part(spark, sf_dir, parts)
    for part in range(parts):
        _even(_part(records, part, parts), files).write.mode("append").parquet(source)
        _drain(spark, source, starter, target, _scratch(spark, "state") if again and part == parts - 1 else state)
    if not again:
        _drain(spark, source, starter, target, state)
    return target


def _streamed(spark, target: str) -> DataFrame:
    return lg.findings(lg.read_ledger(spark, target)).select(
        "manager", "alert_id", _plain("ts"), F.col("rule_level").cast("int").alias("rule_level"),
        *_text("mitre_ids"), "agent_name", "location",
    )


def stream_ingest_exactly_once(spark, sf_dir):
    return _streamed(spark, _ledger_through_stream(spark, sf_dir, streams.ingest))


def stream_ingest_new_checkpoint(spark, sf_dir):
    return _streamed(spark, _ledger_through_stream(spark, sf_dir, streams.ingest, again=True))


def stream_ingest_counters(spark, sf_dir):
    target = _ledger_through_stream(spark, sf_dir, streams.ingest)
    ledger = lg.read_ledger(spark, target)
    return lg.ingest_stats(ledger)


def stream_batch_counters(spark, sf_dir):
    target = _ledger_through_stream(spark, sf_dir, streams.ingest)
    return lg.batch_stats(lg.read_ledger(spark, target)).drop("run")


def stream_ingest_with_state(spark, sf_dir):
    return _streamed(spark, _ledger_through_stream(spark, sf_dir, streams.ingest_with_state))


def stream_state_new_checkpoint(spark, sf_dir):
    """The last part is left to a job with empty state, which starts with the stored keys."""
    return _streamed(spark, _ledger_through_stream(spark, sf_dir, streams.ingest_with_state, again=True))


def stream_state_counters(spark, sf_dir):
    target = _ledger_through_stream(spark, sf_dir, streams.ingest_with_state)
    return lg.batch_stats(lg.read_ledger(spark, target)).drop("run")


def stream_state_offsets(spark, sf_dir):
    target = _ledger_through_stream(spark, sf_dir, streams.ingest_with_state)
    return lg.next_offsets(lg.read_ledger(spark, target))


def streaming_seq_audit(spark, sf_dir):
    target = _ledger_through_stream(spark, sf_dir, streams.running_audit, parts=AUDIT_PARTS)
    return _audit_row(streams.audit_of(spark, target))


def stream_committed_prefix(spark, sf_dir):
    """Lines in order, in parts; what was delivered of a part is acknowledged with the next ones, some of it twice."""
    lines, initial = _deliveries(spark, sf_dir)
    source, target, state = (_scratch(spark, name) for name in ("lines", "target", "state"))
    top = F.floor(F.col("seq") * PARTS / (lines.agg(F.max("seq")).first()[0] + 1))
    own = lines.select("source", "seq", "file_id", "end_offset", "outcome", top.cast("int").alias("part"))
    read = own.select("source", "seq", "file_id", "end_offset",
                      F.col("outcome").isin("blank", "malformed", "undeliverable").alias("settled"), "part")
    nothing = [F.lit(None).cast("long").alias(c) for c in ("file_id", "end_offset")]
    later = [F.col("part") + F.pmod(F.col("seq") * 7, F.lit(PARTS)).cast("int"), F.when(F.col("seq") % 5 == 0, F.lit(PARTS - 1))]
    acks = own.filter("outcome = 'delivered'").select("source", "seq", *nothing, F.lit(True).alias("settled"), F.explode(
        F.array_compact(F.array(*later))).alias("part"))
    sent = read.unionByName(acks.withColumn("part", F.least("part", F.lit(PARTS - 1))))
    for part in range(PARTS):
        sent.filter(F.col("part") == part).drop("part").write.mode("append").parquet(source)
        _drain(spark, source, streams.running_commits, target, state)
    return streams.commits_of(spark, target, initial)


def stream_ingest_cadence(spark, sf_dir):
    """A job that looks for new records five times a second and takes one part each time, a file unless it is large."""
    configure(spark)
    source, target, state = (_scratch(spark, name) for name in ("records", "target", "state"))
    records = d.records(spark, sf_dir)
    files = max(1, d.table(spark, sf_dir, "events").count() // (PARTS * d.TASK_EVENTS))
    for part in range(PARTS):
        _part(records, part, PARTS).repartition(files).write.mode("append").parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", files).parquet(source)
    query = streams.ingest(stream, target, state, every="200 milliseconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return lg.batch_stats(lg.read_ledger(spark, target)).drop("run")


def ingest_stamps(spark, sf_dir):
    """Rows of each batch that carry a time between the begin and the end of the job."""
    begun = spark.sql("SELECT now() AS t").first()["t"]
    target = _ledger_through_stream(spark, sf_dir, streams.ingest)
    ended = spark.sql("SELECT now() AS t").first()["t"]
    stamped = F.col("ingested_at").between(F.lit(begun), F.lit(ended))
    return lg.read_ledger(spark, target).groupBy("batch_id").agg(F.count_if(stamped).alias("stamped"))


def stream_ingest_restarts(spark, sf_dir):
    """The second batch fails before it is written, and again after it was; the job is started anew each time."""
    configure(spark)
    source, target, state = (_scratch(spark, name) for name in ("records", "target", "state"))
    records = d.records(spark, sf_dir)
    commit, calls = lg.commit_batch(target), []

    def write(batch, batch_id):
        calls.append(batch_id)
        if batch_id != 1 or calls.count(1) > 1:
            commit(batch, batch_id)
        if batch_id == 1 and calls.count(1) < 3:
            raise RuntimeError("the sink is down")

    files = _files_of_part(spark, sf_dir, PARTS)
    for part in range(PARTS):
        _even(_part(records, part, PARTS), files).write.mode("append").parquet(source)
        stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 100_000)
        run_until_done(
            lambda s=stream: streams.start(s.parquet(source).writeStream.foreachBatch(write), state), pause=0.1
        )
    return _streamed(spark, target)


# --- audits -----------------------------------------------------------------------


def _audit_row(row: DataFrame) -> DataFrame:
    return row.select(
        "received", "unique_seqs", "highest", "duplicates", "gaps", "has_gaps",
        audit.audit_line().alias("line"),
    )


def seq_audit(spark, sf_dir):
    return _audit_row(audit.seq_audit(_sequences(spark, sf_dir)))


def seq_gaps(spark, sf_dir):
    return audit.seq_gaps(_sequences(spark, sf_dir))


def seq_first_gaps(spark, sf_dir):
    return audit.first_gaps(_sequences(spark, sf_dir))


def seq_duplicate_marks(spark, sf_dir):
    return audit.mark_duplicates(_sequences(spark, sf_dir)).select(
        "partition", "offset", "seq", "is_duplicate"
    )


# --- delivery ---------------------------------------------------------------------


def _deliveries(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    configure(spark)
    return d.derive(spark, sf_dir, d.DELIVERIES), d.derive(spark, sf_dir, d.CHECKPOINTS)


def committed_prefix(spark, sf_dir):
    lines, initial = _deliveries(spark, sf_dir)
    ledger = lines.withColumn("settled", delivery.is_settled(F.col("outcome")))
    return delivery.committed_prefix(ledger, initial)


def forwarder_stats(spark, sf_dir):
    return delivery.delivery_stats(*_deliveries(spark, sf_dir))


def acknowledged_lines(spark, sf_dir):
    lines, _ = _deliveries(spark, sf_dir)
    acks = lines.filter("outcome = 'delivered'").select("source", "seq")
    twice = acks.unionByName(acks.filter("seq % 5 = 0"))
    return delivery.apply_acks(lines, twice).select("source", "seq", "settled")


def delivery_outcome(spark, sf_dir):
    configure(spark)
    return delivery.delivery_outcome(d.derive(spark, sf_dir, d.ATTEMPTS)).select(
        "batch_id", "outcome", "disposition"
    )


# --- queues -----------------------------------------------------------------------


def _queue(spark, sf_dir) -> DataFrame:
    configure(spark)
    return d.derive(spark, sf_dir, d.QUEUE)


def batch_pack(spark, sf_dir):
    readable, _ = queueing.split_corrupt(_queue(spark, sf_dir))
    return queueing.pack_batch(readable, PACK_N, PACK_BYTES).select("source", "queue_key", "size")


def batch_pack_by_bytes(spark, sf_dir):
    return queueing.pack_batch(_queue(spark, sf_dir), 0, KEEP_BYTES).select("source", "queue_key", "size")


def retention_keep(spark, sf_dir):
    return queueing.retain(_queue(spark, sf_dir), PACK_N, PACK_BYTES).select("source", "queue_key", "size")


def retention_report(spark, sf_dir):
    return queueing.retention_report(_queue(spark, sf_dir), KEEP_N, KEEP_BYTES)


def queue_keys(spark, sf_dir):
    configure(spark)
    events = d.table(spark, sf_dir, "events")
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return events.select("event_id", queue_key(nanos, F.concat(F.lit("ev"), F.col("event_id"))).alias("queue_key"))


def queue_folder(spark, sf_dir):
    """Events as files of a queue folder, read back as whole files."""
    folder = _scratch(spark, "queue")
    d.table(spark, sf_dir, "events").select("event_id").write.json(folder)
    lines = read_queue(spark, folder, "q").select("source", F.explode(F.split("body", "\n")).alias("line"))
    return lines.filter("line <> ''").select("source", member_int(F.col("line"), "event_id").alias("event_id"))


def queue_depth(spark, sf_dir):
    return queueing.queue_depth(_queue(spark, sf_dir))


def fifo_order(spark, sf_dir):
    return queueing.fifo(_queue(spark, sf_dir)).select("source", "queue_key", "place")


def dead_letters(spark, sf_dir):
    queue = _queue(spark, sf_dir)
    _, corrupt = queueing.split_corrupt(queue)
    attempts = delivery.delivery_outcome(d.derive(spark, sf_dir, d.ATTEMPTS))
    refused = queueing.dead_letters(
        queue,
        queue.join(attempts, queue["event_id"] == attempts["batch_id"]).select(
            "source", "queue_key", "disposition"
        ),
    )
    return corrupt.withColumn("why", F.lit("corrupt")).unionByName(
        refused.withColumn("why", F.lit("refused"))
    ).select("source", "queue_key", "why")


# --- routes -----------------------------------------------------------------------


def _config(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    configure(spark)
    return tuple(d.derive(spark, sf_dir, sql) for sql in (d.FILES, d.TOPICS, d.ROTATED))


def route_table(spark, sf_dir):
    return routes.build_routes(*_config(spark, sf_dir))


def route_violations(spark, sf_dir):
    return routes.route_violations(*_config(spark, sf_dir))


def route_lines(spark, sf_dir):
    table = routes.build_routes(*_config(spark, sf_dir))
    return routes.route(d.derive(spark, sf_dir, d.ROUTED), table).select("o_orderkey", "source", "topic")


def missing_topics(spark, sf_dir):
    table = routes.build_routes(*_config(spark, sf_dir))
    return routes.missing_topics(table, d.derive(spark, sf_dir, d.EXISTING))


def _checks(spark, sf_dir) -> DataFrame:
    return _config(spark, sf_dir)[0].select(
        F.concat(F.lit("files-"), F.col("nation").cast("string")).alias("name"),
        (F.col("path") != "").alias("ok"),
        F.concat(F.col("name"), F.when(F.col("path") == "", F.lit(" has no path")).otherwise(F.lit(" set"))).alias("detail"),
    )


def check_rollup(spark, sf_dir):
    return routes.check_rollup(_checks(spark, sf_dir))


def check_details(spark, sf_dir):
    return routes.check_details(_checks(spark, sf_dir))


def check_report(spark, sf_dir):
    return routes.check_report(_checks(spark, sf_dir))


# --- rotated files ----------------------------------------------------------------


def _generations(spark, sf_dir, start_from: str):
    configure(spark)
    manifest = d.derive(spark, sf_dir, d.MANIFESTS).drop("user_id")
    return generations.owed_generations(manifest, d.derive(spark, sf_dir, d.SAVED), start_from)


def owed_generations(spark, sf_dir):
    return _generations(spark, sf_dir, "end")[0].select(
        "source", "path", "file_id", "start_offset", "phase"
    )


def lost_ranges(spark, sf_dir):
    return _generations(spark, sf_dir, "end")[1]


def drain_order(spark, sf_dir):
    owed = _generations(spark, sf_dir, "beginning")[0]
    return generations.drain_order(owed).select("source", "file_id", "start_offset", "position")


def rotated_candidates(spark, sf_dir):
    configure(spark)
    manifest = d.derive(spark, sf_dir, d.MANIFESTS).drop("user_id")
    return generations.rotated_candidates(manifest).select("source", "path")


def line_offsets(spark, sf_dir):
    configure(spark)
    return generations.line_offsets(d.derive(spark, sf_dir, d.FILE_LINES)).select(
        "source", "file_id", "line_no", "end_offset"
    )


def rotating_ndjson_scan(spark, sf_dir):
    """Write the events as line files, read them as sources that are followed."""
    import json
    import os

    configure(spark)
    rotating_ndjson.register(spark)
    folder = _scratch(spark, "lines").removeprefix("file:")
    events = d.table(spark, sf_dir, "events")
    events.select(F.to_json(F.struct("event_id", "user_id")).alias("value")).write.text(folder)
    paths = {name: f"{folder}/{name}" for name in os.listdir(folder) if name.startswith("part-")}
    lines = (
        spark.read.format("rotating_ndjson")
        .option("paths", json.dumps(paths))
        .option("startFrom", "beginning")
        .option("rangeBytes", 65536)
        .load()
    )
    text = F.col("value").cast("string")
    fields = F.from_json(text, "event_id bigint, user_id bigint")
    return lines.select(
        fields["event_id"].alias("event_id"),
        fields["user_id"].alias("user_id"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )


def rotating_ndjson_follow(spark, sf_dir):
    """Follow line files over a rotation: half of the events before it, half after."""
    import json
    import os

    configure(spark)
    rotating_ndjson.register(spark)
    folder, out, state = (_scratch(spark, name) for name in ("followed", "out", "state"))
    folder = folder.removeprefix("file:")
    events = d.table(spark, sf_dir, "events").select("event_id", "user_id")
    paths: dict[str, str] = {}
    for half in (0, 1):
        fresh = f"{folder}/half-{half}"
        write_ndjson(events.filter(f"event_id % 2 = {half}"), fresh)
        written = sorted(name for name in os.listdir(fresh) if name.startswith("part-"))
        if not half:
            paths = {f"s{i}": f"{fresh}/{name}" for i, name in enumerate(written)}
        else:
            for path in paths.values():
                os.rename(path, f"{path}.1")
            for path, name in zip(paths.values(), written, strict=True):
                os.rename(f"{fresh}/{name}", path)
        lines = (
            spark.readStream.format("rotating_ndjson")
            .options(paths=json.dumps(paths), startFrom="beginning", rangeBytes=65536)
            .load()
        )
        streams.start(lines.writeStream.format("parquet").option("path", out), state).awaitTermination()
    fields = F.from_json(F.col("value").cast("string"), "event_id bigint, user_id bigint")
    return spark.read.parquet(out).select(fields["event_id"].alias("event_id"), fields["user_id"].alias("user_id"))


def rotating_ndjson_bounded(spark, sf_dir):
    """Follow line files in runs whose batches are bounded from the first one on."""
    import json

    configure(spark)
    rotating_ndjson.register(spark)
    folder, out, state = (_scratch(spark, name).removeprefix("file:") for name in ("lines", "out", "state"))
    events = d.table(spark, sf_dir, "events").select("event_id", "user_id")
    write_ndjson(events.repartition(2), folder)
    files = {r["name"]: (r["path"], r["length"]) for r in _files(spark, folder)}
    lines = (
        spark.readStream.format("rotating_ndjson")
        .options(paths=json.dumps({name: path for name, (path, _) in files.items()}), startFrom="beginning",
                 maxBytesPerTrigger=1 + max(size for _, size in files.values()) // 3, planLog=f"{state}/plan.json")
        .load()
    )
    for _ in range(4):
        streams.start(lines.writeStream.format("parquet").option("path", out), f"{state}/checkpoint").awaitTermination()
    fields = F.from_json(F.col("value").cast("string"), "event_id bigint, user_id bigint")
    return spark.read.parquet(out).select(fields["event_id"].alias("event_id"), fields["user_id"].alias("user_id"))


def follow_rounds(spark, sf_dir):
    """Follow line files over a rotation in three rounds, the last of which finds nothing new."""
    configure(spark)
    folder, target = _scratch(spark, "followed"), _scratch(spark, "target")
    events = d.table(spark, sf_dir, "events").select("event_id", "user_id")
    live: dict[str, str] = {}
    for half in (0, 1):
        write_ndjson(events.filter(f"event_id % 2 = {half}").repartition(8), f"{folder}/half-{half}")
        written = sorted(r["path"] for r in _files(spark, f"{folder}/half-{half}"))
        if not half:
            live = {f"s{i}": name for i, name in enumerate(written)}
        for name, path in zip(written, list(live.values()) if half else [], strict=False):
            _rename(spark, path, f"{path}.1")
            _rename(spark, name, path)
        routes = spark.createDataFrame(
            [(name, path, None) for name, path in live.items()], "name string, path string, rotated_glob string"
        )
        follow.follow_round(routes, target, "beginning", range_bytes=16384)
    follow.follow_round(routes, target)
    fields = F.from_json(F.col("value").cast("string"), "event_id bigint, user_id bigint")
    found = follow.lines_of(spark, target)
    return found.select(fields["event_id"].alias("event_id"), fields["user_id"].alias("user_id"))


def _open_files(spark, sf_dir, folder: str) -> DataFrame:
    """Routes of files of 64 events each, whose last line has no end."""
    line = F.to_json(F.struct("event_id", "user_id"))
    lines = d.table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / LINES_OF_FILE).alias("block"), F.struct("event_id", line.alias("line")).alias("own")
    )
    text = F.array_join(F.transform(F.array_sort(F.collect_list("own")), lambda x: x["line"]), "\n")
    name = F.coalesce(F.col("block").cast("string"), F.lit("none"))
    path = F.concat(F.lit(f"{folder.removeprefix('file:')}/block="), name, F.lit("/lines.txt"))
    files = lines.groupBy("block").agg(F.concat(text, F.lit(" ")).alias("value")).select(path.alias("path"), "value")
    found = write_texts(files, _scratch(spark, "routes"))
    return found.select(F.col("path").alias("name"), "path", F.lit(None).cast("string").alias("rotated_glob"))


def _followed_ids(spark, target: str) -> DataFrame:
    text = F.trim(F.col("value").cast("string"))
    fields = F.from_json(text, "event_id bigint, user_id bigint")
    return follow.lines_of(spark, target).select(fields["event_id"].alias("event_id"), fields["user_id"].alias("user_id"))


def open_lines_withheld(spark, sf_dir):
    """The last lines of live files may still grow and are not read."""
    configure(spark)
    folder, target = _scratch(spark, "open"), _scratch(spark, "target")
    follow.follow_round(_open_files(spark, sf_dir, folder), target, "beginning")
    return _followed_ids(spark, target)


def open_lines_after_rotation(spark, sf_dir):
    """The last lines of rotated files will not grow any more and are read."""
    configure(spark)
    folder, target = _scratch(spark, "open"), _scratch(spark, "target")
    routes = _open_files(spark, sf_dir, folder)
    follow.follow_round(routes, target, "beginning")
    rotate_files(routes)
    follow.follow_round(routes, target, "beginning")
    return _followed_ids(spark, target)


def _rename(spark, name: str, target: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    path(name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(path(name), path(target))


def _files(spark, folder: str) -> list:
    """name, path and length of the data files in a folder."""
    found = spark.read.format("binaryFile").load(folder).drop("content")
    return found.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.regexp_replace("path", "^file:", "").alias("path"), "length"
    ).collect()


def line_boundaries(spark, sf_dir):
    configure(spark)
    rows = d.derive(spark, sf_dir, d.POSITIONS)
    before = F.when(F.col("byte_before") == "nl", F.lit(b"\n")).otherwise(F.col("byte_before").cast("binary"))
    return rows.select(
        "event_id", generations.at_line_boundary(F.col("offset"), F.col("size"), before).alias("resumes")
    )


def stripped_lines(spark, sf_dir):
    configure(spark)
    return d.derive(spark, sf_dir, d.ENDED).select("event_id", strip_line_end(F.col("value")).alias("value"))


def ndjson_round_trip(spark, sf_dir):
    folder = _scratch(spark, "ndjson")
    write_ndjson(d.table(spark, sf_dir, "events").select("event_id", "event_type", "props"), folder)
    return spark.read.schema("event_id bigint, event_type string, props string").json(folder)


# --- journal and envelopes --------------------------------------------------------


def journal_events(spark, sf_dir):
    configure(spark)
    events, _ = journal.journal_events(d.journal_lines(spark, sf_dir))
    payload = [
        F.element_at("payload", key).alias(key)
        for key in ("syslog_facility", "comm", "pid", "message")
    ]
    return events.select("id", "source", _plain("timestamp"), "cursor", *payload)


def _journal_exports(spark, sf_dir, folder: str, part: int, parts: int) -> None:
    """Write a part of the journal, by number of the entry, as export files in order."""
    rows = d.journal_lines(spark, sf_dir)
    top, entries = rows.agg(F.max("event_id"), F.count("*")).first()
    own = rows.filter(F.floor(F.col("event_id") * parts / (top + 1)) == part)
    files = max(3, entries // (parts * d.TASK_ENTRIES))
    ordered = own.repartitionByRange(files, "event_id").sortWithinPartitions("event_id")
    ordered.select("value").write.text(f"{folder}/{part}")


def _journal_columns(lines: DataFrame) -> DataFrame:
    return journal.journal_events(lines)[0].select("id", "source", _plain("timestamp"), "cursor")


def journal_resume(spark, sf_dir):
    """Follow exports that arrive in three parts, each with a run of its own."""
    configure(spark)
    journal_export.register(spark)
    folder, out, state = (_scratch(spark, name) for name in ("exports", "out", "state"))
    for part in range(3):
        _journal_exports(spark, sf_dir, folder, part, 3)
        lines = spark.readStream.format("journal_export").option("path", folder).load()
        streams.start(lines.writeStream.format("parquet").option("path", out), state).awaitTermination()
    return _journal_columns(spark.read.parquet(out))


def journal_after(spark, sf_dir):
    """The entries behind a cursor."""
    configure(spark)
    journal_export.register(spark)
    folder = _scratch(spark, "exports")
    _journal_exports(spark, sf_dir, folder, 0, 1)
    lines = spark.read.format("journal_export").options(path=folder, after=f"s=a;i={AFTER}", rangeBytes=65536).load()
    return _journal_columns(lines)


def journal_rejects(spark, sf_dir):
    configure(spark)
    return journal.journal_events(d.journal_lines(spark, sf_dir))[1].select(
        "event_id", "reject_reason"
    )


def _received(spark, sf_dir) -> DataFrame:
    configure(spark)
    return envelopes.unpack_envelopes(
        d.envelope_bodies(spark, sf_dir), d.derive(spark, sf_dir, d.REVOKED)
    )


def ingest_envelopes(spark, sf_dir):
    return _received(spark, sf_dir).select(
        "agent_id", "id", _plain("sent_at"), _plain("timestamp"),
        F.element_at("payload", "kind").alias("kind"),
    )


def unique_events(spark, sf_dir):
    return envelopes.unique_events(_received(spark, sf_dir)).select(
        "agent_id", "id", _plain("sent_at"), "host"
    )


def envelope_rejects(spark, sf_dir):
    configure(spark)
    return (
        envelopes.parse_envelopes(d.envelope_bodies(spark, sf_dir))
        .filter(F.col("reject_reason").isNotNull())
        .select("agent", "block", "copy", "reject_reason")
    )


def _packed(spark, sf_dir) -> DataFrame:
    events = envelopes.unique_events(_received(spark, sf_dir))
    return envelopes.pack_envelopes(events, 100)


def envelope_batches(spark, sf_dir):
    return _packed(spark, sf_dir).select(
        "agent_id", "batch_no", F.size("events").alias("events"),
        F.element_at("events", 1)["id"].alias("first_id"),
        F.element_at("events", -1)["id"].alias("last_id"),
    )


def envelope_files(spark, sf_dir):
    """Packed envelopes through gzip files and back."""
    folder = _scratch(spark, "envelopes")
    write_envelopes(_packed(spark, sf_dir), folder)
    return envelopes.unpack_envelopes(spark.read.text(folder)).select(
        "agent_id", "id", _plain("timestamp")
    )


QUERIES = {
    "normalize_alerts": normalize_query,
    "rejects_by_reason": rejects_by_reason,
    "reject_rows": reject_rows,
    "line_checks": line_checks,
    "findings_first_copy": findings_first_copy,
    "message_dispositions": message_dispositions,
    "new_rows": new_rows_query,
    "top_severe_recent": top_severe_recent,
    "technique_rollup": technique_rollup,
    "table_audit": table_audit,
    "findings_counts": findings_counts,
    "severity_tags": severity_tags,
    "alert_display": alert_display,
    "findings_sql": findings_sql,
    "ingest_offsets": ingest_offsets,
    "ingest_stats": ingest_stats,
    "start_offsets": start_offsets,
    "ledger_view": ledger_view,
    "layout_severe": layout_severe,
    "layout_agent": layout_agent,
    "layout_technique": layout_technique,
    "stream_ingest_exactly_once": stream_ingest_exactly_once,
    "stream_ingest_new_checkpoint": stream_ingest_new_checkpoint,
    "stream_ingest_counters": stream_ingest_counters,
    "stream_ingest_restarts": stream_ingest_restarts,
    "stream_ingest_cadence": stream_ingest_cadence,
    "ingest_stamps": ingest_stamps,
    "stream_batch_counters": stream_batch_counters,
    "stream_ingest_with_state": stream_ingest_with_state,
    "stream_state_new_checkpoint": stream_state_new_checkpoint,
    "stream_state_counters": stream_state_counters,
    "stream_state_offsets": stream_state_offsets,
    "streaming_seq_audit": streaming_seq_audit,
    "stream_committed_prefix": stream_committed_prefix,
    "seq_audit": seq_audit,
    "seq_gaps": seq_gaps,
    "seq_first_gaps": seq_first_gaps,
    "seq_duplicate_marks": seq_duplicate_marks,
    "committed_prefix": committed_prefix,
    "forwarder_stats": forwarder_stats,
    "acknowledged_lines": acknowledged_lines,
    "delivery_outcome": delivery_outcome,
    "batch_pack": batch_pack,
    "batch_pack_by_bytes": batch_pack_by_bytes,
    "retention_keep": retention_keep,
    "retention_report": retention_report,
    "queue_depth": queue_depth,
    "queue_keys": queue_keys,
    "queue_folder": queue_folder,
    "fifo_order": fifo_order,
    "dead_letters": dead_letters,
    "route_table": route_table,
    "route_violations": route_violations,
    "route_lines": route_lines,
    "missing_topics": missing_topics,
    "check_rollup": check_rollup,
    "check_details": check_details,
    "check_report": check_report,
    "owed_generations": owed_generations,
    "lost_ranges": lost_ranges,
    "drain_order": drain_order,
    "rotated_candidates": rotated_candidates,
    "line_offsets": line_offsets,
    "rotating_ndjson_scan": rotating_ndjson_scan,
    "rotating_ndjson_follow": rotating_ndjson_follow,
    "rotating_ndjson_bounded": rotating_ndjson_bounded,
    "follow_rounds": follow_rounds,
    "open_lines_withheld": open_lines_withheld,
    "open_lines_after_rotation": open_lines_after_rotation,
    "line_boundaries": line_boundaries,
    "stripped_lines": stripped_lines,
    "ndjson_round_trip": ndjson_round_trip,
    "journal_events": journal_events,
    "journal_rejects": journal_rejects,
    "journal_resume": journal_resume,
    "journal_after": journal_after,
    "ingest_envelopes": ingest_envelopes,
    "unique_events": unique_events,
    "envelope_rejects": envelope_rejects,
    "envelope_batches": envelope_batches,
    "envelope_files": envelope_files,
}
