"""Streaming jobs: ingest into the ledger, running audits, live counters."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewatch.operators.audit import range_audit, sequence_numbers
from tidewatch.operators.delivery import committed_blocks
from tidewatch.operators.normalize import classify
from tidewatch.sinks.key_index import KeyIndex, hashed
from tidewatch.sinks.latest import LatestTable
from tidewatch.sinks.ledger import KEYS, REJECTED, commit_batch, run_of, store_batch, stored_keys
from tidewatch.streaming import stateful


def start(writer, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a stream writer; without an interval it drains what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def ingest(records: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Records into the ledger under path, each alert once, whatever is replayed.

    There is no watermark: a late alert, or one without a time, lands like any
    other.
    """
    return start(
        records.writeStream.queryName("ingest").foreachBatch(commit_batch(path)), checkpoint, every
    )


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the query that a checkpoint belongs to; None before its first start."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def ingest_with_state(
    records: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """As ingest, with the seen keys in the state store: a batch looks nothing up in files.

    Every message gets its disposition and is stored in the ledger as by ingest,
    so that counters, offsets and winners are the same. Copies are reduced in
    the map tasks, so a hot key reaches its state as a few rows. A new
    checkpoint starts with all keys that other runs have stored.
    """
    spark = records.sparkSession
    judged = classify(records, "value")
    messages = judged.select(
        *hashed(*KEYS),
        *[F.col(f"source_{c}").alias(c) for c in ("topic", "partition", "offset")],
        "value",
        F.when(F.col("reject_reason").isNotNull(), REJECTED).alias("disposition"),
    )
    known = stored_keys(spark, path, query_id(spark, checkpoint))

    def store(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        store_batch(classify(batch, "disposition"), path, run_of(own), batch_id, KeyIndex(own, path, KEYS))

    disposed = stateful.with_dispositions(messages, known)
    return start(
        disposed.writeStream.queryName("ingest_with_state").outputMode("update").foreachBatch(store), checkpoint, every
    )


def _kept(changes: DataFrame, table: LatestTable, name: str, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = changes.writeStream.queryName(name).outputMode("update")
    return start(writer.foreachBatch(lambda batch, batch_id: table.write(batch, batch_id)), checkpoint, every)


def _ranges(spark: SparkSession, path: str) -> LatestTable:
    return LatestTable(spark, f"{path}/ranges", ["block"], stateful.RANGE_BLOCK)


def running_audit(
    records: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep the ranges of sequence numbers seen so far under path/ranges; audit
    them with audit_of. A batch merges its numbers into the blocks they belong
    to and touches no others; a gap closes when its number arrives later."""
    changes = stateful.range_blocks(sequence_numbers(records))
    return _kept(changes, _ranges(records.sparkSession, path), "running_audit", checkpoint, every)


def audit_of(spark: SparkSession, path: str) -> DataFrame:
    """Audit of everything a running_audit has kept so far."""
    return range_audit(_ranges(spark, path).read())


def _positions(spark: SparkSession, path: str) -> LatestTable:
    return LatestTable(spark, f"{path}/positions", ["source", "block"], stateful.LINE_BLOCK)


def running_commits(
    lines: DataFrame, path: str, checkpoint: str, every: str | None = None, report_ms: int | None = None
) -> StreamingQuery:
    """Keep what may be committed of each source under path/positions; see
    commits_of. lines: source, seq, file_id, end_offset, settled, and
    acknowledgements, which have no end_offset. With report_ms a block's changes
    are given out that long after the first of them, by a timer."""
    changes = stateful.line_blocks(lines, report_ms)
    return _kept(changes, _positions(lines.sparkSession, path), "running_commits", checkpoint, every)


def commits_of(spark: SparkSession, path: str, initial: DataFrame | None = None) -> DataFrame:
    """The committed position of each source and its lines in flight, as committed_prefix has them."""
    return committed_blocks(_positions(spark, path).read(), initial)


def observed(classified: DataFrame, name: str = "ingest") -> DataFrame:
    """Count messages and rejects on the way through; see Progress."""
    return classified.observe(
        name,
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
    )


def observe_batch(df: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """Batch form of observed, with the observation that will hold the counts."""
    observation = Observation(name)
    return (
        df.observe(
            observation,
            F.count(F.lit(1)).alias("consumed"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
        ),
        observation,
    )


class Progress(StreamingQueryListener):
    """Adds up observed counters and rows per query, for periodic reporting."""

    def __init__(self) -> None:
        self.totals: dict[str, int] = {}
        self.batches = 0
        self.failures: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        for metrics in event.progress.observedMetrics.values():
            for name, value in metrics.asDict().items():
                self.totals[name] = self.totals.get(name, 0) + value

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures.append(event.exception)
