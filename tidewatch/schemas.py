"""Row shapes exchanged between the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# A broker record as every topic-facing function receives it.
RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])

FINDING = T.StructType([
    T.StructField("manager", T.StringType()),
    T.StructField("alert_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("rule_id", T.StringType()),
    T.StructField("rule_level", T.ShortType()),
    T.StructField("rule_description", T.StringType()),
    T.StructField("rule_groups", T.ArrayType(T.StringType())),
    T.StructField("mitre_ids", T.ArrayType(T.StringType())),
    T.StructField("mitre_tactics", T.ArrayType(T.StringType())),
    T.StructField("agent_id", T.StringType()),
    T.StructField("agent_name", T.StringType()),
    T.StructField("agent_ip", T.StringType()),
    T.StructField("decoder", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("src_user", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("source_topic", T.StringType()),
    T.StructField("source_partition", T.IntegerType()),
    T.StructField("source_offset", T.LongType()),
    T.StructField("ingested_at", T.TimestampType()),
])

# One row per consumed message: the finding columns, what became of the
# message, and for a rejected one why, how it began, and the whole of it.
LEDGER = T.StructType(FINDING.fields + [
    T.StructField("disposition", T.StringType()),
    T.StructField("reject_reason", T.StringType()),
    T.StructField("preview", T.StringType()),
    T.StructField("rejected_value", T.BinaryType()),
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("collected_at", T.TimestampType()),
    T.StructField("host", T.StringType()),
    T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
])

ENVELOPE = T.StructType([
    T.StructField("agent_id", T.StringType()),
    T.StructField("sent_at", T.TimestampType()),
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("events", T.ArrayType(EVENT)),
])

# A complete line of a growing file; end_offset is the byte just after it.
LINE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("file_id", T.LongType()),
    T.StructField("generation", T.LongType()),
    T.StructField("end_offset", T.LongType()),
    T.StructField("value", T.BinaryType()),
])

# A line of a journal export, the file it is in and the byte just after it.
ENTRY = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("end_offset", T.LongType()),
    T.StructField("value", T.BinaryType()),
])

MANIFEST = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("file_id", T.LongType()),
    T.StructField("device", T.LongType()),
    T.StructField("home_device", T.LongType()),
    T.StructField("mtime", T.TimestampType()),
    T.StructField("size", T.LongType()),
    T.StructField("is_live", T.BooleanType()),
    T.StructField("resumable", T.BooleanType()),
])
