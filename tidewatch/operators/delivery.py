"""Delivery bookkeeping: what may be committed, what became of each attempt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.operators.shuffles import lookup_join, null_safe_join, pin

# How a forwarded line ended, as recorded in the delivery ledger.
BLANK = "blank"                  # nothing to send
MALFORMED = "malformed"          # not JSON, skipped
UNDELIVERABLE = "undeliverable"  # refused before it was queued
DELIVERED = "delivered"          # acknowledged
FAILED = "failed"                # queued, then reported as not delivered
PENDING = "pending"              # queued, no answer yet

_SETTLED = (BLANK, MALFORMED, UNDELIVERABLE, DELIVERED)
_PRODUCED = (DELIVERED, FAILED, PENDING)


def is_settled(outcome: Column) -> Column:
    """Whether the line never has to be read again."""
    return outcome.isin(*_SETTLED)


def apply_acks(lines: DataFrame, acks: DataFrame) -> DataFrame:
    """Mark lines settled when an acknowledgement with their number exists.

    Acknowledgements may repeat; they are reduced to one per line first. Lines
    without a source are those of one source, here and below.
    """
    once = acks.select("source", "seq").distinct().withColumn("_acked", F.lit(True))
    return null_safe_join(lines, once, ["source", "seq"], "left").select(
        *lines.columns, F.coalesce("_acked", F.lit(False)).alias("settled")
    )


def first_unsettled(ledger: DataFrame) -> DataFrame:
    """The lowest unsettled number per source, stored for reuse."""
    return pin(
        ledger.filter(~F.col("settled")).groupBy("source").agg(F.min("seq").alias("_gap"))
    )


def committed_prefix(ledger: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """Per source: the position of the last line before the first unsettled one,
    and how many lines are in flight from that one on.

    ledger: source, seq, file_id, end_offset, settled. initial: source, file_id,
    offset of earlier checkpoints, used where nothing is committed yet. A source
    with a checkpoint and no lines keeps its position.
    """
    lines = ledger.select("source", "seq", "file_id", "end_offset", "settled")
    marked = lookup_join(lines, first_unsettled(lines), ["source"], "left")
    behind = F.col("_gap").isNull() | (F.col("seq") < F.col("_gap"))
    position = F.when(behind, F.col("seq"))
    committed = marked.groupBy("source").agg(
        F.max_by("file_id", position).alias("file_id"),
        F.max_by("end_offset", position).alias("offset"),
        F.max(position).alias("_last"),
        F.count_if(~behind).alias("in_flight"),
    )
    return _with_checkpoints(committed, initial)


def committed_blocks(blocks: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """committed_prefix of summaries of blocks of lines.

    blocks: source, block, first_open (the lowest open number, or NULL), lines,
    in_flight (lines from that one on), and last_seq, file_id, offset of the
    last line before it.
    """
    gaps = blocks.filter(F.col("first_open").isNotNull()).groupBy("source").agg(F.min("block").alias("_gap"))
    marked = lookup_join(blocks, pin(gaps), ["source"], "left")
    behind = F.col("_gap").isNull() | (F.col("block") <= F.col("_gap"))
    position = F.when(behind, F.col("last_seq"))
    committed = marked.groupBy("source").agg(
        F.max_by("file_id", position).alias("file_id"),
        F.max_by("offset", position).alias("offset"),
        F.max(position).alias("_last"),
        F.sum(
            F.when(F.col("block") == F.col("_gap"), F.col("in_flight")).when(~behind, F.col("lines")).otherwise(0)
        ).alias("in_flight"),
    )
    return _with_checkpoints(committed, initial)


def _with_checkpoints(committed: DataFrame, initial: DataFrame | None) -> DataFrame:
    """Positions, with those of earlier checkpoints where nothing is committed yet."""
    if initial is None:
        return committed.select(
            "source", "file_id", F.coalesce("offset", F.lit(0)).alias("offset"), "in_flight"
        )
    start = initial.select(
        F.col("source").alias("_source"), F.col("file_id").alias("_file_id"), F.col("offset").alias("_offset")
    )
    fresh = F.col("_last").isNull()
    return committed.join(start, F.col("source").eqNullSafe(F.col("_source")), "full").select(
        F.coalesce("source", "_source").alias("source"),
        F.when(fresh, F.col("_file_id")).otherwise(F.col("file_id")).alias("file_id"),
        F.coalesce(
            F.when(fresh, F.col("_offset")).otherwise(F.col("offset")), F.lit(0)
        ).alias("offset"),
        F.coalesce("in_flight", F.lit(0)).alias("in_flight"),
    )


def delivery_stats(ledger: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """Counters and committed position per source. ledger carries `outcome`."""
    settled = ledger.withColumn("settled", is_settled(F.col("outcome")))
    outcome = F.col("outcome")
    counters = settled.groupBy("source").agg(
        F.count_if(outcome.isin(*_PRODUCED)).alias("produced"),
        F.count_if(outcome == DELIVERED).alias("acked"),
        F.count_if(outcome.isin(UNDELIVERABLE, FAILED)).alias("failed"),
        F.count_if(outcome == MALFORMED).alias("parse_errors"),
    )
    none = F.lit(0)
    return null_safe_join(committed_prefix(settled, initial), counters, ["source"], "left").select(
        "source",
        *[F.coalesce(c, none).alias(c) for c in ("produced", "acked", "failed", "parse_errors")],
        "in_flight", "file_id", "offset",
    )


def outcome_of(status: Column) -> Column:
    """Class of an HTTP answer; NULL status stands for a network error."""
    return (
        F.when(status.isNull(), "retryable")
        .when(status.between(200, 299), "ok")
        .when(status.isin(401, 403), "unauthorized")
        .when(status.isin(408, 429) | (status >= 500), "retryable")
        .otherwise("permanent")
    )


def delivery_outcome(attempts: DataFrame) -> DataFrame:
    """Add the outcome of each attempt and what to do with its batch."""
    outcome = outcome_of(F.col("status"))
    disposition = (
        F.when(outcome == "ok", "ack")
        .when(outcome == "unauthorized", "halt")
        .when(outcome == "permanent", "dead")
        .otherwise("retry")
    )
    return attempts.select("*", outcome.alias("outcome"), disposition.alias("disposition"))
