"""Event queues as tables: batches, retention, depth, dead letters.

A queue row is (source, queue_key, size, body); queue_key sorts oldest first
and is unique within its source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.json_text import computed_once, is_single_value, opens_object, parse_document
from tidewatch.operators.shuffles import null_safe_join, ranked_with_total, running_totals


def split_corrupt(queue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable, dead): a body that is no JSON object cannot be delivered, so it
    never takes a place in a batch."""
    parsed = computed_once(queue, _doc=parse_document(F.col("body")))
    readable = is_single_value(F.col("_doc"), F.col("body")) & opens_object(F.col("body"))
    return (
        parsed.filter(readable).select(*queue.columns),
        parsed.filter(~readable).select(*queue.columns),
    )


def pack_batch(queue: DataFrame, max_n: int = 0, max_bytes: int = 0) -> DataFrame:
    """Oldest events per source within both limits, at least one; 0 is no limit."""
    if max_n <= 0 and max_bytes <= 0:
        return queue
    ranked = ranked_with_total(queue, ["source"], ["queue_key"], F.col("size"), max_n)
    if max_bytes > 0:
        ranked = ranked.filter((F.col("_total") <= max_bytes) | (F.col("_rank") == 1))
    return ranked.select(*queue.columns)


def retain(queue: DataFrame, max_events: int = 0, max_bytes: int = 0) -> DataFrame:
    """Newest events per source within both limits; the newest one always stays.

    Dropping the oldest event until the next one fits leaves exactly the longest
    suffix within the limits, because a suffix only grows with arrivals.
    """
    if max_events <= 0 and max_bytes <= 0:
        return queue
    ranked = ranked_with_total(queue, ["source"], ["queue_key"], F.col("size"), max_events, descending=True)
    if max_bytes > 0:
        ranked = ranked.filter((F.col("_total") <= max_bytes) | (F.col("_rank") == 1))
    return ranked.select(*queue.columns)


def retention_report(queue: DataFrame, max_events: int = 0, max_bytes: int = 0) -> DataFrame:
    """Kept and dropped events per source."""
    total = queue.groupBy("source").agg(F.count("*").alias("_all"))
    kept = retain(queue, max_events, max_bytes).groupBy("source").agg(
        F.count("*").alias("kept"), F.sum("size").alias("kept_bytes")
    )
    return null_safe_join(total, kept, ["source"]).select(
        "source", "kept", "kept_bytes", (F.col("_all") - F.col("kept")).alias("dropped")
    )


def queue_depth(queue: DataFrame) -> DataFrame:
    return queue.groupBy("source").agg(
        F.count("*").alias("events"), F.sum("size").alias("bytes")
    )


def fifo(queue: DataFrame) -> DataFrame:
    """Events oldest first, with their place in their source's queue."""
    return running_totals(queue, ["source"], ["queue_key"], {"place": F.lit(1)}).orderBy(
        "source", "queue_key"
    )


def dead_letters(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Events of batches that will never be accepted. outcomes: queue_key, source,
    disposition."""
    refused = outcomes.filter(F.col("disposition") == "dead").select("source", "queue_key").distinct()
    return null_safe_join(queue, refused, ["source", "queue_key"], "left_semi")
