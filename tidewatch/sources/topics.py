"""Broker topics as record streams and tables.

The connector assigns partitions directly and keeps the offsets in the query's
own checkpoint; no consumer group takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

COLUMNS = ("topic", "partition", "offset", "timestamp", "key", "value")
START = {"beginning": "earliest", "end": "latest"}


def stream_options(
    servers: str, topics: list[str], start_from: str = "beginning", batch: int = 500_000
) -> dict[str, str]:
    """Options of a topic stream. batch bounds the records of one micro-batch;
    start_from is beginning, end, or a startingOffsets text."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": START.get(start_from, start_from),
        "maxOffsetsPerTrigger": str(batch),
        "failOnDataLoss": "true",
    }


def read_topics(spark: SparkSession, servers: str, topics: list[str], **options) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .options(**stream_options(servers, topics, **options))
        .load()
        .select(*COLUMNS)
    )


def read_whole_topics(spark: SparkSession, servers: str, topics: list[str]) -> DataFrame:
    """Everything the topics hold now, from their first offset, for an audit."""
    return (
        spark.read.format("kafka")
        .options(**{
            "kafka.bootstrap.servers": servers,
            "subscribe": ",".join(topics),
            "startingOffsets": "earliest",
            "endingOffsets": "latest",
        })
        .load()
        .select(*COLUMNS)
    )


def topic_partitions(records: DataFrame) -> DataFrame:
    """Partitions of record tables with their first offset and the one after the last."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("end_offset")
    )
