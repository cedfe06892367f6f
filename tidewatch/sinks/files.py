"""File and broker outputs."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewatch.operators.envelopes import TIME_FORMAT, envelope_json
from tidewatch.session import ship_package

# Delivery settings a broker writer needs for at-least-once without reordering.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "lz4",
    "kafka.linger.ms": "50",
    "kafka.batch.size": "131072",
    "kafka.retries": "2147483647",
}


def write_topic(routed: DataFrame, servers: str, checkpoint: str | None = None, **options: str):
    """Write routed lines (topic, value) to a broker; a stream returns its query."""
    rows = routed.select("topic", "value")
    settings = {**PRODUCER_OPTIONS, "kafka.bootstrap.servers": servers, **options}
    if not rows.isStreaming:
        rows.write.format("kafka").options(**settings).save()
        return None
    return (
        rows.writeStream.format("kafka")
        .options(**settings)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_ndjson(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line and row."""
    text = F.to_json(F.struct("*"), {"timestampFormat": TIME_FORMAT})
    rows.select(text.alias("value")).write.mode(mode).text(path)


def write_envelopes(envelopes: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Envelopes as gzip-compressed JSON lines."""
    envelope_json(envelopes).write.mode(mode).option("compression", "gzip").text(path)


def _write_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        for path, value in zip(frame["path"], frame["value"], strict=True):
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "w", encoding="utf-8", newline="") as handle:
                handle.write(value)
        yield frame[["path"]]


def write_texts(texts: DataFrame, written: str) -> DataFrame:
    """Write each text (path, value) as a file of its own and return the paths, which are stored under `written`.

    Tasks write the files, so very many cost no listing and no commit one by
    one. The paths must be on a folder that driver and executors share; a task
    that is run again writes its files again.
    """
    spark = texts.sparkSession
    ship_package(spark)
    texts.select("path", "value").mapInPandas(_write_texts, "path string").write.parquet(written)
    return spark.read.schema("path string").parquet(written)


def rotate_files(paths: DataFrame, suffix: str = ".1") -> None:
    """Rename files (path), in tasks; one that was renamed before is left alone."""
    def rename(rows) -> None:
        for row in rows:
            if os.path.exists(row["path"]):
                os.rename(row["path"], row["path"] + suffix)

    ship_package(paths.sparkSession)
    paths.select("path").foreachPartition(rename)
