"""Plain file sources: journal exports, queue folders, generation manifests."""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.operators.generations import at_line_boundary
from tidewatch.operators.shuffles import dealt
from tidewatch.schemas import MANIFEST
from tidewatch.session import ship_package

#: Routes whose folders one task lists, about.
TASK_ROUTES = 2000


def read_journal(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Lines of `journalctl -o json` exports; gzip files are read as they are."""
    reader = spark.readStream if stream else spark.read
    return reader.format("text").load(path)


def read_queue(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Pending queue files, oldest first by name: only *.json in the folder
    itself, so dead letters and half-written files stay out."""
    rows = (
        spark.read.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.json")
        .load(path)
    )
    return rows.select(
        F.lit(source if source is not None else path).alias("source"),
        F.col("_metadata.file_name").alias("queue_key"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").alias("body"),
    ).orderBy("queue_key")


def _list_generations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for row in batch.itertuples(index=False):
            home = os.path.dirname(os.path.abspath(row.path))
            if not os.path.isdir(home):
                continue
            home_device = os.stat(home).st_dev
            patterns = [glob.escape(row.path) + ".*"]
            if isinstance(row.rotated_glob, str):
                patterns.append(row.rotated_glob)
            names = {os.path.abspath(p) for pattern in patterns for p in glob.glob(pattern)}
            names.discard(os.path.abspath(row.path))
            for path, is_live in [(os.path.abspath(row.path), True), *((n, False) for n in sorted(names))]:
                try:
                    status = os.stat(path)
                    before = None
                    if row.offset == row.offset and row.offset and row.offset <= status.st_size:
                        with open(path, "rb") as handle:
                            handle.seek(int(row.offset) - 1)
                            before = handle.read(1)
                except OSError:
                    continue
                found.append((
                    row.source, path, status.st_ino, status.st_dev, home_device,
                    pd.Timestamp(status.st_mtime_ns // 1000, unit="us", tz="UTC"),
                    status.st_size, is_live, before,
                    None if row.offset != row.offset else row.offset,
                ))
        yield pd.DataFrame(found, columns=[*_LISTED])


_LISTED = (
    "source", "path", "file_id", "device", "home_device", "mtime", "size", "is_live",
    "before", "offset",
)
_LISTED_SCHEMA = (
    "source string, path string, file_id long, device long, home_device long, "
    "mtime timestamp, size long, is_live boolean, before binary, offset double"
)


def read_manifest(routes: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Look up the generations of every route on a folder all executors share.

    File identity and devices are not offered by the built-in file sources, so
    each task lists the folders of its own routes. routes: name, path,
    rotated_glob. checkpoint: source, file_id, offset.
    """
    ship_package(routes.sparkSession)
    wanted = routes.select(F.col("name").alias("source"), "path", "rotated_glob").join(
        checkpoint.select("source", F.col("offset").cast("double").alias("offset")), "source", "left"
    )
    listed = dealt(wanted, ["source", "path"], TASK_ROUTES).mapInPandas(_list_generations, _LISTED_SCHEMA)
    offset = F.col("offset").cast("long")
    return listed.withColumn(
        "resumable", at_line_boundary(offset, F.col("size"), F.col("before"))
    ).select(*MANIFEST.fieldNames())
