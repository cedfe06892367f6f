"""Following very many line files in rounds that Spark plans itself.

The rotating_ndjson source plans on the driver, which is enough for some
sources. A round here lists the files of all sources in tasks, works out what is
owed with the same joins as the batch operator, cuts it into byte ranges and
reads these in tasks. It stores, below one folder:

    plan/round=<n>/       the byte ranges, fixed before anything is read
    lines/round=<n>/      the lines
    lost/round=<n>/       checkpoints whose file is gone
    positions/            where each source stands; only sources that moved are written

A round is complete when its positions are written. One that died is done again
from its plan, with the same lines, before the next one is planned. The files
must be on a folder that driver and executors share.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewatch.operators.generations import owed_generations
from tidewatch.operators.shuffles import lookup_join
from tidewatch.schemas import LINE
from tidewatch.session import ship_package
from tidewatch.sinks.latest import LatestTable
from tidewatch.sources.files import read_manifest
from tidewatch.sources.rotating_ndjson import RANGE_BYTES, ByteRange, last_line_end, read_range

_PLAN = (
    "source string, path string, file_id long, generation long, start long, stop long, closed boolean, live boolean"
)
_LOST = "source string, file_id long, lost_after_offset long, reason string"


def _positions(spark: SparkSession, path: str) -> LatestTable:
    return LatestTable(spark, f"{path}/positions", ["source"], "source string, file_id long, offset long")


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How far a live file has complete lines; the others are read whole."""
    for frame in batches:
        stops = []
        for row in frame.itertuples(index=False):
            try:
                stops.append(last_line_end(row.path, row.size, row.start) if row.live else row.size)
            except OSError:  # rotated since it was listed: the next round reads it
                stops.append(row.start)
        yield frame.assign(stop=stops, closed=~frame["live"])[[c.split()[0] for c in _PLAN.split(", ")]]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield from read_range(ByteRange(
                row["source"], row["path"], row["file_id"], row["generation"], row["low"], row["high"], row["stop"],
                row["closed"],
            ))


def _plan(spark: SparkSession, routes: DataFrame, path: str, number: int, start_from: str) -> None:
    saved = _positions(spark, path).read()
    owed, lost = owed_generations(read_manifest(routes, saved), saved, start_from)
    # where a source starts at the end of its live file, that is the end of its last complete line
    first = F.when(F.col("start_offset") >= F.col("size"), F.lit(0)).otherwise(F.col("start_offset"))
    begun = lookup_join(owed, saved.select("source", F.lit(True).alias("known")), ["source"], "left")
    files = begun.select(
        "source", "path", "file_id", F.unix_micros("mtime").alias("generation"),
        F.when(F.col("known").isNull() & F.lit(start_from == "end"), first).otherwise(F.col("start_offset")).alias("start"),
        "size", (F.col("phase") == 3).alias("live"), F.col("known").isNull().alias("fresh"),
    )
    fixed = files.mapInPandas(_ends, _PLAN)
    if start_from == "end":
        new = files.filter("fresh").select("source", F.lit(True).alias("_new"))
        fixed = lookup_join(fixed, new.distinct(), ["source"], "left").withColumn(
            "start", F.when(F.col("_new"), F.col("stop")).otherwise(F.col("start"))
        ).drop("_new")
    lost.select("source", "file_id", "lost_after_offset", "reason").write.mode("overwrite").parquet(f"{path}/lost/round={number}")
    fixed.write.mode("overwrite").parquet(f"{path}/plan/round={number}")


def _done(spark: SparkSession, folder: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def follow_round(
    routes: DataFrame, path: str, start_from: str = "end", range_bytes: int = RANGE_BYTES
) -> int:
    """Read what has come since the last round and return the round's number.

    routes: name, path, rotated_glob of each source. start_from (beginning or
    end) says where a source begins that was never read. One job at a time
    follows into a folder.
    """
    spark = routes.sparkSession
    ship_package(spark)
    table = _positions(spark, path)
    number = table.last() + 1
    if not _done(spark, f"{path}/plan/round={number}"):
        _plan(spark, routes, path, number, start_from)
    plan = spark.read.schema(_PLAN).parquet(f"{path}/plan/round={number}")
    step = F.lit(range_bytes).cast("long")
    cut = plan.filter("start < stop").select("*", F.explode(F.sequence("start", F.col("stop") - 1, step)).alias("low"))
    ranges = cut.withColumn("high", F.least(F.col("low") + step, F.col("stop"))).repartition("path", "low")
    lines = ranges.mapInArrow(_lines, LINE)
    lines.write.mode("overwrite").parquet(f"{path}/lines/round={number}")
    last = F.struct(F.col("live").cast("int"), "generation", "file_id")
    ends = plan.groupBy("source").agg(F.max_by("file_id", last).alias("file_id"), F.max_by("stop", last).alias("offset"))
    held = table.read().select("source", F.col("file_id").alias("_file"), F.col("offset").alias("_at"))
    moved = lookup_join(ends, held, ["source"], "left").filter(
        F.col("_file").isNull() | (F.col("_file") != F.col("file_id")) | (F.col("_at") != F.col("offset"))
    )
    table.write(moved.select("source", "file_id", "offset"), number)
    return number


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all complete rounds."""
    last = _positions(spark, path).last()
    if last < 1:
        return spark.createDataFrame([], LINE)
    rows = spark.read.schema(T.StructType([*LINE.fields, T.StructField("round", T.LongType())])).parquet(f"{path}/lines")
    return rows.filter(F.col("round") <= last).drop("round")


def lost_of(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoints whose file was gone, with the round that first missed it."""
    rows = spark.read.schema(f"{_LOST}, round long").parquet(f"{path}/lost")
    keys = ["source", "file_id", "lost_after_offset", "reason"]
    return rows.filter(F.col("round") <= _positions(spark, path).last()).groupBy(*keys).agg(F.min("round").alias("round"))


def positions_of(spark: SparkSession, path: str) -> DataFrame:
    """source, file_id and offset of every source that was read."""
    return _positions(spark, path).read()
