"""What the training-data operators share: input columns, stored tables, batches of texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import checkpoint_dir, ship_package

#: What separates words: space, tab and the other ASCII line and page breaks.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (a null text is empty), with the named columns; nothing else of the input is read."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


KEYS = ["key_id", "key_text"]


def key_columns() -> list[Column]:
    """Name a row in joins.

    Rows that agree in both have the same text, so that repeated rows, rows
    without an id and ids used twice need no number of their own.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)), F.hash(text)]


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """texts_of() with the columns key_id and key_text of key_columns()."""
    return texts_of(docs, *more).withColumns(dict(zip(KEYS, key_columns(), strict=True)))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    It cuts the lineage: what reads it can be run again after executors are
    lost, without what lies before it, and always sees the same rows.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_ready(spark: SparkSession) -> None:
    ship_package(spark)


def tasks_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pmod_hash(n: int, *cols: Column | str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def crc_rest(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a row without an id has rest 0, so that nothing is learnt from it."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n)), F.lit(0))


def slices(batches: Iterator[pd.DataFrame], size: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """Cut batches into frames whose texts have about so many characters together."""
    for frame in batches:
        if not len(frame):
            continue
        ends = frame["text"].str.len().to_numpy().cumsum()
        begin, total = 0, len(frame)
        while begin < total:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield frame.iloc[begin:end]
            begin = end


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finishing step of a splitmix generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def greatest(rows: DataFrame, column: str, limit: int) -> DataFrame:
    """The rows with the greatest values of a positive column, at most so many.

    Values are grouped in quarter powers of two, and whole groups are taken,
    from the greatest down. Only the groups' sizes reach the driver; no task
    has to order what all others hold.
    """
    stepped = rows.withColumn("_step", F.floor(4 * F.log2(column)))
    least, held = None, 0
    for r in stepped.groupBy("_step").agg(F.count("*").alias("n")).orderBy(F.desc("_step")).collect():
        held += r["n"]
        if held > limit:
            break
        least = r["_step"]
    return stepped.filter(F.lit(False) if least is None else F.col("_step") >= least).drop("_step")
