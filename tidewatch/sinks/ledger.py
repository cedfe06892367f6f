"""The ingest ledger: one write per batch that holds rows and offsets together.

Each batch writes every message it consumed, with its disposition, into a folder
of its own, named by the run (the streaming query's id, which belongs to its
checkpoint) and the batch. Findings, next offsets and counters are all read from
those rows, so they cannot disagree. A replayed batch replaces its folder with
the same rows; a job with a new checkpoint is a new run beside the old ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewatch.operators.normalize import classify
from tidewatch.operators.shuffles import BROADCAST_BYTES, BROADCAST_ROWS, first_copy, gathered, is_small, null_safe_join
from tidewatch.schemas import FINDING, LEDGER
from tidewatch.sinks.key_index import TASK_KEYS, KeyIndex, hashed

KEYS = ("manager", "alert_id")
POSITION = ("source_topic", "source_partition", "source_offset")

INSERTED = "inserted"
DUPLICATE = "duplicate"
REJECTED = "rejected"


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/ledger"


def _exists(spark: SparkSession, folder: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


#: The run of batches that no streaming query wrote.
DIRECT = "direct"


def read_ledger(
    spark: SparkSession, path: str, below: int | None = None, run: str = DIRECT
) -> DataFrame:
    """Ledger rows. With a number, those that were there before this batch of the
    run: lower batches of the run, and all other runs.

    A batch's files appear together when it is complete, so readers see whole
    batches only.
    """
    folder = _folder(path)
    if not _exists(spark, folder):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(folder)
    return rows if below is None else rows.filter((F.col("run") != run) | (F.col("batch_id") < below))


def create_tables(spark: SparkSession, path: str, table: str = "findings_ledger") -> str:
    """Declare the ledger in the catalog and a view of its findings; repeatable.

    Returns the view's name, which is the table's without `_ledger`, or with
    `_findings` behind it, so that ledgers beside each other have views of their own.
    """
    view = table.removesuffix("_ledger") if table.endswith("_ledger") else f"{table}_findings"
    if not _exists(spark, _folder(path)):
        spark.createDataFrame([], LEDGER).write.partitionBy("run", "batch_id").parquet(_folder(path))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LEDGER.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY (run, batch_id) LOCATION '{_folder(path)}'"
    )
    spark.catalog.recoverPartitions(table)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {', '.join(FINDING.fieldNames())} "
        f"FROM {table} WHERE disposition = '{INSERTED}'"
    )
    return view


def new_rows(batch: DataFrame, history: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Rows of the batch whose key is not in the history; the existing row wins.

    If the batch's keys fit a broadcast, the history is scanned for them where it
    lies and only the matches move; a larger batch is worth shuffling it.
    """
    known = history.select(*keys)
    wanted = batch.select(*keys)
    if is_small(wanted):
        known = known.join(F.broadcast(wanted), list(keys), "left_semi")
    return batch.join(known, list(keys), "left_anti")


#: Offsets of one of Spark's bitmaps, as a power of two, and how many bitmaps are broadcast at most.
BITMAP_BITS = 15
BITMAPS = BROADCAST_BYTES // (1 << BITMAP_BITS - 3)


def _placed(rows: DataFrame) -> DataFrame:
    """The rows with _map, a bitmap among those of a partition, and _bit, the position in it; no offset is a bitmap of its own."""
    offset = F.col("source_offset").cast("bigint")
    bit = F.coalesce(offset.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)), F.lit(0))
    return rows.withColumns({"_map": F.shiftright(offset, BITMAP_BITS), "_bit": bit})


MAP = (*POSITION[:2], "_map")


def position_bitmaps(positions: DataFrame) -> DataFrame | None:
    """Different positions as MAP and _bits, a row for each 32,768 offsets of a partition.

    None if these are too many for a broadcast, or if positions repeat, which a
    bitmap cannot tell.
    """
    placed = _placed(positions.select(*POSITION))
    maps, rows = placed.groupBy(*MAP).count().agg(F.count("*"), F.sum("count")).first()
    if maps > BITMAPS or placed.select(*MAP, "_bit").distinct().count() != rows:
        return None
    return placed.repartition(*MAP).groupBy(*MAP).agg(F.expr("bitmap_construct_agg(_bit)").alias("_bits"))


def with_marks(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows with _marked, whether their position is in the bitmaps, which are broadcast."""
    met = null_safe_join(_placed(rows), F.broadcast(bitmaps), MAP, "left")
    byte = F.expr("conv(hex(substring(_bits, int(_bit div 8) + 1, 1)), 16, 10)").cast("int")
    marked = F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1
    return met.select(*rows.columns, F.coalesce(marked, F.lit(False)).alias("_marked"))


def dispose(
    classified: DataFrame,
    unseen: Callable[[DataFrame], DataFrame] | None = None,
    kept: Callable[[DataFrame, int], DataFrame] = lambda rows, most: rows,
) -> DataFrame:
    """Add the disposition of every classified message.

    unseen: given the first copies (KEYS and POSITION), the stored positions of
    those that were not there before; without it nothing was. kept: given rows
    and how many they are at most, the same rows, stored to be read again.

    Winners are chosen on keys and positions alone: first copies are reduced in
    each map task, compared with the stored keys, and joined back on the
    position, which is unique. A key with very many copies never collects its
    messages in one task. The documents of a batch stay where they are if the
    winners, or else the other copies, were measured to fit a broadcast, or the
    winners' positions as bitmaps; else they are shuffled once. Positions shrink
    so much in a shuffle that Spark would take millions for a small side, so
    those of many winners are merged.
    """
    alerts = classified.filter(F.col("reject_reason").isNull()).select(*KEYS, *POSITION)
    winners = first_copy(alerts, KEYS, POSITION)
    marks, marked, others, bitmaps = winners.hint("merge"), INSERTED, DUPLICATE, None
    if unseen is not None:
        winners = unseen(winners)
        marks = winners.hint("merge")
        if is_small(winners):
            marks = F.broadcast(winners)
        elif alerts.count() - winners.count() <= BROADCAST_ROWS:
            copies = kept(null_safe_join(alerts.select(*POSITION), marks, POSITION, "left_anti").distinct(), BROADCAST_ROWS)
            if is_small(copies):
                marks, marked, others = F.broadcast(copies), DUPLICATE, INSERTED
        else:
            bitmaps = position_bitmaps(winners)
    if bitmaps is None:
        joined = null_safe_join(classified, marks.select(*POSITION, F.lit(True).alias("_marked")), POSITION, "left")
    else:
        joined = with_marks(classified, bitmaps)
    return joined.select(
        *classified.columns,
        F.when(F.col("reject_reason").isNotNull(), REJECTED)
        .when(F.col("_marked"), marked)
        .otherwise(others)
        .alias("disposition"),
    )


def commit_batch(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that writes a micro-batch of records to the ledger.

    History is what all other runs stored and the batches of this run before
    this one: a replay must not meet its own rows. It is looked up in the key
    index, whose cost goes with the batch and not with what was ever stored. A
    batch of another run that died before its keys were indexed is looked up
    in its ledger folder.
    """

    def commit(records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        run = run_of(spark)
        index = KeyIndex(spark, path, KEYS)
        if not index.exists() and _exists(spark, _folder(path)):
            index.build(read_ledger(spark, path).filter(F.col("disposition") == INSERTED))
        held: list[DataFrame] = []

        def kept(rows: DataFrame, most: int) -> DataFrame:
            held.append(gathered(rows, most, TASK_KEYS).persist(StorageLevel.MEMORY_AND_DISK))
            return held[-1]

        def unseen(firsts: DataFrame) -> DataFrame:
            alerts = classified.filter(F.col("reject_reason").isNull()).count()
            rows = kept(firsts.select(*POSITION, *hashed(*KEYS)), alerts)
            known = [index.known(rows.select("hi", "lo"), run, batch_id)]
            for other in index.unindexed(run, batch_id):
                folder = _batch_folder(path, *other)
                if _exists(spark, folder):
                    known.append(_inserted_keys(spark, folder).select(*hashed(*KEYS)))
            for keys in known:
                if keys is not None:
                    rows = rows.join(keys, ["hi", "lo"], "left_anti")
            return kept(rows.select(*POSITION), alerts)

        # documents are streamed from disk: a block that was put out of memory is read back in one piece, however large it is
        classified = classify(records).persist(StorageLevel.DISK_ONLY)
        held.append(classified)
        try:
            store_batch(dispose(classified, unseen, kept), path, run, batch_id, index)
        finally:
            index.release()
            for df in held:
                df.unpersist()

    return commit


def store_batch(disposed: DataFrame, path: str, run: str, batch_id: int, index: KeyIndex) -> None:
    """Write the classified messages of a batch with their dispositions, and make their keys known."""
    rejected = F.col("disposition") == REJECTED
    blank = [
        F.when(~rejected, F.col(field.name)).alias(field.name)
        if field.name not in (*POSITION, "ingested_at")
        else F.col(field.name)
        for field in FINDING.fields
    ]
    rows = disposed.select(*blank, "disposition", "reject_reason", "preview", "rejected_value")
    folder = _batch_folder(path, run, batch_id)
    index.begin(run, batch_id)
    rows.sortWithinPartitions("disposition", "ts").write.mode("overwrite").parquet(folder)
    index.add(_inserted_keys(disposed.sparkSession, folder), run, batch_id)
    index.end(run, batch_id)
    index.merge()
    index.sweep()


def run_of(spark: SparkSession) -> str:
    """The run that a foreachBatch function works for."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or DIRECT


def stored_keys(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """hi, lo and position of all stored alerts, without those of a run."""
    rows = read_ledger(spark, path).filter(F.col("disposition") == INSERTED)
    rows = rows if run is None else rows.filter(F.col("run") != run)
    return rows.select(
        *hashed(*KEYS), *[F.col(f"source_{c}").alias(c) for c in ("topic", "partition", "offset")]
    )


def _batch_folder(path: str, run: str, batch_id: int) -> str:
    return f"{_folder(path)}/run={run}/batch_id={batch_id}"


def _inserted_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.schema(LEDGER).parquet(folder)
    return rows.filter(F.col("disposition") == INSERTED).select(*KEYS)


def findings(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("disposition") == INSERTED).select(*FINDING.fieldNames())


def rejects(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("disposition") == REJECTED).select(
        *POSITION, "reject_reason", "preview", "rejected_value", "run", "batch_id"
    )


def next_offsets(ledger: DataFrame) -> DataFrame:
    """Offset to continue from per partition; rejected messages count as read."""
    return ledger.groupBy(
        F.col("source_topic").alias("topic"), F.col("source_partition").alias("partition")
    ).agg((F.max("source_offset") + 1).alias("next_offset"))


def _counters() -> list[Column]:
    disposition = F.col("disposition")
    return [
        F.count("*").alias("consumed"),
        F.count_if(disposition == INSERTED).alias("inserted"),
        F.count_if(disposition == DUPLICATE).alias("duplicates"),
        F.count_if(disposition == REJECTED).alias("rejected"),
    ]


def ingest_stats(ledger: DataFrame) -> DataFrame:
    """Consumed, inserted, duplicates and rejected, in one row."""
    return ledger.agg(*_counters())


def batch_stats(ledger: DataFrame) -> DataFrame:
    """The counters of each batch of each run, for periodic reports."""
    return ledger.groupBy("run", "batch_id").agg(*_counters())


def resolve_start(
    partitions: DataFrame, offsets: DataFrame, start_from: str = "beginning"
) -> DataFrame:
    """Where to start each partition: its stored offset, else its first or last.

    partitions: topic, partition, first_offset, end_offset.
    """
    default = F.col("first_offset" if start_from == "beginning" else "end_offset")
    saved = offsets.select("topic", "partition", "next_offset")
    return (
        partitions.join(saved, ["topic", "partition"], "left")
        .select(
            "topic",
            "partition",
            F.coalesce("next_offset", default).alias("start_offset"),
            F.col("next_offset").isNotNull().alias("resumed"),
        )
        .orderBy("topic", "partition")
    )


def starting_offsets_json(starts: DataFrame) -> DataFrame:
    """resolve_start rows as the text the broker source takes as startingOffsets."""
    per_topic = starts.groupBy("topic").agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(F.struct(F.col("partition").cast("string"), "start_offset"))
            )
        ).alias("offsets")
    )
    return per_topic.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("topic", "offsets")))).alias(
            "starting_offsets"
        )
    )
