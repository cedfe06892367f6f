"""Processors that keep what they know of a key in RocksDB state.

State is cut into shards or blocks, never into one key for a hot source, and
what reaches it was reduced in the map tasks before. A processor gives out what
a batch changed; how that is stored is up to the jobs in ingest.py.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.session import ship_package, use_rocksdb_state

#: Shards of the seen keys. A checkpoint belongs to this number.
SHARDS = 1024
#: Parts of a shard's keys that are read and written at once. A checkpoint belongs to this number.
BUCKETS = 256
#: Keys of which a map task remembers the first position.
TASK_KEYS = 200_000
#: Numbers of a block, of lines or of sequences. A checkpoint belongs to this number.
BLOCK = 1 << 16


def block_of(number: str) -> Column:
    return F.floor(F.col(number) / BLOCK)


def _ready(df: DataFrame) -> None:
    use_rocksdb_state(df.sparkSession)
    ship_package(df.sparkSession)


# --- dispositions -------------------------------------------------------------------

_MESSAGE = "hi long, lo long, topic string, partition int, offset long, value binary, disposition string"
POSITION = ["topic", "partition", "offset"]


def _first_in_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Mark as duplicates the copies of keys of which this task has seen an earlier position."""
    best: dict[tuple[int, int], tuple] = {}
    for frame in batches:
        marks = frame["disposition"].tolist()
        rows = zip(frame["hi"], frame["lo"], frame["topic"], frame["partition"], frame["offset"], strict=True)
        for i, (hi, lo, topic, partition, offset) in enumerate(rows):
            if marks[i] is not None:
                continue
            place = (topic is not None, topic or "", partition, offset)
            known = best.get((hi, lo))
            if known is None or place < known:
                if len(best) >= TASK_KEYS:  # copies that are not reduced here are met in the state
                    best.clear()
                best[hi, lo] = place
            else:
                marks[i] = "duplicate"
        yield frame.assign(disposition=marks)


class FirstSeen(StatefulProcessor):
    """Whether a key was seen before, for the keys of a shard; the first position of the first batch wins.

    Each call of the state costs a round trip to the JVM, so a bucket's keys
    are one value of 16 bytes a key, to which a batch appends its new ones.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "bucket int", "keys binary")

    def _new(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Which of the keys are seen for the first time, at their first place; from now on they were."""
        keys = np.stack([hi, lo], axis=1).astype("<i8")
        at = (keys[:, 0] // SHARDS) % BUCKETS
        held = {int(b): (self.seen.getValue((int(b),)) or (b"",))[0] for b in np.unique(at)}
        before = np.frombuffer(b"".join(held.values()), dtype="<i8").reshape(-1, 2)
        fresh = ~pd.DataFrame(np.concatenate([before, keys])).duplicated().to_numpy()[len(before) :]
        added, at = keys[fresh], at[fresh]
        order = np.argsort(at, kind="stable")
        buckets, starts = np.unique(at[order], return_index=True)
        for bucket, rows in zip(buckets.tolist(), np.split(added[order], starts[1:]), strict=False):
            self.seen.updateValue((bucket,), (bytes(held[bucket]) + rows.tobytes(),))
        return fresh

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._new(initialState["hi"].to_numpy(), initialState["lo"].to_numpy())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:  # settled before: duplicates of an earlier row of their task, and rejects
            for frame in rows:
                yield frame[[*POSITION, "value", "disposition"]]
            return
        frame = pd.concat(list(rows), ignore_index=True)
        frame = frame.sort_values(["hi", "lo", *POSITION], na_position="first", ignore_index=True)
        new = self._new(frame["hi"].to_numpy(), frame["lo"].to_numpy())
        marks = np.where(new, "inserted", "duplicate").astype(object)
        yield frame.assign(disposition=marks)[[*POSITION, "value", "disposition"]]


def _shard() -> Column:
    """The shard of a key; rows that need no state are dealt out by their offsets, below zero."""
    return F.when(F.col("disposition").isNull(), F.pmod("hi", F.lit(SHARDS))).otherwise(
        -1 - F.pmod("offset", F.lit(SHARDS))
    ).cast("long")


def with_dispositions(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """topic, partition, offset, value and disposition of every message.

    messages: a stream of hi and lo (the key's hash), the position, value and
    disposition, which is null where the key decides. stored: hi, lo and
    position of keys that count as seen when the query starts for the first time.
    """
    _ready(messages)
    names = [c.split()[0] for c in _MESSAGE.split(", ")]
    reduced = messages.select(*names).mapInPandas(_first_in_task, _MESSAGE).withColumn("shard", _shard())
    initial = stored.select(F.pmod("hi", F.lit(SHARDS)).cast("long").alias("shard"), "hi", "lo", *POSITION)
    return reduced.groupBy("shard").transformWithStateInPandas(
        FirstSeen(), "topic string, partition int, offset long, value binary, disposition string", "Update", "None",
        initial.groupBy("shard"),
    )


# --- committed positions -------------------------------------------------------------

LINE_BLOCK = (
    "source string, block long, first_open long, lines long, in_flight long, "
    "last_seq long, file_id long, offset long"
)
_OPEN, _SETTLED, _EARLY = 0, 1, 2
#: Stands for NULL in columns of whole numbers, which pandas would make floats of and so round.
_NONE = -(1 << 63)


def merged_lines(held: np.ndarray, lines: np.ndarray, acks: np.ndarray) -> np.ndarray:
    """What is known of a block's lines after more of them and more acknowledgements.

    held, and the result: rows (kind, first, last, lines, file_id, end_offset)
    by first. Kinds are an open line, a stretch of settled lines with the
    position of its last, and an acknowledgement whose line has not come.
    lines: rows (seq, file_id, end_offset, settled).
    """
    kept = held[held[:, 0] != _EARLY]
    acks = np.unique(np.concatenate([acks, held[held[:, 0] == _EARLY, 1]]))
    lines = lines[np.lexsort((-lines[:, 3], lines[:, 0]))]
    lines = lines[np.append(True, lines[1:, 0] != lines[:-1, 0])[: len(lines)]]
    before = np.searchsorted(kept[:, 1], lines[:, 0], side="right") - 1
    inside = np.zeros(len(lines), dtype=bool)
    if len(kept):
        inside = (before >= 0) & (lines[:, 0] <= kept[np.maximum(before, 0), 2])
        again = lines[inside]  # told again: an open line may now be settled
        settled = again[again[:, 3] == 1, 0]
        acks = np.union1d(acks, settled)
    fresh = lines[~inside]
    one = np.ones(len(fresh), dtype=np.int64)
    rows = np.concatenate([kept, np.stack([fresh[:, 3], fresh[:, 0], fresh[:, 0], one, fresh[:, 1], fresh[:, 2]], axis=1)])
    rows = rows[np.argsort(rows[:, 1], kind="stable")]
    rows[(rows[:, 0] == _OPEN) & np.isin(rows[:, 1], acks), 0] = _SETTLED
    if len(rows):
        head = np.ones(len(rows), dtype=bool)
        head[1:] = (rows[1:, 0] == _OPEN) | (rows[:-1, 0] == _OPEN)
        starts = np.nonzero(head)[0]
        ends = np.append(starts[1:], len(rows)) - 1
        merged = rows[ends]
        merged[:, 1] = rows[starts, 1]
        merged[:, 3] = np.add.reduceat(rows[:, 3], starts)
    else:
        merged = rows
    at = np.searchsorted(merged[:, 1], acks, side="right") - 1
    met = (at >= 0) & (acks <= merged[np.maximum(at, 0), 2]) if len(merged) else np.zeros(len(acks), dtype=bool)
    early = acks[~met]
    waiting = np.zeros((len(early), 6), dtype=np.int64)
    waiting[:, 0], waiting[:, 1], waiting[:, 2] = _EARLY, early, early
    return np.concatenate([merged, waiting])


class SettledStretches(StatefulProcessor):
    """The open lines of a source's block and the settled stretches between them.

    Without `every` a block is given out in each batch that changed it, with it
    by a timer so many milliseconds after its first change.
    """

    def __init__(self, every: int | None = None):
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("lines", "rows binary")

    def _rows(self) -> np.ndarray:
        held = self.held.get()
        return np.frombuffer(held[0] if held else b"", dtype="<i8").reshape(-1, 6)

    def _given(self, key) -> pd.DataFrame:
        rows = self._rows()
        rows = rows[rows[:, 0] != _EARLY]
        opened = np.nonzero(rows[:, 0] == _OPEN)[0]
        first = opened[0] if len(opened) else len(rows)
        last = [None if n == _NONE else n for n in rows[first - 1]] if first else [None] * 6
        out = [[
            key[0], key[1], rows[first, 1] if len(opened) else None, rows[:, 3].sum(), rows[first:, 3].sum(), last[2],
            last[4], last[5],
        ]]
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in LINE_BLOCK.split(", ")])
        return frame.astype({c: "Int64" for c in frame.columns[1:]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        told = frame[["seq", "file_id", "end_offset", "settled"]].astype("int64").to_numpy()
        is_line = told[:, 2] != _NONE
        self.held.update((merged_lines(self._rows(), told[is_line], told[~is_line, 0]).astype("<i8").tobytes(),))
        if self.every is None:
            yield self._given(key)
        elif next(iter(self.handle.listTimers()), None) is None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._given(key)


def line_blocks(lines: DataFrame, every: int | None = None) -> DataFrame:
    """What changed of the blocks of a stream of lines and acknowledgements.

    lines: source, seq, file_id, end_offset, settled; an acknowledgement has no
    end_offset. Lines of a source come in the order of their numbers, from batch
    to batch; within one they may lie anyhow. Acknowledgements may come in any
    order, again, and before their line.
    """
    _ready(lines)
    places = [F.coalesce(c, F.lit(_NONE)).alias(c) for c in ("file_id", "end_offset")]
    settled = F.coalesce("settled", F.lit(False)).alias("settled")
    rows = lines.select("source", block_of("seq").alias("block"), "seq", *places, settled)
    return rows.groupBy("source", "block").transformWithStateInPandas(
        SettledStretches(every), LINE_BLOCK, "Update", "None" if every is None else "ProcessingTime"
    )


# --- sequence ranges --------------------------------------------------------------------

RANGE_BLOCK = "block long, received long, unique_seqs long, ranges array<struct<low: long, high: long>>"


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each number once a batch of rows, so that a hot number is sent as one row."""
    for frame in batches:
        seqs, copies = np.unique(frame["seq"].to_numpy(), return_counts=True)
        yield pd.DataFrame({"seq": seqs, "copies": copies})


class SeenRanges(StatefulProcessor):
    """Which numbers of a block were seen, as a bitmap, and how many rows there were."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "bits binary, received long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        base = int(key[0]) * BLOCK
        held = self.seen.get()
        bits = np.frombuffer(held[0] if held else bytes(BLOCK // 8), dtype=np.uint8).copy()
        received = int(held[1]) if held else 0
        for frame in rows:
            at = frame["seq"].to_numpy() - base
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
            received += int(frame["copies"].sum())
        self.seen.update((bits.tobytes(), received))
        marks = np.unpackbits(bits, bitorder="little")
        steps = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
        ranges = [
            {"low": int(a), "high": int(b) - 1}
            for a, b in zip(np.nonzero(steps == 1)[0] + base, np.nonzero(steps == -1)[0] + base, strict=True)
        ]
        yield pd.DataFrame({
            "block": [key[0]], "received": [received], "unique_seqs": [int(marks.sum())], "ranges": [ranges],
        })


def range_blocks(sequences: DataFrame) -> DataFrame:
    """The blocks of numbers that a stream of sequence numbers (seq) changed, with all that was seen of them."""
    _ready(sequences)
    counted = sequences.select("seq").mapInPandas(_counted, "seq long, copies long")
    return counted.withColumn("block", block_of("seq")).groupBy("block").transformWithStateInPandas(
        SeenRanges(), RANGE_BLOCK, "Update", "None"
    )
