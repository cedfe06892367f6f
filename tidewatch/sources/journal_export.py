"""Data source for folders of journal exports, whose position is the cursor of the last entry read.

    register(spark)
    spark.readStream.format("journal_export").option("path", "/exports").load()

Exports are files of one JSON entry a line, as `journalctl -o json` writes them,
in the order of their paths below the folder; new entries are appended to the
last file or come in new files. The position is a cursor, with the file and byte
behind its entry as a hint. If the entry is no longer there, because exports
were written anew or put together, the cursor is looked for in all files; if it
is gone, everything that is there is read, and events with ids made from
cursors tell which entries are known.

Options: path (a folder that driver and executors share); startFrom (beginning
or now, for the first run); after (a cursor, for the first run or a batch read);
rangeBytes (longer ranges are taken where there were more than 1,024). Lines above 1 MiB are skipped. Files that are compressed are not read.
"""

from __future__ import annotations

import json
import logging
import os
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidewatch.schemas import ENTRY

logger = logging.getLogger(__name__)

RANGE_BYTES = 64 * 1024 * 1024
#: Ranges, about, above which they are made longer than was asked for, up to RANGE_BYTES.
MOST_RANGES = 1024
#: Bytes of the longest line that is read.
LINE_CAP = 1 << 20
_PROBE_BYTES = 64 * 1024
_BATCH_BYTES = 4 * 1024 * 1024
_PACKED = (".gz", ".bz2", ".xz", ".zst", ".zip", ".lz4")
START = {"file": "", "at": 0, "cursor": ""}


@dataclass
class Stretch(InputPartition):
    """The lines of a file that start in [start, stop)."""

    folder: str
    file: str
    start: int
    stop: int


def cursor_of(line: bytes) -> str:
    """The cursor of an entry; empty for a line that holds none."""
    try:
        entry = json.loads(line)
    except ValueError:
        return ""
    found = entry.get("__CURSOR") if isinstance(entry, dict) else None
    return found if isinstance(found, str) else ""


class Exports:
    """The exports of a folder as they are now: paths below it, and the bytes of their complete lines."""

    def __init__(self, folder: str) -> None:
        self.folder = folder
        names = []
        for home, folders, files in os.walk(folder):
            folders[:] = [f for f in folders if not f.startswith((".", "_"))]
            names += [os.path.join(home, f) for f in files if not f.startswith((".", "_")) and not f.endswith(_PACKED)]
        self.sizes = {os.path.relpath(n, folder): os.path.getsize(n) for n in names}
        self.files = sorted(self.sizes)

    def lines_before(self, file: str, limit: int) -> Iterator[tuple[int, bytes]]:
        """Complete lines that end at or before a byte, the last first, with their ends."""
        with open(os.path.join(self.folder, file), "rb") as handle:
            end, held = limit, b""
            at = limit
            while at > 0:
                low = max(0, at - _PROBE_BYTES)
                handle.seek(low)
                held = handle.read(at - low) + held
                at = low
                if at + len(held) == limit and end == limit:  # what follows the last newline is not complete
                    cut = held.rfind(b"\n") + 1
                    if not cut and at:
                        continue
                    held, end = held[:cut], at + cut
                while True:
                    cut = held.rfind(b"\n", 0, len(held) - 1) if held else -1
                    if cut < 0 and at > 0 or not held:
                        break
                    yield end, held[cut + 1 :]
                    held, end = held[: cut + 1], at + cut + 1

    def last(self) -> dict:
        """The position behind the last complete line; its cursor is that of the last entry that has one."""
        for file in reversed(self.files):
            end = None
            for at, line in self.lines_before(file, self.sizes[file]):
                end = at if end is None else end
                cursor = cursor_of(line)
                if cursor:
                    return {"file": file, "at": end, "cursor": cursor}
            if end is not None:
                return {"file": file, "at": end, "cursor": ""}
        return dict(START)

    def behind(self, position: dict) -> tuple[str, int] | None:
        """File and byte behind an entry; None if it is gone."""
        file, at, cursor = position["file"], position["at"], position["cursor"]
        if not file and not cursor:
            return "", 0
        if file in self.sizes and at <= self.sizes[file]:
            for end, line in self.lines_before(file, at):
                found = cursor_of(line)
                if end == at and not cursor:
                    return file, at
                if found:
                    if found == cursor:
                        return file, at
                    break
        return self.find(cursor) if cursor else None

    def find(self, cursor: str) -> tuple[str, int] | None:
        """File and byte behind the entry of a cursor, looked for from the newest file on."""
        wanted = json.dumps(cursor)[1:-1].encode()
        for file in reversed(self.files):
            with open(os.path.join(self.folder, file), "rb") as handle:
                at = 0
                for line in handle:
                    at += len(line)
                    if wanted in line and cursor_of(line) == cursor:
                        return file, at
        return None

    def owed(self, begun: dict, reached: dict, step: int) -> list[Stretch]:
        """What lies between two positions."""
        low = self.behind(begun)
        if low is None:
            logger.error("%s: the entry with cursor %s is gone; all entries are read", self.folder, begun["cursor"])
            low = ("", 0)
        owed = []
        for file in self.files:
            if file < low[0] or file > reached["file"]:
                continue
            start = low[1] if file == low[0] else 0
            stop = min(self.sizes[file], reached["at"]) if file == reached["file"] else self.sizes[file]
            owed.append((file, start, stop))
        fewest = -(-sum(max(0, stop - start) for _, start, stop in owed) // MOST_RANGES)
        step = max(step, min(RANGE_BYTES, fewest))
        return [Stretch(self.folder, file, a, min(a + step, stop)) for file, start, stop in owed for a in range(start, stop, step)]


def _read(part: Stretch) -> Iterator[pa.RecordBatch]:
    with open(os.path.join(part.folder, part.file), "rb") as handle:
        at = part.start
        if at > 0:
            handle.seek(at - 1)
            at += len(handle.readline()) - 1
        values: list[bytes] = []
        ends: list[int] = []
        held = 0
        while at < part.stop:
            line = handle.readline(LINE_CAP + 2)
            size, long = len(line), False
            while line and not line.endswith(b"\n"):  # too long, or the unfinished end
                line, long = handle.readline(LINE_CAP + 2), True
                size += len(line)
            if not line:
                break
            at += size
            if not long and size <= LINE_CAP + 1:
                values.append(line.rstrip(b"\r\n"))
                ends.append(at)
                held += size
            if held >= _BATCH_BYTES:
                yield _batch(part, values, ends)
                values, ends, held = [], [], 0
        if values:
            yield _batch(part, values, ends)


def _batch(part: Stretch, values: list[bytes], ends: list[int]) -> pa.RecordBatch:
    columns = [pa.array([part.file] * len(ends)), pa.array(ends, pa.int64()), pa.array(values, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=ENTRY.fieldNames())


class _Options:
    def __init__(self, options: dict[str, str]) -> None:
        given = {key.lower(): value for key, value in options.items()}
        if "path" not in given:
            raise ValueError("journal_export needs the option path")
        self.folder = given["path"].removeprefix("file:")
        self.after = given.get("after", "")
        self.start_from = given.get("startfrom", "beginning")
        if self.start_from not in ("beginning", "now"):
            raise ValueError("startFrom must be beginning or now")
        self.step = int(given.get("rangebytes", RANGE_BYTES))

    def start(self) -> dict:
        exports = Exports(self.folder)
        if self.after:
            found = exports.find(self.after)
            return {"file": found[0] if found else "", "at": found[1] if found else 0, "cursor": self.after}
        return exports.last() if self.start_from == "now" else dict(START)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: _Options) -> None:
        self.options = options

    def initialOffset(self) -> dict:
        return self.options.start()

    def latestOffset(self) -> dict:
        return Exports(self.options.folder).last()

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return [] if start == end else Exports(self.options.folder).owed(start, end, self.options.step)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class _BatchReader(DataSourceReader):
    def __init__(self, options: _Options) -> None:
        self.options = options

    def partitions(self) -> list[Stretch]:
        exports = Exports(self.options.folder)
        owed = exports.owed(self.options.start(), exports.last(), self.options.step)
        return owed or [Stretch(os.path.dirname(os.devnull), os.path.basename(os.devnull), 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return _read(partition) if partition.start < partition.stop else iter(())


class JournalExport(DataSource):
    @classmethod
    def name(cls) -> str:
        return "journal_export"

    def schema(self) -> StructType:
        return ENTRY

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BatchReader(_Options(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(_Options(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to a session; the source is sent to the workers by value."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(JournalExport)
