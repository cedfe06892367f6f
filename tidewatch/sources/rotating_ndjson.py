"""Data source for line files that grow, rotate and get truncated.

    register(spark)
    spark.readStream.format("rotating_ndjson").option("path", "/logs/alerts.json").load()

A position in a source is a file, by identity, and a byte. From there on a reader
goes to the end of that file, then through the files that were written to after
it, oldest first, and at last into the live file. As long as the live file keeps
its identity nothing else is read, so copies of it do not matter; if it gets
shorter it is read from its start. The offset of a stream is a position for each
source; a batch lies between two of them, cut into byte ranges that tasks read on
their own. A range owns the lines that start in it. The files must be on a folder
that the driver and every executor can reach.

Options: path (one live file) or paths (JSON object, source name -> path);
rotatedGlob (text, or JSON object, source name -> glob) for rotated files beside
"<path>.*"; startFrom (beginning or end, first run only); rangeBytes;
maxBytesPerTrigger; and planLog, a file beside the checkpoint that keeps where the
last batch ended, so that the first batch after a restart is bounded like any
other. It belongs to one checkpoint. A batch read takes checkpoint (JSON object, source name ->
{"file_id", "offset"}) and returns what is still owed after it.
"""

from __future__ import annotations

import glob
import json
import logging
import os
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)
from pyspark.sql.types import StructType

from tidewatch.operators.generations import COMPRESSED
from tidewatch.schemas import LINE

logger = logging.getLogger(__name__)

RANGE_BYTES = 64 * 1024 * 1024
_PROBE_BYTES = 64 * 1024
_BATCH_BYTES = 4 * 1024 * 1024


@dataclass
class ByteRange(InputPartition):
    source: str
    path: str
    file_id: int
    generation: int
    start: int
    stop: int
    last: int       # end of what this batch may read of the file
    closed: bool    # no more bytes will come: an unterminated last line counts


@dataclass
class Generation:
    """One file of a source."""

    path: str
    file_id: int
    mtime: int
    size: int

    @property
    def age(self) -> tuple[int, int]:
        return self.mtime, self.file_id

    def resumes_at(self, position: int) -> bool:
        """Whether a line can start there."""
        if position <= 0 or position >= self.size:
            return 0 <= position <= self.size
        with open(self.path, "rb") as handle:
            handle.seek(position - 1)
            return handle.read(1) == b"\n"


def _stat(path: str) -> Generation | None:
    try:
        status = os.stat(path)
    except OSError:
        return None
    return Generation(path, status.st_ino, status.st_mtime_ns, status.st_size)


class Listing:
    """The files of a source as they are now."""

    def __init__(self, path: str, pattern: str | None) -> None:
        self.live = _stat(path)
        self.rotated: list[Generation] = []
        home = os.path.dirname(os.path.abspath(path))
        if os.path.isdir(home):
            device = os.stat(home).st_dev
            beside = glob.glob(f"{glob.escape(path)}.*") + (glob.glob(pattern) if pattern else [])
            by_identity: dict[int, Generation] = {}
            for name in sorted(beside):
                entry = None if name.endswith(COMPRESSED) else _stat(name)
                if entry and not (self.live and entry.file_id == self.live.file_id) and os.stat(name).st_dev == device:
                    by_identity.setdefault(entry.file_id, entry)
            self.rotated = sorted(by_identity.values(), key=lambda entry: entry.age)

    def from_position(self, file_id: int, position: int, after: int = 0) -> tuple[list[tuple[Generation, int]], bool]:
        """What is to be read from a position on, as files with the byte to begin
        at, and whether the position's file is lost.

        after: for a position without a file, the time of the newest file that
        was there when the source was first looked at.
        """
        live = [(self.live, 0)] if self.live else []
        if self.live and self.live.file_id == file_id:
            return [(self.live, position if self.live.resumes_at(position) else 0)], False
        if file_id < 0:
            return [(f, 0) for f in self.rotated if f.mtime > after] + live, False
        held = next((f for f in self.rotated if f.file_id == file_id and f.resumes_at(position)), None)
        if held is None:
            return live, True
        later = [(f, 0) for f in self.rotated if f.age > held.age]
        return [(held, position), *later, *live], False


def last_line_end(path: str, limit: int, floor: int = 0) -> int:
    """Position after the last newline before limit, at least floor."""
    with open(path, "rb") as handle:
        stop = limit
        while stop > floor:
            start = max(floor, stop - _PROBE_BYTES)
            handle.seek(start)
            cut = handle.read(stop - start).rfind(b"\n")
            if cut >= 0:
                return start + cut + 1
            stop = start
    return floor


def _next_line_end(path: str, position: int, limit: int) -> int:
    """Position after the first newline from position on, or limit."""
    with open(path, "rb") as handle:
        handle.seek(position)
        while position < limit:
            piece = handle.read(min(_PROBE_BYTES, limit - position))
            if not piece:
                break
            cut = piece.find(b"\n")
            if cut >= 0:
                return position + cut + 1
            position += len(piece)
    return limit


class _Options:
    def __init__(self, options: dict[str, str]) -> None:
        given = {key.lower(): value for key, value in options.items()}
        if "paths" in given:
            self.paths: dict[str, str] = json.loads(given["paths"])
        elif "path" in given:
            self.paths = {given.get("source", given["path"]): given["path"]}
        else:
            raise ValueError("rotating_ndjson needs the option path or paths")
        globs = given.get("rotatedglob")
        if globs is None:
            self.globs: dict[str, str] = {}
        elif globs.lstrip().startswith("{"):
            self.globs = json.loads(globs)
        else:
            self.globs = dict.fromkeys(self.paths, globs)
        unknown = sorted(set(self.globs) - set(self.paths))
        if unknown:
            raise ValueError(f"rotatedGlob names an unknown source: {unknown[0]}")
        self.start_from = given.get("startfrom", "end")
        if self.start_from not in ("beginning", "end"):
            raise ValueError("startFrom must be beginning or end")
        self.range_bytes = int(given.get("rangebytes", RANGE_BYTES))
        self.max_bytes = int(given.get("maxbytespertrigger", 0))
        self.plan_log = given.get("planlog", "").removeprefix("file:")
        self.checkpoint: dict[str, dict] = json.loads(given.get("checkpoint", "{}"))

    def listing(self, source: str) -> Listing:
        return Listing(self.paths[source], self.globs.get(source))


def _cut(source: str, entry: Generation, start: int, stop: int, closed: bool, step: int) -> list[ByteRange]:
    return [
        ByteRange(source, entry.path, entry.file_id, entry.mtime, low, min(low + step, stop), stop, closed)
        for low in range(start, stop, step)
    ]


def read_range(part: ByteRange) -> Iterator[pa.RecordBatch]:
    """Lines that start in [start, stop), as Arrow batches."""
    with _open_by_identity(part) as handle:
        position = part.start
        if position > 0:
            handle.seek(position - 1)
            if handle.read(1) != b"\n":
                position += len(handle.readline())  # the range before owns it
        values: list[bytes] = []
        ends: list[int] = []
        held = 0
        while position < part.stop:
            line = handle.readline()
            if not line or (not line.endswith(b"\n") and not part.closed):
                break
            position += len(line)
            text = line.rstrip(b"\r\n")
            if text or line.endswith(b"\n"):
                values.append(text)
                ends.append(position)
                held += len(text)
            if held >= _BATCH_BYTES:
                yield _batch(part, values, ends)
                values, ends, held = [], [], 0
        if values:
            yield _batch(part, values, ends)


def _open_by_identity(part: ByteRange):
    """Open the planned file even if it has been renamed since."""
    folder = os.path.dirname(os.path.abspath(part.path))
    names = [part.path, *sorted(os.path.join(folder, name) for name in os.listdir(folder))]
    for name in names:
        entry = _stat(name)
        if entry is None or entry.file_id != part.file_id:
            continue
        handle = open(name, "rb")
        if os.fstat(handle.fileno()).st_ino == part.file_id:
            return handle
        handle.close()
    raise FileNotFoundError(
        f"{part.source}: file {part.file_id} ({part.path}) disappeared before "
        f"bytes {part.start}-{part.stop} were read"
    )


def _batch(part: ByteRange, values: list[bytes], ends: list[int]) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part.source] * n, pa.string()),
            pa.array([part.file_id] * n, pa.int64()),
            pa.array([part.generation] * n, pa.int64()),
            pa.array(ends, pa.int64()),
            pa.array(values, pa.binary()),
        ],
        names=LINE.fieldNames(),
    )


def _position(entry: Generation, at: int) -> dict:
    return {"file": entry.file_id, "at": at}


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: _Options) -> None:
        self.options = options
        self._reached: dict | None = self._logged()

    def _logged(self) -> dict | None:
        """Where the last planned batch of an earlier run ended. It was completed, or Spark plans it again first."""
        if not self.options.plan_log or not os.path.exists(self.options.plan_log):
            return None
        with open(self.options.plan_log) as log:
            return json.load(log)

    def _log(self, end: dict) -> None:
        if not self.options.plan_log:
            return
        draft = f"{self.options.plan_log}.draft"
        os.makedirs(os.path.dirname(draft) or ".", exist_ok=True)
        with open(draft, "w") as log:
            json.dump(end, log)
        os.replace(draft, self.options.plan_log)

    def initialOffset(self) -> dict:
        """Rotated files that exist before the first run count as read."""
        offset = {}
        for source in self.options.paths:
            files = self.options.listing(source)
            if files.live:
                at_end = self.options.start_from == "end"
                offset[source] = _position(files.live, last_line_end(files.live.path, files.live.size) if at_end else 0)
            else:
                offset[source] = {"file": -1, "at": 0, "after": max((f.mtime for f in files.rotated), default=0)}
        self._reached = offset
        return offset

    def latestOffset(self) -> dict:
        """As far as complete lines go, or about max_bytes from where the last batch ended."""
        if self._reached is None and self.options.plan_log:
            self.initialOffset()  # no batch was planned yet: the stream begins
        offset = {}
        for source in self.options.paths:
            files = self.options.listing(source)
            begun = (self._reached or {}).get(source)
            if begun is None or not self.options.max_bytes:
                offset[source] = self._end(files, begun)
                continue
            offset[source], room = begun, self.options.max_bytes
            for entry, low in files.from_position(begun["file"], begun["at"], begun.get("after", 0))[0]:
                stop = self._stop(files, entry)
                if stop - low > room:
                    stop = _next_line_end(entry.path, low + room - 1, stop)
                offset[source] = _position(entry, stop)
                room -= stop - low
                if room <= 0:
                    break
        self._reached = offset
        return offset

    @staticmethod
    def _stop(files: Listing, entry: Generation) -> int:
        return last_line_end(entry.path, entry.size) if entry is files.live else entry.size

    def _end(self, files: Listing, begun: dict | None) -> dict:
        last = files.live or (files.rotated[-1] if files.rotated and begun and begun["file"] >= 0 else None)
        return _position(last, self._stop(files, last)) if last else begun or {"file": -1, "at": 0}

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        self._log(end)
        self._reached = end
        parts: list[ByteRange] = []
        for source, reached in end.items():
            begun = start.get(source, {"file": -1, "at": 0})
            if source not in self.options.paths or begun == reached:
                continue
            files = self.options.listing(source)
            owed, lost = files.from_position(begun["file"], begun["at"], begun.get("after", 0))
            if lost:
                logger.error("%s: file %d is gone; anything after byte %d was not read", source, begun["file"], begun["at"])
            if reached["file"] >= 0 and all(entry.file_id != reached["file"] for entry, _ in owed):
                logger.error("%s: file %d is gone; its first %d bytes were not read", source, reached["file"], reached["at"])
            for entry, low in owed:
                last = entry.file_id == reached["file"]
                stop = reached["at"] if last else entry.size
                if last and begun["file"] == entry.file_id and stop < begun["at"]:
                    low = 0  # cut short in place since
                if low < stop:
                    closed = entry is not files.live
                    parts += _cut(source, entry, low, min(stop, entry.size), closed, self.options.range_bytes)
                if last:
                    break
        return parts

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return read_range(partition)


class _BatchReader(DataSourceReader):
    """What is owed after a checkpoint; without one, the live file from startFrom."""

    def __init__(self, options: _Options) -> None:
        self.options = options

    def partitions(self) -> list[ByteRange]:
        parts: list[ByteRange] = []
        for source in self.options.paths:
            files, saved = self.options.listing(source), self.options.checkpoint.get(source)
            owed: list[tuple[Generation, int]] = []
            if saved is not None:
                owed, lost = files.from_position(int(saved["file_id"]), int(saved["offset"]))
                if lost:
                    logger.error("%s: file %s was not found; anything after byte %s was not read", source, saved["file_id"], saved["offset"])
            elif files.live and self.options.start_from == "beginning":
                owed = [(files.live, 0)]
            for entry, low in owed:
                closed = entry is not files.live
                stop = entry.size if closed else last_line_end(entry.path, entry.size)
                parts += _cut(source, entry, low, stop, closed, self.options.range_bytes)
        return parts or [ByteRange("", os.devnull, os.stat(os.devnull).st_ino, 0, 0, 0, 0, True)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if partition.stop <= partition.start:
            return iter(())
        return read_range(partition)


class RotatingNdjson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rotating_ndjson"

    def schema(self) -> StructType:
        return LINE

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BatchReader(_Options(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(_Options(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to a session.

    The workers that plan a stream do not see files added to the session, so the
    source is sent to them by value.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(RotatingNdjson)
