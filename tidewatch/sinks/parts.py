"""Sets of files that live, replace each other and are removed later.

A part is complete once its file is in live/; a part that names others as
replaced takes their place in that same step. So readers and writers beside
each other see whole parts only, without locks.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

#: Seconds after which files that were merged into others are removed.
GRACE = 3600


class PartLog:
    """The parts below a folder. A part is a JSON object with name and replaces among its members."""

    def __init__(self, spark: SparkSession, root: str, folders: Sequence[str]):
        """folders: where a part's own files lie, as <folder>/<part>."""
        self.spark, self.root, self.folders = spark, root.rstrip("/"), tuple(folders)

    def _path(self, *names: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *names)))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> dict[str, int]:
        """Names in a folder and when they were written, in seconds."""
        fs, path = self._fs(), self._path(folder)
        if not fs.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() // 1000 for s in fs.listStatus(path)}

    def exists(self) -> bool:
        return self._fs().exists(self._path("live"))

    def put(self, folder: str, name: str, text: str = "") -> None:
        """Write a small file that appears whole."""
        fs, draft = self._fs(), self._path("drafts", uuid.uuid4().hex)
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.mkdirs(self._path(folder))
        fs.delete(self._path(folder, name), False)
        fs.rename(draft, self._path(folder, name))

    def get(self, folder: str, name: str) -> str:
        stream = self._fs().open(self._path(folder, name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, folder: str, name: str) -> None:
        self._fs().delete(self._path(folder, name), True)

    def _all(self) -> dict[str, dict]:
        names = [n for n in self.names("live") if n.endswith(".json")]
        return {p["name"]: p for p in (json.loads(self.get("live", n)) for n in names)}

    def live(self) -> list[dict]:
        """The parts that no other part replaces."""
        parts = self._all()
        gone = {name for p in parts.values() for name in p["replaces"]}
        return [p for p in parts.values() if p["name"] not in gone]

    def add(self, part: dict) -> None:
        self.put("live", f"{part['name']}.json", json.dumps(part))

    def sweep(self, grace: float = GRACE) -> int:
        """Remove parts that were merged, or begun and never finished, so long ago that nothing still uses them."""
        drafts = self.names(self.folders[0])
        parts, written = self._all(), self.names("live")
        now, gone = time.time(), set()
        for name, at in drafts.items():
            if name not in parts and now - at >= grace:
                gone.add(name)
        for p in parts.values():
            if now - written[f"{p['name']}.json"] >= grace:
                gone.update(name for name in p["replaces"] if name in parts)
        for name in gone:
            self.remove("live", f"{name}.json")
            for folder in self.folders:
                self.remove(folder, name)
        return len(gone)
