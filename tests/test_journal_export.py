import json

import pytest

from tidewatch.sources import journal_export
from tidewatch.sources.journal_export import Exports
from tidewatch.streaming.ingest import start


@pytest.fixture(autouse=True, scope="module")
def registered(spark):
    journal_export.register(spark)


def entry(n, **more):
    return json.dumps({"__CURSOR": f"s=é;i={n}", "MESSAGE": f"m{n}", **more})


class Folder:
    def __init__(self, spark, path):
        self.spark, self.home, self.path = spark, path, path / "exports"
        self.path.mkdir()

    def add(self, name, *lines, end="\n"):
        with open(self.path / name, "a") as file:
            file.write("\n".join(lines) + end)

    def poll(self, **options):
        """Cursor numbers of the entries that come with a run."""
        before = self.kept()
        stream = self.spark.readStream.format("journal_export").options(path=str(self.path), rangeBytes=64, **options).load()
        start(stream.writeStream.format("parquet").option("path", f"{self.home}/out"), f"{self.home}/state").awaitTermination()
        return self.kept()[len(before):]

    def kept(self):
        if not (self.home / "out/_spark_metadata").exists():
            return []
        rows = self.spark.read.parquet(f"{self.home}/out").selectExpr("*", "_metadata.file_modification_time AS t").collect()
        return [number(r.value) for r in sorted(rows, key=lambda r: (r.t, r.file, r.end_offset))]

    def read(self, **options):
        rows = self.spark.read.format("journal_export").options(path=str(self.path), rangeBytes=64, **options).load().collect()
        return [number(r.value) for r in sorted(rows, key=lambda r: (r.file, r.end_offset))]


def number(value):
    cursor = journal_export.cursor_of(bytes(value))
    return int(cursor.rpartition("=")[2]) if cursor else bytes(value).decode()


@pytest.fixture
def folder(spark, tmp_path):
    return Folder(spark, tmp_path)


def test_entries_come_once_over_runs(folder):
    folder.add("1", *[entry(n) for n in range(20)])
    assert sorted(folder.poll()) == list(range(20))
    folder.add("1", entry(20), entry(21), "junk", "")
    folder.add("2", entry(22), entry(23)[:12], end="")
    assert sorted(map(str, folder.poll())) == sorted(["20", "21", "junk", "", "22"])
    folder.add("2", entry(23)[12:])
    assert folder.poll() == [23]
    assert folder.poll() == []


def test_start_from_now(folder):
    folder.add("1", *[entry(n) for n in range(5)])
    assert folder.poll(startFrom="now") == []
    folder.add("1", entry(5))
    assert folder.poll(startFrom="now") == [5]


def test_start_after_a_cursor(folder):
    folder.add("1", *[entry(n) for n in range(5)])
    folder.add("2", *[entry(n) for n in range(5, 9)])
    assert folder.read(after="s=é;i=3") == [4, 5, 6, 7, 8]
    assert folder.read(after="s=é;i=8") == [] and folder.read(startFrom="now") == []
    assert folder.read() == list(range(9)) == folder.read(after="s=é;i=77")  # a cursor that is gone
    assert folder.poll(after="s=é;i=6") == [7, 8]
    folder.add("2", entry(9))
    assert folder.poll(after="s=é;i=6") == [9]


def test_exports_that_were_put_together(folder):
    """The entry at the position is in another file now; it is found by its cursor."""
    folder.add("1", *[entry(n) for n in range(4)])
    folder.add("2", *[entry(n) for n in range(4, 8)])
    assert len(folder.poll()) == 8
    (folder.path / "2").unlink()
    folder.add("1", *[entry(n) for n in range(4, 8)])
    folder.add("3", entry(8))
    assert folder.poll() == [8]


def test_long_lines_are_skipped(folder, monkeypatch):
    monkeypatch.setattr(journal_export, "LINE_CAP", 200)
    at_cap = entry(1, x="y" * (200 - len(entry(1, x="").encode())))
    folder.add("1", at_cap, entry(2, x="y" * 300), entry(3), entry(4, x="z" * 900))
    assert len(at_cap.encode()) == 200
    found = [r for part in Exports(str(folder.path)).owed(journal_export.START, {"file": "1", "at": 10**6}, 64)
             for batch in journal_export._read(part) for r in batch.column("value").to_pylist()]
    assert [number(v) for v in found] == [1, 3]


def test_lines_backwards_whatever_is_read_at_once(folder, monkeypatch):
    lines = ["a" * n for n in (0, 3, 50, 1, 0, 120, 7)]
    folder.add("1", *lines, "open", end="")
    for size in (1, 2, 7, 64, 10_000):
        monkeypatch.setattr(journal_export, "_PROBE_BYTES", size)
        exports = Exports(str(folder.path))
        found = list(exports.lines_before("1", exports.sizes["1"]))
        assert [line.decode().rstrip("\n") for _, line in found] == lines[::-1]
        ends = [sum(len(x) + 1 for x in lines[: i + 1]) for i in range(len(lines))]
        assert [end for end, _ in found] == ends[::-1]


def test_packed_and_hidden_files_stay_out(folder):
    folder.add("1.gz", "x")
    folder.add(".hidden", entry(1))
    folder.add("2", entry(2))
    assert folder.read() == [2]


def test_only_strings_are_fields(spark):
    from tidewatch.operators.journal import classify_entries

    base = {"__CURSOR": "c", "__REALTIME_TIMESTAMP": "1700000000000000"}
    cases = [
        (json.dumps({**base, "_PID": "42", "MESSAGE": 'say "_PID": 7'}), {"pid": "42", "message": 'say "_PID": 7'}),
        (json.dumps({**base, "_PID": 42, "MESSAGE": "m"}), {"message": "m"}),
        (json.dumps({**base, "_PID": None, "_UID": True, "_COMM": [1], "_EXE": {"a": "b"}, "MESSAGE": "m"}), {"message": "m"}),
        (json.dumps({**base, "MESSAGE": [104, 105], "PRIORITY": "6"}), {"priority": "6"}),
        (json.dumps(base)[:-1] + ', "_PID":"1", "_PID":2}', {}),
        (json.dumps(base)[:-1] + ', "_PID": 1, "_PID" : "2"}', {"pid": "2"}),
        (json.dumps(base)[:-1] + ', "\\u005fPID": 42, "MESSAGE":"\\u00e9"}', {"message": "é"}),
        (json.dumps({**base, "extra": {"_PID": 5}, "_COMM": "sshd"}), {"comm": "sshd"}),
        (json.dumps({**base, "MESSAGE": "tab\tquote\"slash\\"}), {"message": "tab\tquote\"slash\\"}),
    ]
    lines = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "n int, value string")
    rows = {r.n: r for r in classify_entries(lines).collect()}
    assert {i: (rows[i].reject_reason, rows[i].payload) for i in rows} == {i: (None, p) for i, (_, p) in enumerate(cases)}
    number = spark.createDataFrame([('{"__CURSOR": 5, "__REALTIME_TIMESTAMP": "1"}',)], "value string")
    assert classify_entries(number).first().reject_reason == "missing_cursor"


def test_ranges_grow_where_there_are_too_many(tmp_path, monkeypatch):
    for name in ("a", "b"):
        (tmp_path / name).write_text("".join(entry(n) + "\n" for n in range(200)))
    exports = Exports(str(tmp_path))
    whole = exports.owed(dict(journal_export.START), exports.last(), 8)
    monkeypatch.setattr(journal_export, "MOST_RANGES", 10)
    fewer = exports.owed(dict(journal_export.START), exports.last(), 8)
    assert len(whole) > 500 and len(fewer) <= 12
    lines = [v for part in fewer for batch in journal_export._read(part) for v in batch["value"].to_pylist()]
    assert lines == [v for part in whole for batch in journal_export._read(part) for v in batch["value"].to_pylist()]
    assert len(lines) == 400
