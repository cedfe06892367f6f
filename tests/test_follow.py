import glob
import json
import os
import time

import pytest

from tidewatch.operators.generations import owed_generations
from tidewatch.sources.files import read_manifest
from tidewatch.streaming import follow


class Logs:
    def __init__(self, spark, home, sources):
        self.spark, self.home, self.target = spark, home, str(home / "target")
        self.paths = {s: str(home / s / "alerts.json") for s in sources}
        for path in self.paths.values():
            os.makedirs(os.path.dirname(path))

    def write(self, source, *numbers, end="\n"):
        with open(self.paths[source], "a") as file:
            file.write("\n".join(json.dumps({"n": n}) for n in numbers) + end)

    def rotate(self, source):
        time.sleep(0.01)
        path = self.paths[source]
        if os.path.exists(path + ".1"):
            os.rename(path + ".1", path + ".2")
        os.rename(path, path + ".1")

    def routes(self):
        rows = [(s, p, None) for s, p in self.paths.items()]
        return self.spark.createDataFrame(rows, "name string, path string, rotated_glob string")

    def round(self, **options):
        return follow.follow_round(self.routes(), self.target, **{"start_from": "beginning", "range_bytes": 32, **options})

    def lines(self):
        rows = follow.lines_of(self.spark, self.target).collect()
        return sorted((r.source, json.loads(bytes(r.value))["n"]) for r in rows)


def test_lines_come_once_over_rotations(spark, tmp_path):
    logs = Logs(spark, tmp_path, "ab")
    assert logs.round() == 1 and logs.lines() == []
    logs.write("a", *range(20))
    logs.write("b", 1, 2, end="")
    assert logs.round() == 2 and logs.lines() == [("a", n) for n in range(20)] + [("b", 1)]
    logs.write("a", 20)
    logs.rotate("a")
    logs.write("a", 21)
    logs.rotate("a")
    logs.write("a", 22, 23)
    logs.write("b", end="\n")
    logs.round()
    assert logs.lines() == [("a", n) for n in range(24)] + [("b", 1), ("b", 2)]
    logs.round()
    assert len(logs.lines()) == 26
    moved = spark.read.parquet(f"{logs.target}/positions/changes")
    assert {(r.batch_id, r.source) for r in moved.select("batch_id", "source").distinct().collect()} == {
        (2, "a"), (2, "b"), (3, "a"), (3, "b")
    }


def test_start_at_the_end(spark, tmp_path):
    logs = Logs(spark, tmp_path, "a")
    logs.write("a", 1, 2, 3, end="")
    logs.round(start_from="end")
    assert logs.lines() == []
    logs.write("a", end="4}\n")  # the open line became another one
    logs.write("a", 5)
    logs.round(start_from="end")
    rows = sorted(bytes(r.value).decode() for r in follow.lines_of(spark, logs.target).collect())
    assert rows == ['{"n": 3}4}', '{"n": 5}']


def test_a_round_that_died_is_done_again_from_its_plan(spark, tmp_path, monkeypatch):
    logs = Logs(spark, tmp_path, "a")
    logs.write("a", 1, 2)
    write = follow.LatestTable.write

    def dies(*_):
        raise RuntimeError("storage went away")

    monkeypatch.setattr(follow.LatestTable, "write", dies)
    with pytest.raises(RuntimeError):
        logs.round()
    monkeypatch.setattr(follow.LatestTable, "write", write)
    assert logs.lines() == []
    logs.write("a", 3)
    logs.rotate("a")
    logs.write("a", 4)
    assert logs.round() == 1 and logs.lines() == [("a", 1), ("a", 2)]
    logs.round()
    assert logs.lines() == [("a", n) for n in (1, 2, 3, 4)]


def test_lost_files_are_rows(spark, tmp_path):
    logs = Logs(spark, tmp_path, "abc")
    for s in "abc":
        logs.write(s, 1, 2, 3)
    logs.round()
    for s in "ab":
        os.remove(logs.paths[s])
    with open(logs.paths["a"] + ".new", "w") as file:
        file.write('{"n": 9}\n')
    os.rename(logs.paths["a"] + ".new", logs.paths["a"])
    saved = follow.positions_of(spark, logs.target)
    _, expected = owed_generations(read_manifest(logs.routes(), saved), saved, "beginning")
    expected = sorted(map(str, expected.collect()))
    logs.round()
    logs.round()
    lost = follow.lost_of(spark, logs.target)
    assert sorted(map(str, lost.drop("round").collect())) == expected and len(expected) == 2
    assert {r["round"] for r in lost.collect()} == {2}
    assert logs.lines() == sorted([("a", 9)] + [(s, n) for s in "abc" for n in (1, 2, 3)])


def test_many_sources_are_not_listed_on_the_driver(spark, tmp_path, monkeypatch):
    logs = Logs(spark, tmp_path, [f"s{i:04d}" for i in range(1000)])
    for i, s in enumerate(logs.paths):
        logs.write(s, i)

    def forbidden(*_, **__):
        raise AssertionError("listed on the driver")

    for module, name in ((glob, "glob"), (os, "listdir"), (os, "scandir")):
        monkeypatch.setattr(module, name, forbidden)
    logs.round(range_bytes=1 << 20)
    monkeypatch.undo()
    assert logs.lines() == [(f"s{i:04d}", i) for i in range(1000)]


def test_texts_are_written_and_rotated_in_tasks(spark, tmp_path):
    from tidewatch.sinks.files import rotate_files, write_texts

    rows = [(f"{tmp_path}/files/{n}/é.txt", f"l{n}\nopen") for n in range(20)]
    paths = write_texts(spark.createDataFrame(rows, "path string, value string"), f"{tmp_path}/written")
    assert sorted(r.path for r in paths.collect()) == sorted(p for p, _ in rows)
    for _ in range(2):
        rotate_files(paths)
    for path, text in rows:
        with open(f"{path}.1", newline="", encoding="utf-8") as handle:
            assert handle.read() == text
