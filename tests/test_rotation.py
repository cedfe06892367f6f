import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.generations import drain_order, owed_generations
from tidewatch.sources.files import read_manifest
from tidewatch.sources import rotating_ndjson
from tidewatch.streaming.ingest import start


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    rotating_ndjson.register(spark)


def write(path, *numbers, end="\n"):
    with open(path, "a") as handle:
        handle.write("".join(f'{{"n":{n}}}\n' for n in numbers[:-1]))
        if numbers:
            handle.write(f'{{"n":{numbers[-1]}}}{end}')


def rotate(path):
    time.sleep(0.02)
    if os.path.exists(path + ".1"):
        os.rename(path + ".1", path + ".2")
    os.rename(path, path + ".1")


def numbers(frame):
    rows = frame.orderBy("generation", "end_offset").collect()
    return [json.loads(bytes(row.value))["n"] for row in rows]


def batch(spark, path, **options):
    return numbers(spark.read.format("rotating_ndjson").options(path=path, source="s", **options).load())


def saved(path, lines):
    return json.dumps({"s": {"file_id": os.stat(path).st_ino, "offset": lines * 8}})


@pytest.fixture
def log(tmp_path):
    return str(tmp_path / "alerts.json")


class Follower:
    def __init__(self, spark, path, folder, **options):
        self.spark, self.path, self.folder = spark, path, str(folder)
        self.options = {"path": path, "source": "s", "startFrom": "beginning", **options}

    def poll(self):
        """Numbers of the lines that are new since the last call, across a restart."""
        before = self._kept()
        stream = self.spark.readStream.format("rotating_ndjson").options(**self.options).load()
        start(stream.writeStream.format("parquet").option("path", self.folder + "/out"),
              self.folder + "/state").awaitTermination()
        after = self._kept()
        rows = [row for row in after if row not in before or after.count(row) > before.count(row)]
        return [json.loads(row[2])["n"] for row in sorted(rows)]

    def _kept(self):
        if not os.path.exists(self.folder + "/out/_spark_metadata"):
            return []
        rows = self.spark.read.parquet(self.folder + "/out").collect()
        return [(r.generation, r.end_offset, bytes(r.value).decode()) for r in rows]


@pytest.fixture
def follower(spark, log, tmp_path):
    return Follower(spark, log, tmp_path / "follow")


def test_follow_partial_lines_and_rotation(follower, log):
    write(log, 1, 2)
    assert follower.poll() == [1, 2]
    write(log, 3, end="")
    assert follower.poll() == []
    with open(log, "a") as handle:
        handle.write("\n")
    assert follower.poll() == [3]
    write(log, 4, end="")
    rotate(log)
    write(log, 5)
    assert follower.poll() == [4, 5]  # the cut line of the rotated file will never grow


def test_follow_truncation(follower, log):
    write(log, 1, 2, 3)
    assert follower.poll() == [1, 2, 3]
    open(log, "w").close()
    assert follower.poll() == []
    write(log, 9)
    assert follower.poll() == [9]


def test_copies_of_the_followed_file_are_not_read(follower, log):
    write(log, 1, 2)
    assert follower.poll() == [1, 2]
    shutil.copy(log, log + ".bak")
    write(log, 3)
    assert follower.poll() == [3]
    shutil.copy(log, log + ".1")  # copied and cut short in place
    open(log, "w").close()
    write(log, 4)
    assert follower.poll() == [4]
    write(log, 5)
    time.sleep(0.02)
    rotate(log)
    write(log, 6)
    assert follower.poll() == [5, 6]


def test_a_file_that_went_away_half_read(spark, log, tmp_path):
    write(log, *range(10))
    follower = Follower(spark, log, tmp_path / "half", maxBytesPerTrigger="16")
    assert follower.poll() != []
    os.remove(log)
    write(log + ".new", 50)
    os.rename(log + ".new", log)
    assert 50 in follower.poll()


def test_follow_missing_file_until_it_appears(follower, log, spark):
    assert follower.poll() == []
    write(log, 1)
    assert follower.poll() == [1]


def test_several_rotations_while_stopped(follower, log):
    write(log, 1, 2)
    assert follower.poll() == [1, 2]
    write(log, 3, 4)
    rotate(log)
    write(log, 5, 6)
    rotate(log)
    write(log, 7)
    with open(log + ".3.gz", "wb") as handle:
        handle.write(b"\x1f\x8b not lines\n")
    assert follower.poll() == [3, 4, 5, 6, 7]


def test_start_at_end_skips_history(spark, log, tmp_path):
    write(log, 1)
    follower = Follower(spark, log, tmp_path / "end", startFrom="end")
    assert follower.poll() == []
    write(log, 2)
    assert follower.poll() == [2]


def test_small_ranges_cover_every_line_once(spark, log):
    write(log, *range(500))
    for size in (7, 8, 9, 100):
        assert batch(spark, log, startFrom="beginning", rangeBytes=str(size)) == list(range(500))


def test_bytes_per_trigger(spark, log, tmp_path):
    write(log, *range(20))
    follower = Follower(spark, log, tmp_path / "limited", maxBytesPerTrigger="30")
    assert follower.poll() != []
    for _ in range(8):
        follower.poll()
    assert sorted(json.loads(row[2])["n"] for row in follower._kept()) == list(range(20))


def batch_sizes(spark, log, folder, **options):
    """Lines of each batch of a run; where batches are bounded, a run that reads what is there at once has one."""
    stream = spark.readStream.format("rotating_ndjson").options(path=log, source="s", startFrom="beginning", **options).load()
    query = start(stream.writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/state")
    query.awaitTermination()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_the_first_batch_of_a_run_is_bounded(spark, log, tmp_path):
    """1,000 bytes hold 100 lines of ten bytes; a line that has begun is read to its end."""
    limit = {"maxBytesPerTrigger": "1000"}
    logged = limit | {"planLog": str(tmp_path / "plan" / "log")}
    write(log, *range(100, 400))
    assert batch_sizes(spark, log, tmp_path / "free", **limit) == [300]  # not known yet where the stream begins
    done = 0
    for end in (400, 600, 900):
        if end == 600:
            rotate(log)
        if end > 400:
            write(log, *range(100 + done, end))
        while done < end - 100:
            sizes = batch_sizes(spark, log, tmp_path / "logged", **logged)
            assert 0 < max(sizes) <= 112
            done += sum(sizes)
        assert done == end - 100
    kept = spark.read.parquet(str(tmp_path / "logged" / "out")).collect()
    assert sorted(json.loads(bytes(r.value))["n"] for r in kept) == list(range(100, 900))


def test_batch_resumes_in_the_rotated_file(spark, log):
    write(log, 1, 2, 3, 4, 5)
    checkpoint = saved(log, 3)
    assert batch(spark, log, checkpoint=checkpoint) == [4, 5]
    write(log, 6)
    rotate(log)
    write(log, 7, 8)
    rotate(log)
    write(log, 9)
    assert batch(spark, log, checkpoint=checkpoint) == [4, 5, 6, 7, 8, 9]
    os.rename(log + ".2", log + ".renamed")
    assert batch(spark, log, checkpoint=checkpoint) == [4, 5, 6, 7, 8, 9]


def test_batch_when_the_file_is_gone_or_another(spark, log):
    write(log, 1, 2, 3)
    checkpoint = saved(log, 1)
    write(log + ".new", 7, 8)
    os.replace(log + ".new", log)
    assert batch(spark, log, checkpoint=checkpoint) == [7, 8]
    off_line = json.dumps({"s": {"file_id": os.stat(log).st_ino, "offset": 5}})
    assert batch(spark, log, checkpoint=off_line) == [7, 8]


def test_batch_finds_a_dated_folder(spark, log, tmp_path):
    write(log, 1, 2, 3)
    checkpoint = saved(log, 1)
    os.makedirs(tmp_path / "2025" / "Mar")
    os.rename(log, tmp_path / "2025" / "Mar" / "old-04.json")
    write(log, 4)
    pattern = str(tmp_path / "*" / "*" / "old-*.json")
    assert batch(spark, log, checkpoint=checkpoint, rotatedGlob=pattern) == [2, 3, 4]


def test_several_sources_in_one_scan(spark, tmp_path):
    for name in "ab":
        write(str(tmp_path / name), 1, 2)
    paths = json.dumps({name: str(tmp_path / name) for name in "ab"})
    frame = spark.read.format("rotating_ndjson").options(paths=paths, startFrom="beginning").load()
    found = {(r.source, r.n) for r in frame.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert found == {("a", 2), ("b", 2)}


def test_manifest_and_owed_generations(spark, log):
    write(log, 1, 2, 3)
    inode = os.stat(log).st_ino
    rotate(log)
    write(log, 4)
    rotate(log)
    write(log, 5)
    with open(log + ".1.gz", "wb") as handle:
        handle.write(b"x")
    routes = spark.createDataFrame(
        [("s", log, None), ("gone", log + "-missing/x", None)], "name string, path string, rotated_glob string"
    )
    for offset, first in ((16, [16, 0, 0]), (5, [0])):
        checkpoint = spark.createDataFrame([("s", inode, offset)], "source string, file_id long, offset long")
        manifest = read_manifest(routes, checkpoint)
        owed, lost = owed_generations(manifest, checkpoint)
        rows = drain_order(owed).orderBy("position").collect()
        assert [row.start_offset for row in rows] == first
        assert rows[-1].path == log
        assert [(r.lost_after_offset, r.reason) for r in lost.collect()] == (
            [] if offset == 16 else [(5, "generation_missing")]
        )


def test_bad_options(spark, log):
    with pytest.raises(Exception, match="startFrom"):
        spark.read.format("rotating_ndjson").options(path=log, startFrom="middle").load().collect()
