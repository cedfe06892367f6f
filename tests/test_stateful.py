import random

import numpy as np
import pytest
from alerts import alert
from pyspark.sql import functions as F

from tidewatch.operators import audit, delivery
from tidewatch.sinks import ledger as lg
from tidewatch.sinks.latest import LatestTable
from tidewatch.streaming import ingest as streams
from tidewatch.streaming import stateful

LINES = "source string, seq long, file_id long, end_offset long, settled boolean"


class Feed:
    """A folder of files that a stream reads, and where its job keeps things."""

    def __init__(self, spark, path, schema):
        self.spark, self.schema = spark, schema
        self.source, self.target, self.state = (str(path / name) for name in ("in", "out", "state"))

    def run(self, starter, rows, **more):
        if rows is not None:
            rows.write.mode("append").parquet(self.source)
        stream = self.spark.readStream.schema(self.schema).parquet(self.source)
        starter(stream, self.target, self.state, **more).awaitTermination()


@pytest.fixture
def feed(spark, tmp_path):
    return lambda schema: Feed(spark, tmp_path, schema)


def ledger_rows(spark, path):
    rows = lg.read_ledger(spark, path).select("source_topic", "source_partition", "source_offset", "disposition", "alert_id", "location")
    return sorted(map(str, rows.collect()))


def test_state_and_ledger_agree_row_by_row(spark, tmp_path, records):
    """Hot keys, rejects, copies within and across batches, in two partitions."""
    rng = random.Random(4)
    jobs = {s: Feed(spark, tmp_path / s.__name__, records([]).schema) for s in (streams.ingest, streams.ingest_with_state)}
    for number in range(3):
        values = [alert(7, location=f"l{i}") if rng.random() < 0.4 else alert(rng.randint(0, 30)) for i in range(60)]
        values[5 * number], values[30] = "junk", None
        rows = records(values, first=100 * number).withColumn("partition", (F.col("offset") % 2).cast("int"))
        for starter, job in jobs.items():
            job.run(starter, rows.repartition(3))
    first, second = (ledger_rows(spark, job.target) for job in jobs.values())
    assert first == second and sum("inserted" in r for r in first) >= 25
    stats = [lg.ingest_stats(lg.read_ledger(spark, job.target)).first() for job in jobs.values()]
    assert stats[0] == stats[1] and stats[0].rejected >= 6


def test_a_new_checkpoint_starts_with_stored_keys(feed, spark, records, tmp_path):
    job = feed(records([]).schema)
    job.run(streams.ingest, records([alert(1), alert(2)]))
    job.state = str(tmp_path / "other")
    job.run(streams.ingest_with_state, records([alert(2), alert(3)], first=2))
    job.run(streams.ingest_with_state, records([alert(1), alert(3), alert(4)], first=4))
    found = lg.findings(lg.read_ledger(spark, job.target))
    assert sorted(r.alert_id for r in found.collect()) == ["id-1", "id-2", "id-3", "id-4"]
    job.state = str(tmp_path / "third")  # what the state job stored is in the index, too
    job.run(streams.ingest, records([alert(4), alert(5)], first=7))
    assert lg.findings(lg.read_ledger(spark, job.target)).count() == 5


def test_a_failed_state_batch_is_replayed(feed, spark, records, monkeypatch):
    job = feed(records([]).schema)
    store = streams.store_batch

    def fails(*args):
        store(*args)
        raise RuntimeError("storage went away")

    with monkeypatch.context() as patch:
        patch.setattr(streams, "store_batch", fails)
        with pytest.raises(Exception, match="went away"):
            job.run(streams.ingest_with_state, records([alert(1), alert(2), alert(1)]))
    job.run(streams.ingest_with_state, None)
    assert lg.ingest_stats(lg.read_ledger(spark, job.target)).first().asDict() == {
        "consumed": 3, "inserted": 2, "duplicates": 1, "rejected": 0
    }


def test_copies_are_settled_in_their_task():
    import pandas as pd

    frame = pd.DataFrame({
        "hi": [1, 1, 2, 1, 1], "lo": [5, 5, 5, 5, 5], "topic": ["t"] * 5, "partition": [0] * 5,
        "offset": [4, 6, 1, 2, 3], "value": [b""] * 5, "disposition": [None, None, "rejected", None, None],
    })
    marks = [m for f in stateful._first_in_task(iter([frame.iloc[:2], frame.iloc[2:]])) for m in f["disposition"]]
    assert marks == [None, "duplicate", "rejected", None, "duplicate"]


def plain_position(lines, settled):
    """File, offset and lines in flight of lines (seq, file_id, end_offset) in order."""
    last, flying = (None, 0), 0
    for seq, file_id, offset in sorted(lines):
        if not flying and seq in settled:
            last = (file_id, offset)
        else:
            flying += 1
    return (*last, flying)


def test_merged_lines_equal_a_plain_walk():
    rng = random.Random(9)
    for _ in range(200):
        held, seen, settled = np.zeros((0, 6), dtype=np.int64), [], set()
        seq, waiting = 0, []
        for _ in range(rng.randint(1, 6)):
            new = []
            for _ in range(rng.randint(0, 8)):
                seq += rng.randint(1, 3)
                done = rng.random() < 0.2
                new.append((seq, seq // 10, 100 + seq, int(done)))
                if done:
                    settled.add(seq)
                else:
                    waiting.append(seq)
            acks = [s for s in waiting if rng.random() < 0.5]
            acks += [rng.choice(acks)] if acks else []
            acks += [s for s in settled if rng.random() < 0.1]
            early = [seq + rng.randint(1, 4)] if rng.random() < 0.3 else []
            rng.shuffle(new)
            held = stateful.merged_lines(
                held, np.array(new, dtype=np.int64).reshape(-1, 4), np.array(acks + early, dtype=np.int64)
            )
            settled.update(acks + early)
            seen += [n[:3] for n in new]
            rows = held[held[:, 0] != stateful._EARLY]
            opened = np.nonzero(rows[:, 0] == 0)[0]
            first = opened[0] if len(opened) else len(rows)
            got = (rows[first - 1, 4], rows[first - 1, 5]) if first else (None, 0)
            assert (*got, rows[first:, 3].sum()) == plain_position(seen, settled)
            assert rows[:, 3].sum() == len(seen) and len(rows) <= 2 * len(opened) + 1


def test_commits_follow_acknowledgements_in_any_order(feed, spark):
    rng = random.Random(1)
    job = feed(LINES)
    sources = ("a", "b", None)
    numbers = {s: [n for n in range(1, 400) if rng.random() < 0.6] for s in sources}
    step = 65530  # lines lie on both sides of a block's end
    lines, settled, open_ones = [], set(), []
    for batch in range(4):
        rows = []
        for s in sources:
            for n in numbers[s][60 * batch : 60 * batch + 60]:
                done = rng.random() < 0.3
                rows.append((s, step + n, n // 50, 10 * n, done))
                lines.append(rows[-1])
                if done:
                    settled.add((s, step + n))
                else:
                    open_ones.append((s, step + n))
        rng.shuffle(open_ones)
        acks, open_ones = open_ones[: 2 * len(open_ones) // 3], open_ones[2 * len(open_ones) // 3 :]
        settled.update(acks)
        rows += [(s, n, None, None, True) for s, n in acks + acks[:5]]
        job.run(streams.running_commits, spark.createDataFrame(rows, LINES).repartition(3))
        ledger = spark.createDataFrame(
            [(s, n, f, o, (s, n) in settled) for s, n, f, o, _ in lines], LINES
        )
        initial = spark.createDataFrame([("a", 99, 1), ("idle", 98, 2)], "source string, file_id long, offset long")
        expected = delivery.committed_prefix(ledger, initial).collect()
        assert sorted(map(str, streams.commits_of(spark, job.target, initial).collect())) == sorted(map(str, expected))
    assert {r.source for r in expected} == {*sources, "idle"} and all(r.in_flight for r in expected if r.source != "idle")


def test_a_batch_of_acknowledgements_alone(feed, spark):
    job, big = feed(LINES), (1 << 60) + 1  # a number that a float cannot hold
    job.run(streams.running_commits, spark.createDataFrame([("a", n, big, big + n, n == 3) for n in (1, 2, 3)], LINES))
    job.run(streams.running_commits, spark.createDataFrame([("a", 1, None, None, True)] * 2, LINES))
    assert [tuple(r) for r in streams.commits_of(spark, job.target).collect()] == [("a", big, big + 1, 2)]
    rows = [("a", 2, None, None, True), ("a", 4, big + 1, big + 4, None)]
    job.run(streams.running_commits, spark.createDataFrame(rows, LINES))
    assert [tuple(r) for r in streams.commits_of(spark, job.target).collect()] == [("a", big, big + 3, 1)]


def test_positions_are_given_out_by_a_timer(feed, spark):
    job = feed(LINES)
    spark.createDataFrame([("a", 1, 0, 10, True), ("a", 2, 0, 20, False)], LINES).write.parquet(job.source)
    stream = spark.readStream.schema(LINES).parquet(job.source)
    query = streams.running_commits(stream, job.target, job.state, every="500 milliseconds", report_ms=3000)
    try:
        import time

        seen = []
        for i in range(60):
            rows = streams.commits_of(spark, job.target).collect()
            seen.append(len(rows))
            if rows:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert seen[0] == 0 and [tuple(r) for r in rows] == [("a", 0, 10, 1)]


def test_audit_over_batches_equals_the_audit_of_all(feed, spark, records):
    rng = random.Random(6)
    numbers = [rng.choice([rng.randint(1, 300), 65536 + rng.randint(-40, 40), 200_000, -rng.randint(0, 9)]) for _ in range(500)]
    job = feed(records([]).schema)
    for part in range(3):
        own = numbers[part::3] + [5] * 300  # a hot number
        job.run(streams.running_audit, records([f'{{"demo_seq":{n}}}' for n in own], first=1000 * part).repartition(3))
    all_numbers = spark.createDataFrame([("t", 0, i, n) for i, n in enumerate(numbers + [5] * 900)],
                                        "topic string, partition int, offset long, seq long")
    assert streams.audit_of(spark, job.target).first() == audit.seq_audit(all_numbers).first()


def test_an_audit_batch_touches_its_own_blocks(feed, spark, records):
    job = feed(records([]).schema)
    job.run(streams.running_audit, records([f'{{"demo_seq":{n}}}' for n in range(1, 2_000_000, 50_000)]))
    job.run(streams.running_audit, records(['{"demo_seq":70000}', '{"demo_seq":70001}'], first=100))
    changed = spark.read.parquet(f"{job.target}/ranges/changes/batch_id=1")
    assert [(r.block, r.received) for r in changed.collect()] == [(1, 3)]
    row = streams.audit_of(spark, job.target).first()
    assert (row.received, row.unique_seqs, row.highest) == (42, 42, 1_950_001)


def test_latest_states_over_merges(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path), ["k"], "k long, v long", merge_every=3)
    assert table.read().collect() == []
    state = {}
    for batch in range(11):
        new = {k: 100 * batch + k for k in range(batch % 4, 10, 3)}
        state.update(new)
        for _ in range(1 + (batch in (3, 5, 9))):  # some are written again
            table.write(spark.createDataFrame(list(new.items()), "k long, v long"), batch)
        assert dict(map(tuple, table.read().collect())) == state
    assert table._numbers("base") == [6, 9] and min(table._numbers("changes")) == 6


class Calls:
    """A map state that counts its calls."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value


def test_state_is_called_once_a_bucket_and_not_once_a_key():
    seen, rng = stateful.FirstSeen(), random.Random(9)
    seen.seen = Calls()
    keys = [(rng.randint(-(1 << 62), 1 << 62), n) for n in range(5000)]
    for own in (keys[:3000], keys[2000:] + keys[4000:]):
        known = {tuple(k) for v in seen.seen.held.values() for k in np.frombuffer(v[0], "<i8").reshape(-1, 2).tolist()}
        first = [k not in known and k not in own[:i] for i, k in enumerate(own)]
        assert seen._new(*np.array(own, dtype=np.int64).T).tolist() == first
    assert seen.seen.calls <= 4 * stateful.BUCKETS
