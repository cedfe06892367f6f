import pytest
from alerts import alert

from tidewatch.schemas import RECORD
from tidewatch.sinks import ledger as lg
from tidewatch.streaming import ingest as streams
from tidewatch.streaming.restart import GaveUp, run_until_done


@pytest.fixture
def job(spark, tmp_path, records):
    """A job over three batches whose sink fails where the test wants it to."""
    source, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in range(3):
        records([alert(n) for n in range(4 * part, 4 * part + 6)], first=10 * part).coalesce(1).write.mode("append").parquet(source)
    commit, calls = lg.commit_batch(path), []

    def starter(fault):
        def write(batch, batch_id):
            calls.append(batch_id)
            fault(batch_id, calls.count(batch_id), lambda: commit(batch, batch_id))

        def begin():
            stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(source)
            return streams.start(stream.writeStream.foreachBatch(write), state)

        return begin

    return starter, calls, lambda: lg.read_ledger(spark, path)


def fail():
    raise RuntimeError("storage went away")


def test_batches_that_fail_before_and_after_their_write(job):
    starter, calls, ledger = job

    def fault(batch_id, call, write):
        if batch_id == 1 and call == 1:
            fail()  # nothing is written
        write()
        if batch_id == 1 and call == 2:
            fail()  # all is written, and Spark does not know

    waits = []
    run_until_done(starter(fault), tries=3, sleep=waits.append)
    assert calls == [0, 1, 1, 1, 2] and waits == [1.0, 2.0]
    assert lg.ingest_stats(ledger()).first().asDict() == {"consumed": 18, "inserted": 14, "duplicates": 4, "rejected": 0}
    assert sorted(r.batch_id for r in ledger().select("batch_id").distinct().collect()) == [0, 1, 2]


def test_a_job_that_never_gets_on_gives_up(job):
    starter, calls, _ = job
    waits = []
    with pytest.raises(GaveUp, match="3 times"):
        run_until_done(starter(lambda *_: fail()), tries=3, pause=0.5, sleep=waits.append)
    assert calls == [0, 0, 0] and waits == [0.5, 1.0]


def test_a_completed_batch_sets_the_count_back(job):
    starter, calls, ledger = job

    def fault(batch_id, call, write):
        if call == 1:
            fail()
        write()

    run_until_done(starter(fault), tries=3, sleep=lambda _: None)
    assert calls == [0, 0, 1, 1, 2, 2] and lg.findings(ledger()).count() == 14
