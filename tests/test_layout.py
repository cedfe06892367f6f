import threading

import pytest
from alerts import alert

from tidewatch.operators import findings as fq
from tidewatch.sinks import ledger as lg
from tidewatch.sinks.layout import Layout


@pytest.fixture
def store(spark, tmp_path, records):
    """A ledger to which batches of alerts over several days are committed."""
    path = str(tmp_path)
    commit = lg.commit_batch(path)
    state = {"batch": 0}

    def send(numbers):
        values = [alert(n, timestamp=f"2025-03-{1 + n % 20:02d}T05:06:07.{n % 1000:03d}+0000") for n in numbers]
        commit(records(values, first=1000 * state["batch"]), state["batch"])
        state["batch"] += 1

    return path, send


def rows(df):
    return sorted(map(str, df.drop("ingested_at").collect()))


def test_every_finding_is_read_once_whatever_is_compacted(spark, store):
    path, send = store
    layout = Layout(spark, path, file_rows=10, fan_in=2)
    for batch in range(5):
        send(range(40 * batch, 40 * batch + 45))
        assert rows(layout.read()) == rows(lg.findings(lg.read_ledger(spark, path)))
        if batch % 2:
            layout.compact()
            assert rows(layout.read()) == rows(lg.findings(lg.read_ledger(spark, path)))
    assert len(layout.log.live()) == 1 and layout.log.live()[0]["level"] == 1  # two were merged
    assert layout.sweep() == 0 and layout.sweep(grace=0) == 2
    assert layout.read().count() == 205
    assert layout.compact() > 0 and layout.compact() == 0


def test_the_last_batch_of_a_run_is_not_taken(spark, store, records):
    path, send = store
    layout = Layout(spark, path)
    send(range(5))
    assert layout.compact() == 0
    send(range(3, 9))
    assert layout.compact() == 5
    lg.commit_batch(path)(records([alert(20)], first=1000), 1)  # the last batch is replayed with other rows
    assert sorted(r.alert_id for r in layout.read().collect()) == sorted(f"id-{n}" for n in (0, 1, 2, 3, 4, 20))


@pytest.mark.parametrize("question", [
    {"since": "2025-03-18 00:00:00"}, {"since": "2025-03-03 00:00:00", "until": "2025-03-04 00:00:00", "least_level": 12},
    {"agent": "node-p3", "since": "2025-03-10 00:00:00"}, {"technique": "X7"}, {"technique": "none"}, {"least_level": 16},
])
def test_questions_open_only_files_they_need(spark, store, question):
    path, send = store
    layout = Layout(spark, path, file_rows=8)
    send(range(300))
    send([300])
    layout.compact()
    everything = [f for f in layout.read().inputFiles() if "/layout/" in f]
    found = layout.read(**question)
    opened = [f for f in found.inputFiles() if "/layout/" in f]
    assert len(everything) > 20 and len(opened) < len(everything) / 2
    tail = Layout(spark, f"{path}/nothing")  # no layout: the ledger alone
    tail.path = path
    assert rows(found) == rows(tail.read(**question))


def test_rows_stay_while_batches_come_in(spark, store):
    """Readers see each finding once while another thread compacts and merges."""
    path, send = store
    layout = Layout(spark, path, file_rows=20, fan_in=2)
    send(range(30))
    failures = []

    def work():
        try:
            for _ in range(4):
                Layout(spark, path, file_rows=20, fan_in=2).compact()
        except Exception as e:  # noqa: BLE001 (shown by the test)
            failures.append(e)

    for batch in range(1, 4):
        send(range(30 * batch, 30 * batch + 30))
        other = threading.Thread(target=work)
        other.start()
        for _ in range(3):
            found = layout.read()
            assert found.count() == found.select("alert_id").distinct().count() == 30 * batch + 30
        other.join()
    assert not failures


def test_the_three_questions_of_analysts(spark, store):
    path, send = store
    layout = Layout(spark, path, file_rows=10)
    send(range(200))
    send(range(200, 220))
    layout.compact()
    found = lg.findings(lg.read_ledger(spark, path))
    as_of = "2025-03-20 12:00:00"
    severe = fq.top_severe(layout.read(since="2025-03-19 12:00:00", until=as_of), as_of, hours=24)
    assert rows(severe) == rows(fq.top_severe(found, as_of, hours=24))
    techniques = fq.technique_rollup(layout.read(technique="X9")).filter("technique = 'X9'")
    assert rows(techniques) == rows(fq.technique_rollup(found).filter("technique = 'X9'"))
    agent = layout.read(agent="node-p1").groupBy("agent_name").count()
    assert rows(agent) == rows(found.filter("agent_name = 'node-p1'").groupBy("agent_name").count())
