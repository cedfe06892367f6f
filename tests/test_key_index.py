import random

import pytest
from alerts import alert
from pyspark.sql import functions as F

from tidewatch.sinks import key_index, ledger as lg
from tidewatch.sinks.key_index import KeyIndex, hashed

KEYS = ("manager", "alert_id")


@pytest.fixture
def index(spark, tmp_path):
    """An index for small batches, in a session that spends little on each job."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield KeyIndex(spark, str(tmp_path), KEYS, fan_in=3)
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def keys(spark):
    return lambda numbers: spark.sql(
        f"SELECT 'm' || n % 3 AS manager, 'id-' || n AS alert_id FROM (SELECT explode(array{tuple(numbers) + (-1,)}) AS n) WHERE n >= 0"
    )


def found(index, batch, run, number):
    """The keys of the batch that the index knows."""
    rows = batch.select("alert_id", *hashed(*KEYS))
    known = index.known(rows.select("hi", "lo"), run, number)
    ids = [] if known is None else rows.join(known, ["hi", "lo"], "left_semi").collect()
    index.release()
    return sorted(int(r.alert_id[3:]) for r in ids)


def test_lookup_equals_a_set_over_many_batches(index, keys):
    """50 batches: what is read for a batch stays with the batch, however much is stored."""
    rng, stored, opened, parts = random.Random(2), set(), [], []
    for number in range(50):
        fresh = range(1000 * number, 1000 * number + 40)
        again = rng.sample(sorted(stored), min(len(stored), 3 * (number % 5 == 4)))
        assert found(index, keys([*fresh, *again]), "r", number) == sorted(again)
        if not again:
            opened.append(index.looked.opened)
        parts.append(index.looked.parts)
        index.add(keys(fresh), "r", number)
        index.merge()
        stored.update(fresh)
    assert sum(opened) <= 2  # fresh keys open files only by a filter's mistake
    assert max(parts) <= 4 * 2  # four levels of at most two parts each
    assert sum(p.keys for p in index.live()) == len(stored)


def test_slots_are_opened_one_by_one(spark, tmp_path, keys):
    index = KeyIndex(spark, str(tmp_path), KEYS, slot_keys=100)
    index.add(keys(range(3000)), "r", 0)
    assert found(index, keys([17, 5000, 5001]), "r", 1) == [17]
    assert (index.looked.parts, index.looked.opened) == (1, 1) and index.looked.slots <= 3
    rows = index._read([(index.live()[0], None)])
    assert rows.count() == 3000
    files = rows.select("slot", F.input_file_name().alias("file")).distinct()
    assert files.count() == files.select("slot").distinct().count() == 32
    assert files.filter("NOT file LIKE concat('%slot=', slot, '/%')").isEmpty()


def test_filter_has_no_misses_and_few_mistakes(index, keys):
    index.add(keys(range(6000)), "r", 0)
    part = index.live()[0]
    batch = keys(range(3000, 15000)).select(*hashed(*KEYS))
    slots = [[0]]
    passed = index._maybe(batch, [part], slots)
    assert 3000 <= passed.count() <= 3060


def test_a_replayed_batch_does_not_meet_itself(index, keys):
    for number in range(3):
        index.add(keys(range(10 * number, 10 * number + 10)), "r", number)
        index.merge()  # the last one merges the part of the replayed batch, too
    assert len(index.live()) == 1
    batch = keys([5, 23, 24])
    assert found(index, batch, "r", 2) == [5]
    assert found(index, batch, "other", 0) == [5, 23, 24]
    index.add(keys([23, 24]), "r", 2)
    assert found(index, batch, "r", 2) == [5] and found(index, batch, "r", 3) == [5, 23, 24]


def test_a_batch_added_twice_is_one_part(index, keys):
    index.add(keys([1, 2]), "r", 0)
    index.add(keys([1]), "r", 0)
    assert [p.keys for p in index.live()] == [1]
    assert found(index, keys([1, 2]), "r", 1) == [1]


def test_merged_files_go_after_a_time(index, keys):
    for number in range(3):
        index.add(keys([number]), "r", number)
    index.merge()
    assert index.sweep() == 0 and len(index.log.names("data")) == 4
    assert index.sweep(grace=0) == 3 and len(index.log.names("data")) == 1
    assert found(index, keys([0, 2, 9]), "r", 9) == [0, 2]


def test_keys_differ_by_column(spark):
    rows = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("", "abc"), (None, "abc"), ("1:a", "")], "manager string, alert_id string")
    assert rows.select(*hashed(*KEYS)).distinct().count() == 5


def test_a_batch_that_died_before_it_was_indexed(spark, tmp_path, records, monkeypatch):
    """Its rows are in the ledger, its keys are not: neither another run nor its own replay may store them again."""
    path = str(tmp_path)
    lg.commit_batch(path)(records([alert(1)]), 0)

    def dies(self, *_):
        raise RuntimeError("storage went away")

    with monkeypatch.context() as patch:
        patch.setattr(key_index.KeyIndex, "add", dies)
        with pytest.raises(RuntimeError):
            lg.commit_batch(path)(records([alert(2), alert(3)], first=1), 1)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "another")
    try:
        lg.commit_batch(path)(records([alert(3), alert(4)], first=3), 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    lg.commit_batch(path)(records([alert(2), alert(3)], first=1), 1)
    ledger = lg.read_ledger(spark, path)
    counts = {r.alert_id: r["count"] for r in lg.findings(ledger).groupBy("alert_id").count().collect()}
    assert counts == dict.fromkeys(("id-1", "id-2", "id-3", "id-4"), 1)


def test_a_ledger_without_an_index_gets_one(spark, tmp_path, records):
    path = str(tmp_path)
    lg.commit_batch(path)(records([alert(1), alert(2)]), 0)
    index = KeyIndex(spark, path, lg.KEYS)
    for folder in ("live", "data", "bloom"):
        index.log.remove(".", folder)
    lg.commit_batch(path)(records([alert(2), alert(3)], first=2), 1)
    assert lg.ingest_stats(lg.read_ledger(spark, path)).first().asDict() == {
        "consumed": 4, "inserted": 3, "duplicates": 1, "rejected": 0
    }


def test_batches_do_not_read_the_ledger(spark, tmp_path, records, monkeypatch):
    path = str(tmp_path)
    lg.commit_batch(path)(records([alert(1)]), 0)
    monkeypatch.setattr(lg, "read_ledger", None)
    lg.commit_batch(path)(records([alert(1), alert(2)], first=1), 1)
    monkeypatch.undo()
    assert lg.findings(lg.read_ledger(spark, path)).count() == 2


def test_a_large_part_is_made_in_several_tasks(spark, tmp_path, monkeypatch):
    from tidewatch.sinks import key_index

    monkeypatch.setattr(key_index, "TASK_KEYS", 500)
    index = key_index.KeyIndex(spark, str(tmp_path), ("k",))
    part = index.add(spark.range(4000).selectExpr("cast(id as string) AS k"), "run", 0)
    assert len(list((tmp_path / "keys/data" / part.name / "slot=0").glob("*.parquet"))) > 2
    batch = spark.range(3990, 4010).selectExpr("cast(id as string) AS k").select(*key_index.hashed("k"))
    assert index.known(batch, "run", 1).count() == 10
    index.release()


def test_a_large_batch_is_joined_with_the_stored_keys(index, keys, monkeypatch):
    """No filter is read for a batch that would open all slots; with far more stored keys it is."""
    index.add(keys(range(30)), "r", 0)
    index.add(keys(range(30, 60)), "r", 1)
    monkeypatch.setattr(key_index, "is_small", lambda rows: False)
    assert found(index, keys([*range(20, 40), *range(70, 80)]), "r", 2) == list(range(20, 40))
    assert (index.looked.parts, index.looked.slots) == (2, 0)
    assert found(index, keys(range(20, 40)), "r", 1) == list(range(20, 30))  # not its own
    assert found(index, keys([3, 70]), "r", 2) == [3]
    assert index.looked.slots == 2
