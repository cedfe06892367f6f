import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import audit, delivery, queueing, routes, shuffles
from tidewatch.operators.envelopes import pack_envelopes, unpack_envelopes


def seqs(spark, numbers):
    rows = [("t", 0, i, n) for i, n in enumerate(numbers)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, seq long")


@pytest.mark.parametrize(
    ("numbers", "gaps", "duplicates"),
    [([1, 2, 3], [], 0), ([1, 2, 3, 5], [4], 0), ([1, 2, 3, 5, 4], [], 0), ([1, 2, 3, 5, 4, 3], [], 1),
     ([7], [1, 2, 3, 4, 5, 6], 0), ([0, -3, 2], [1], 0)],
)
def test_audit(spark, numbers, gaps, duplicates):
    frame = seqs(spark, numbers)
    row = audit.seq_audit(frame).first()
    assert (row.first_gaps, row.gaps, row.duplicates) == (gaps, len(gaps), duplicates)
    assert (row.received, row.unique_seqs) == (len(numbers), len(set(numbers)))
    assert sorted(r.seq for r in audit.seq_gaps(frame).collect()) == gaps


def test_audit_of_nothing(spark):
    row = audit.seq_audit(seqs(spark, [])).first()
    assert (row.received, row.highest, row.gaps, row.has_gaps) == (0, 0, 0, False)


def test_gap_runs_across_blocks_match_brute_force(spark):
    rng = random.Random(5)
    numbers = [n for n in range(1, 4000) if rng.random() < 0.4 and not 700 < n < 2500]
    frame = seqs(spark, numbers + numbers[:50])
    runs = audit.gap_runs(frame, block=16).collect()
    listed = sorted(n for run in runs for n in range(run.start, run.stop + 1))
    assert listed == sorted(set(range(1, max(numbers) + 1)) - set(numbers))
    assert [r.seq for r in audit.first_gaps(frame).collect()] == listed[:10]


def test_audit_line(spark):
    line = audit.seq_audit(seqs(spark, [1, 2, 5, 5])).select(audit.audit_line().alias("l")).first().l
    assert line == "[audit] received=4 unique=3 highest=5 duplicates=1 | !! 2 GAP(S): [3, 4]"


def test_hot_duplicate_is_marked_once_fresh(spark):
    marked = audit.mark_duplicates(seqs(spark, [9] * 500 + list(range(20, 40))))
    assert marked.filter("not is_duplicate").count() == 21
    assert marked.filter("seq = 9 and not is_duplicate").first().offset == 0


@pytest.mark.parametrize(
    ("settled", "expected"),
    [((), (10, 100, 3)), ((2,), (10, 100, 3)), ((1, 2), (11, 200, 1)), ((1, 2, 3), (11, 250, 0)),
     ((1, 3), (11, 150, 2))],
)
def test_commit_stops_before_the_first_unsettled_line(spark, settled, expected):
    lines = [("a", i + 1, 11, end, i + 1 in settled) for i, end in enumerate((150, 200, 250))]
    ledger = spark.createDataFrame(
        lines, "source string, seq long, file_id long, end_offset long, settled boolean"
    )
    initial = spark.createDataFrame([("a", 10, 100)], "source string, file_id long, offset long")
    row = delivery.committed_prefix(ledger, initial).first()
    assert (row.file_id, row.offset, row.in_flight) == expected
    if not settled:
        row = delivery.committed_prefix(ledger).first()
        assert (row.file_id, row.offset) == (None, 0)


def test_a_source_without_a_name_is_a_source(spark):
    lines = [(s, i, 1, 100 * i, o) for s in ("a", None) for i, o in enumerate(
        ("delivered", "delivered", "pending", "delivered", "delivered"), 1)]
    ledger = spark.createDataFrame(lines, "source string, seq long, file_id long, end_offset long, outcome string")
    initial = spark.createDataFrame([(None, 9, 50), ("idle", 8, 7)], "source string, file_id long, offset long")
    rows = {r.source: r for r in delivery.delivery_stats(ledger, initial).collect()}
    assert set(rows) == {"a", None, "idle"}
    for source in ("a", None):
        r = rows[source]
        assert (r.produced, r.acked, r.in_flight, r.file_id, r.offset) == (5, 4, 3, 1, 200)
    assert (rows["idle"].file_id, rows["idle"].offset, rows["idle"].produced) == (8, 7, 0)
    acked = delivery.apply_acks(ledger, ledger.filter("outcome = 'delivered'"))
    assert sorted((str(r.source), r.seq, r.settled) for r in acked.collect()) == sorted(
        (str(s), i, o == "delivered") for s, i, _, _, o in lines
    )
    nothing = ledger.withColumn("outcome", F.lit("pending"))
    rows = {r.source: r for r in delivery.delivery_stats(nothing, initial).collect()}
    assert (rows[None].file_id, rows[None].offset, rows["a"].offset) == (9, 50, 0)


def test_refused_events_without_a_source_are_dead(spark):
    queue = spark.createDataFrame([(None, "1", 1), (None, "2", 1), ("a", "1", 1)], "source string, queue_key string, size long")
    outcomes = queue.filter("queue_key = '1'").withColumn("disposition", F.lit("dead"))
    assert sorted(map(str, queueing.dead_letters(queue, outcomes).collect())) == sorted(
        map(str, queue.filter("queue_key = '1'").collect())
    )


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize(("how", "expected"), [("inner", 2), ("left", 3), ("left_semi", 2), ("left_anti", 1)])
def test_lookup_join_finds_missing_keys(spark, monkeypatch, small, how, expected):
    monkeypatch.setattr(shuffles, "is_small", lambda df: small)
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v long")
    lookup = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w long")
    assert shuffles.lookup_join(rows, lookup, ["k"], how).count() == expected


def test_a_denied_sender_without_a_name_denies_nobody(spark):
    from tidewatch.operators.envelopes import drop_revoked

    sent = spark.createDataFrame([(None,), ("a",), ("b",)], "agent_id string")
    left = drop_revoked(sent, spark.createDataFrame([(None,), ("a",)], "agent_id string"))
    assert sorted(str(r.agent_id) for r in left.collect()) == ["None", "b"]


def test_outcomes(spark):
    cases = {200: "ack", 299: "ack", 301: "dead", 400: "dead", 401: "halt", 403: "halt", 404: "dead",
             408: "retry", 429: "retry", 500: "retry", 503: "retry", None: "retry", 100: "dead"}
    frame = spark.createDataFrame([(s,) for s in cases], "status int")
    found = {r.status: r.disposition for r in delivery.delivery_outcome(frame).collect()}
    assert found == cases


def queue(spark, sizes, source="h"):
    rows = [(source, f"{i:05d}", size, '{"n":%d}' % i) for i, size in enumerate(sizes)]
    return spark.createDataFrame(rows, "source string, queue_key string, size long, body string")


def keys(frame):
    return [int(r.queue_key) for r in frame.orderBy("queue_key").collect()]


def pack_brute(sizes, max_n, max_bytes):
    taken, total = [], 0
    for i, size in enumerate(sizes):
        if max_n and len(taken) >= max_n:
            break
        if max_bytes and taken and total + size > max_bytes:
            break
        taken.append(i)
        total += size
    return taken


def retain_brute(sizes, max_events, max_bytes):
    kept = []
    for i, size in enumerate(sizes):
        while kept and (
            (max_events and len(kept) + 1 > max_events)
            or (max_bytes and sum(sizes[k] for k in kept) + size > max_bytes)
        ):
            kept.pop(0)
        kept.append(i)
    return kept


LIMITS = [(0, 0), (2, 0), (0, 1), (0, 40), (3, 25), (2000, 60), (5, 1000)]


@pytest.mark.parametrize(("max_n", "max_bytes"), LIMITS)
def test_pack_and_retain_match_brute_force(spark, max_n, max_bytes):
    rng = random.Random(max_n + max_bytes)
    sizes = [rng.choice([1, 5, 10, 30, 100]) for _ in range(40)]
    frame = queue(spark, sizes)
    assert keys(queueing.pack_batch(frame, max_n, max_bytes)) == pack_brute(sizes, max_n, max_bytes)
    assert keys(queueing.retain(frame, max_n, max_bytes)) == retain_brute(sizes, max_n, max_bytes)


def test_corrupt_items_are_set_aside(spark):
    frame = queue(spark, [1, 1]).unionByName(
        spark.createDataFrame([("h", "00009", 3, "{bad"), ("h", "00010", 3, "[1]")],
                              "source string, queue_key string, size long, body string")
    )
    readable, dead = queueing.split_corrupt(frame)
    assert (keys(readable), keys(dead)) == ([0, 1], [9, 10])


@pytest.mark.parametrize("rows", [0, 10**9])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_agrees_on_both_paths(spark, monkeypatch, rows, how):
    monkeypatch.setattr(shuffles, "BROADCAST_ROWS", rows)
    big = spark.createDataFrame(
        [("hot" if i % 3 else f"k{i % 7}", i) for i in range(300)] + [(None, -1)], "k string, v long"
    )
    small = spark.createDataFrame([("hot", 1), ("k0", 2), ("zz", 3)], "k string, w int")
    expected = sorted(map(str, big.join(small, "k", how).collect()))
    assert sorted(map(str, shuffles.lookup_join(big, small, ["k"], how).collect())) == expected


def test_a_side_that_is_copied_for_each_salt_is_not_broadcast(spark, tmp_path, monkeypatch):
    """By its file's size Spark would take it for small, although it was measured to be too large."""
    monkeypatch.setattr(shuffles, "BROADCAST_ROWS", 100)
    spark.range(1000).selectExpr("id k", "id % 7 w").write.parquet(str(tmp_path / "lookup"))
    found = shuffles.lookup_join(spark.range(2000).withColumnRenamed("id", "k"), spark.read.parquet(str(tmp_path / "lookup")), ["k"])
    assert len(found.collect()) == 1000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("slice_rows", [10_000, 90])
def test_running_totals_with_a_hot_group(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(shuffles, "SLICE_ROWS", slice_rows)
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 5}" if i % 7 else None, i, rng.randint(0, 9)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "g string, o long, m long").repartition(7)
    found = {
        (r.g, r.o): (r.n, r.total)
        for r in shuffles.running_totals(
            frame, ["g"], ["o"], {"n": F.lit(1), "total": F.col("m")}
        ).collect()
    }
    state = defaultdict(lambda: [0, 0])
    for g, o, m in rows:
        state[g][0] += 1
        state[g][1] += m
        assert found[(g, o)] == tuple(state[g])


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_with_ties_and_missing_orders(spark, monkeypatch, descending):
    """Rows that agree in group and order stay apart; what is stored has no other columns."""
    stored = []
    pin = shuffles.pin
    monkeypatch.setattr(shuffles, "SLICE_ROWS", 7)
    monkeypatch.setattr(shuffles, "pin", lambda df: (stored.append(df.columns), pin(df))[1])
    rows = [("a", i // 3 if i % 11 else None, 1 + i % 2, f"payload {i}") for i in range(60)]
    frame = spark.createDataFrame(rows, "g string, o long, m long, payload string").repartition(5)
    found = shuffles.running_totals(frame, ["g"], ["o"], {"n": F.lit(1), "t": F.col("m")}, descending).collect()
    assert stored == [["g", "o", "_in_n", "_in_t", "_slice"]]
    assert sorted(r.n for r in found) == list(range(1, 61)) and len({r.payload for r in found}) == 60
    found.sort(key=lambda r: r.n)
    places = [(r.o is not None, r.o or 0) for r in found]
    assert places == sorted(places, reverse=descending)
    total = 0
    for r in found:
        total += r.m
        assert r.t == total


@pytest.mark.parametrize("limit", [5, 1001])
def test_retention_of_one_group_of_all_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(shuffles, "SLICE_ROWS", 50)
    rows = [("h", f"{i:04d}", 1 + i % 3, "body", i) for i in range(2000)]
    queue = spark.createDataFrame(rows, "source string, queue_key string, size long, body string, event_id long").repartition(9)
    kept = sorted(r.queue_key for r in queueing.retain(queue, limit, 1500).collect())
    sizes, expected = 0, []
    for r in reversed(rows):
        sizes += r[2]
        if len(expected) < limit and (sizes <= 1500 or not expected):
            expected.append(r[1])
    assert kept == expected[::-1]


def test_checks_report_failures_only_if_there_are_any(spark):
    frame = spark.createDataFrame(
        [("a", True, "1"), ("a", False, "2"), ("b", True, "3"), ("b", True, "4")],
        "name string, ok boolean, detail string",
    )
    found = sorted((r.name, r.ok, r.detail) for r in routes.check_details(frame).collect())
    assert found == [("a", False, "2"), ("b", True, "3"), ("b", True, "4")]


def test_envelopes_round_trip(spark):
    from tidewatch.operators.envelopes import envelope_json

    events = spark.sql(
        "SELECT concat('e', id) AS id, 's' AS source, timestamp_micros(id * 1000001) AS timestamp, "
        "timestamp_micros(id * 1000001) AS collected_at, if(id % 3 = 0, 'h0', 'h1') AS host, "
        "map('k', cast(id AS string)) AS payload FROM range(250)"
    )
    packed = pack_envelopes(events, 60)
    assert packed.filter("size(events) > 60").count() == 0
    assert packed.count() == 2 + 3
    back = unpack_envelopes(envelope_json(packed))
    assert back.select("id", "timestamp", "host").exceptAll(
        events.select("id", "timestamp", "host")
    ).count() == 0
    assert back.count() == 250


def test_both_ways_of_limiting_keep_rows_without_a_group(spark):
    rows = [(s, f"{i:03d}", 10, "x", i) for s in (None, "h") for i in range(3)]
    queue = spark.createDataFrame(rows, "source string, queue_key string, size long, body string, event_id long")
    for limit in (2, 1000, 1001):
        kept = queueing.retain(queue, limit, 10**6)
        assert kept.count() == min(limit, 3) * 2
    assert queueing.fifo(queue).count() == 6


def test_events_without_a_host_are_packed(spark):
    from tidewatch.schemas import EVENT

    events = spark.createDataFrame(
        [(f"e{i}", "s", None, None, None if i % 2 else "h", {"k": "v"}) for i in range(5)], EVENT
    )
    packed = pack_envelopes(events, 2)
    assert sorted((r.agent_id or "", len(r.events)) for r in packed.collect()) == [("", 2), ("h", 1), ("h", 2)]


def test_a_large_deny_list_meets_nested_rows(spark, monkeypatch):
    import json

    bodies = spark.createDataFrame(
        [(json.dumps({"agent_id": f"a{i}", "events": [{"id": f"e{i}", "payload": {"k": "v"}}]}),) for i in range(20)], "value string"
    )
    denied = spark.createDataFrame([(f"a{i}",) for i in range(5)], "agent_id string")
    small = sorted(r.id for r in unpack_envelopes(bodies, denied).collect())
    monkeypatch.setattr(shuffles, "BROADCAST_ROWS", 2)
    assert sorted(r.id for r in unpack_envelopes(bodies, denied).collect()) == small and len(small) == 15
    nested = bodies.selectExpr("map('k', value) AS m", "array(map(1, 2)) AS a", "substr(value, 15, 2) AS k")
    assert shuffles.lookup_join(nested.drop("k").withColumn("k", F.lit("a1")), denied.toDF("k"), ["k"], "left_anti").count() == 0


def test_nested_lookups_are_measured(spark, monkeypatch):
    wide = spark.createDataFrame([(1, ["x" * 1000] * 10)], "k int, v array<string>")
    monkeypatch.setattr(shuffles, "BROADCAST_BYTES", 5000)
    assert not shuffles.is_small(wide) and shuffles.is_small(wide.select("k"))


def test_one_number_far_off(spark):
    runs = audit.gap_runs(seqs(spark, [1, 1 << 50])).collect()
    assert [(r.start, r.stop) for r in runs] == [(2, (1 << 50) - 1)]
    row = audit.seq_audit(seqs(spark, [1, 1 << 50])).first()
    assert row.gaps == (1 << 50) - 2 and row.first_gaps == list(range(2, 12))
    assert audit.seq_gaps(seqs(spark, [1, 200_000])).count() == 199_998
    cut = audit._cut(audit._cut(audit.gap_runs(seqs(spark, [1, 1 << 50])), audit.CHUNK**3), audit.CHUNK**2)
    assert cut.limit(3).count() == 3


def test_positions_without_a_topic_are_marked(spark):
    rows = spark.createDataFrame([(None, 0, i, 5) for i in range(3)], "topic string, partition int, offset long, seq long")
    assert sorted(r.is_duplicate for r in audit.mark_duplicates(rows).collect()) == [False, True, True]


def test_idle_sources_keep_their_position(spark):
    lines = spark.createDataFrame(
        [("a", 1, 9, 50, "delivered")], "source string, seq long, file_id long, end_offset long, outcome string"
    )
    saved = spark.createDataFrame([("a", 9, 10), ("idle", 4, 30)], "source string, file_id long, offset long")
    found = {r.source: r for r in delivery.delivery_stats(lines, saved).collect()}
    assert (found["idle"].file_id, found["idle"].offset, found["idle"].in_flight, found["idle"].produced) == (4, 30, 0, 0)
    assert (found["a"].offset, found["a"].acked) == (50, 1)


def test_few_large_tasks_are_dealt_out(spark):
    from tidewatch.operators.shuffles import dealt

    rows = spark.range(0, 1000, 1, 2)
    spread = dealt(rows, ["id"], 100)
    assert spread.rdd.getNumPartitions() == 10 and spread.distinct().count() == 1000
    assert dealt(rows, ["id"], 600).rdd.getNumPartitions() == 2


def test_winners_of_a_whole_ledger_are_not_broadcast(spark, records):
    from alerts import alert

    from tidewatch.operators.normalize import classify
    from tidewatch.session import configure
    from tidewatch.sinks import ledger as lg

    configure(spark)
    stats = lg.ingest_stats(lg.dispose(classify(records([alert(1), alert(2), alert(1), "junk"]))))
    assert [tuple(r) for r in stats.collect()] == [(4, 2, 1, 1)]
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "BroadcastHashJoin" not in plan
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
