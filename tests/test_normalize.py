from datetime import datetime

from alerts import alert

from tidewatch.functions.json_text import is_json
from tidewatch.functions.labels import severity_tag, stable_uuid
from tidewatch.functions.times import zoned_timestamp
from tidewatch.operators.normalize import check_lines, classify, normalize_alerts
from pyspark.sql import functions as F


def one(records, value):
    return classify(records([value])).first()


def test_full_alert(records):
    row = one(records, alert(1))
    assert row.reject_reason is None
    assert (row.manager, row.alert_id) == ("north", "id-1")
    assert row.ts == datetime(2025, 3, 4, 5, 6, 7, 123000)
    assert (row.rule_id, row.rule_level, row.rule_groups) == ("601", 1, ["all", "p1"])
    assert (row.mitre_ids, row.mitre_tactics) == (["X1"], ["Aim p1"])
    assert (row.agent_id, row.agent_name, row.agent_ip) == ("p1", "node-p1", "192.0.2.77")
    assert (row.decoder, row.location) == ("decoder-p1", "/data/p1.log")
    assert (row.src_ip, row.src_user) == ("203.0.113.1", "user-p1")
    assert (row.source_topic, row.source_partition, row.source_offset) == ("alerts", 0, 0)
    assert row.raw == alert(1)


def test_sparse_alert_lands_with_empty_arrays(records):
    row = one(records, '{"id":"9.9","timestamp":"2025-03-04T05:06:07.1+0000"}')
    assert row.reject_reason is None
    assert (row.manager, row.rule_level, row.rule_groups, row.mitre_ids) == ("", None, [], [])


def test_missing_id_becomes_the_hash_of_the_bytes(records):
    rows = classify(records(['{"rule":{"level":3}}'] * 2)).collect()
    assert {row.alert_id for row in rows} == {
        "sha256:a1e3a63503b896e7fc059c5532ce2cf0bb207e12e0c4ff0780f1cfccf78a33f1"
    }


REJECTED = [
    (None, "null_value"),
    (b"\xff\xfe", "invalid_utf8"),
    ("not json", "not_json"),
    ("", "not_json"),
    ('{"a":1} x', "not_json"),
    ('{"a":1},{"a":2}', "not_json"),
    ('{"a":NaN}', "not_json"),
    ('{"id":"1"}]', "not_json"),
    ('{"id":"1"}] junk', "not_json"),
    ('{"id":"2"}],[7', "not_json"),
    ('{"id":"2"},0] junk', "not_json"),
    ('7] x', "not_json"),
    ('{"id":"1"},{"_seal":"x"}', "not_json"),
    ("{'a':1}", "not_json"),
    ('{"a":01}', "not_json"),
    ('{"a":"\x01"}', "not_json"),
    ('{"a":' + "[" * 3000 + "]" * 3000 + "}", "not_json"),
    ("[1,2]", "not_object"),
    ("7", "not_object"),
    ("null", "not_object"),
    ('"text"', "not_object"),
    ('{"id":"1","rule":{"description":"x \\ud800 y"}}', "unencodable"),
    ('{"id":"1","rule":{"description":"x \\udc00 y"}}', "unencodable"),
]


def test_rejects_name_their_reason_and_position(records):
    values = [value for value, _ in REJECTED]
    alerts, rejects = normalize_alerts(records([alert(1), *values, alert(2)]))
    assert alerts.count() == 2
    found = {row.source_offset: row.reject_reason for row in rejects.collect()}
    assert found == {i + 1: reason for i, (_, reason) in enumerate(REJECTED)}


def test_surrogate_pairs_and_escaped_backslashes_are_kept(records):
    for text in ('{"id":"1","x":"\\ud83d\\ude00"}', '{"id":"1","x":"\\\\ud800"}'):
        assert one(records, text).reject_reason is None


LEVELS = [("7", 7), ('"7"', 7), ('" 7 "', 7), ('"1_0"', 10), ("7.9", 7), ("true", 1), ("false", 0),
     ('"7.9"', None), ('"high"', None), ("99999", None), ("-1", None), ("-0.5", 0), ("1e999", None),
     ("null", None), ("[7]", None), ('"true"', None), ("32767", 32767), ("12e0", 12), ('"+7"', 7)]


def test_level(records):
    values = ['{"id":"1","rule":{"level":%s}}' % value for value, _ in LEVELS]
    rows = classify(records(values)).orderBy("source_offset").collect()
    assert [row.rule_level for row in rows] == [expected for _, expected in LEVELS]


SCALARS = [('"a"', "a"), ("5", "5"), ("5.0", "5.0"), ("1.50", "1.5"), ('"1.50"', "1.50"), ("true", "True"),
     ('"true"', "true"), ('"[1]"', "[1]"), ("12345678901234567890123", "12345678901234567890123"),
     ('"1741064767.10"', "1741064767.10"), ('"a\\nb"', "a\nb"), ("-0", "0")]


def test_scalars_keep_their_spelling(records):
    values = ['{"id":%s}' % value for value, _ in SCALARS]
    rows = classify(records(values)).orderBy("source_offset").collect()
    assert [row.alert_id for row in rows] == [expected for _, expected in SCALARS]


def test_no_scalar_counts_as_missing(records):
    values = ['{"id":"1","location":%s}' % value for value in ("null", "[1]", '{"k":1}')]
    assert [row.location for row in classify(records(values)).collect()] == [None] * 3


LISTS = [('"x"', ["x"]), ('["x","y"]', ["x", "y"]), ('["x",null,["z"],{"k":1},2,true,1.0]', ["x", "2", "True", "1.0"]),
     ("7", []), ("null", []), ('{"k":1}', []), ("[]", []), ('["[1]"]', ["[1]"]), ('["null"]', ["null"])]


def test_lists(records):
    values = ['{"id":"1","rule":{"mitre":{"id":%s}}}' % value for value, _ in LISTS]
    rows = classify(records(values)).orderBy("source_offset").collect()
    assert [row.mitre_ids for row in rows] == [expected for _, expected in LISTS]


def test_nested_values_of_the_wrong_type_leave_the_rest_alone(records):
    row = one(records, '{"id":"1","agent":"x","rule":{"id":"5","mitre":7},"data":[1],"manager":null}')
    assert (row.alert_id, row.agent_name, row.rule_id, row.mitre_ids, row.manager) == ("1", None, "5", [], "")


def test_last_duplicate_key_wins(records):
    row = one(records, '{"id":"1","id":"2","rule":{"id":"a"},"rule":{"level":3}}')
    assert (row.alert_id, row.rule_id, row.rule_level) == ("2", None, 3)


def test_nul_is_replaced_but_not_as_literal_text(records):
    assert one(records, '{"id":"a\\u0000b"}').alert_id == "a�b"
    assert one(records, '{"id":"a\\\\u0000b"}').alert_id == "a\\u0000b"
    assert one(records, '{"id":"\\\\\\u0000"}').alert_id == "\\�"


def test_byte_order_mark_is_ignored(records):
    assert one(records, b'\xef\xbb\xbf{"id":"1"}').alert_id == "1"


TIMES = [("2025-03-04T05:06:07.123+0000", datetime(2025, 3, 4, 5, 6, 7, 123000)),
     ("2025-03-04T05:06:07+0000", datetime(2025, 3, 4, 5, 6, 7)),
     ("2025-03-04T05:06:07Z", datetime(2025, 3, 4, 5, 6, 7)),
     ("2025-03-04T05:06+02:00", datetime(2025, 3, 4, 3, 6)),
     ("2025-03-04 05:06:07,5-0130", datetime(2025, 3, 4, 6, 36, 7, 500000)),
     ("2025-03-04T05:06:07", None), ("2025-03-04", None), ("yesterday", None),
     ("2025-13-04T05:06:07Z", None), ("1741064767", None), ("", None)]


def test_times_need_a_zone(spark):
    frame = spark.createDataFrame([(text,) for text, _ in TIMES], "t string").coalesce(1)
    found = frame.select(zoned_timestamp(F.col("t")).alias("t")).collect()
    assert [row.t for row in found] == [expected for _, expected in TIMES]


def test_line_checks(records):
    lines = records(["", "  \t", '{"a":1}', "[1]", "{oops", b"\xff", "7"])
    rows = check_lines(lines).orderBy("offset").collect()
    assert [row.status for row in rows] == [
        "blank", "blank", "valid", "valid", "malformed", "malformed", "valid"
    ]
    assert rows[4].preview == "{oops"


def test_small_functions(spark):
    row = spark.range(1).select(
        *[severity_tag(F.lit(n)).alias(f"t{n}") for n in (0, 4, 5, 8, 12, 16, 17)],
        severity_tag(F.lit(None).cast("int")).alias("none"),
        stable_uuid(F.lit("a")).alias("a"),
        stable_uuid(F.lit("b")).alias("b"),
        is_json(F.lit('{"a":1} x')).alias("tail"),
        is_json(F.lit(" [1] ")).alias("list"),
    ).first()
    assert list(row[:8]) == ["low", "low", "med", "HIGH", "CRIT", "CRIT", "?", "?"]
    import re

    form = r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}"
    assert re.fullmatch(form, row.a) and re.fullmatch(form, row.b) and row.a != row.b
    assert (row.tail, row.list) == (False, True)
