import pytest
from conftest import envelope, physical_plan, values

from pyspark.sql import functions as F
from tidemark.functions import envelope_schema, has_payload, table_of_topic
from tidemark.operators import decode_changes, split_dead_letters

EDGE_CASES = [
    # payload, kept, id, v, operation, deleted
    (None, False, None, None, None, None),
    ("", False, None, None, None, None),
    ("  \t\r\n ", False, None, None, None, None),
    ("{bad", True, None, None, "UNKNOWN", False),
    ('{"after":{"id":"1"', True, None, None, "UNKNOWN", False),
    ("null", True, None, None, "UNKNOWN", False),
    ("[]", True, None, None, "UNKNOWN", False),
    ('{"schema":{},"payload":{"after":{"id":"1"},"op":"c"}}', True, None, None, "UNKNOWN", False),
    ('{"after":{"id":1,"v":2.50},"op":"c","ts_ms":1}', True, "1", "2.5", "CREATE", False),
    ('{"after":{"id":true,"v":{"a":1}},"op":"c","ts_ms":1}', True, "true", '{"a":1}', "CREATE", False),
    (
        '{"after":{"id":1234567890123456789012,"v":1e3},"op":"c","ts_ms":1}',
        True, "1234567890123456789012", "1000.0", "CREATE", False,
    ),
    (
        '{"before":{"id":"1","v":"x"},"after":{"id":"1","v":null},"op":"u","ts_ms":2}',
        True, "1", "x", "UPDATE", False,
    ),
    ('{"before":{"id":"1","v":"x"},"after":null,"op":"d","ts_ms":3}', True, "1", "x", "DELETE", True),
    ('{"after":{"id":"1","v":"q"},"op":"c","ts_ms":"abc"}', True, "1", "q", "CREATE", False),
    ('{"after":{"id":"1","v":"q"},"op":"r","ts_ms":4}', True, "1", "q", "READ", False),
    ('{"after":{"id":"1","v":"q"},"op":"t"}', True, "1", "q", "UNKNOWN", False),
    ('{"after":"oops","op":"c","ts_ms":9}', True, None, None, "CREATE", False),
    ('{"After":{"ID":"1","V":"q"},"op":"c","ts_ms":9}', True, None, None, "CREATE", False),
]


def test_payload_edge_cases(messages):
    rows = [("t", 0, i, case[0]) for i, case in enumerate(EDGE_CASES)]
    decoded = decode_changes(messages(rows), ["id", "v"])
    got = {r.kafka_offset: r for r in decoded.collect()}
    for i, (payload, kept, key, v, operation, deleted) in enumerate(EDGE_CASES):
        assert (i in got) == kept, payload
        if kept:
            row = got[i]
            assert (row.id, row.v, row.operation_type, row.is_deleted) == (key, v, operation, deleted)


def test_bad_version_is_null_but_the_row_stays(messages):
    row = decode_changes(
        messages([("t", 3, 7, '{"after":{"id":"1"},"op":"c","ts_ms":"abc"}')]), ["id"]
    ).first()
    assert row.cdc_timestamp_ms is None
    assert (row.kafka_topic, row.kafka_partition, row.kafka_offset) == ("t", 3, 7)
    assert row.processed_at is not None


def test_payload_test_agrees_with_the_decoder(messages):
    texts = [None, "", " ", "\t\r\n", " ", "x", "{}", "0", '""', "﻿", "\f"]
    df = messages([("t", 0, i, t) for i, t in enumerate(texts)])
    decoded = F.from_json("value", envelope_schema(["id"])).isNotNull()
    both = df.select("value", decoded.alias("a"), F.coalesce(has_payload(F.col("value")), F.lit(False)).alias("b"))
    assert [r.value for r in both.collect() if r.a != r.b] == []


def test_payload_test_stops_at_the_first_character(messages):
    plan = physical_plan(decode_changes(messages([("t", 0, 0, "x")]), ["id"]))
    assert "ltrim(" in plan and " trim(" not in plan and "rtrim(" not in plan


def test_binary_payload(spark, messages):
    df = messages([("t", 0, 0, envelope("c", after={"id": "é"}))])
    binary = df.withColumn("value", F.col("value").cast("binary"))
    assert decode_changes(binary, ["id"]).first().id == "é"


def test_strict_image_keeps_an_update_to_null(messages):
    df = messages(
        [
            ("t", 0, 0, envelope("u", {"id": "1", "v": "x"}, {"id": "1", "v": None})),
            ("t", 0, 1, envelope("d", {"id": "1", "v": "x"})),
        ]
    )
    assert values(decode_changes(df, ["id", "v"], "strict"), "kafka_offset", "v") == [(0, None), (1, "x")]
    assert values(decode_changes(df, ["id", "v"]), "kafka_offset", "v") == [(0, "x"), (1, "x")]


def test_unknown_policy(messages):
    with pytest.raises(ValueError):
        decode_changes(messages([]), ["id"], "newest")


def test_dead_letters_keep_the_payload(messages):
    rows = [("t", 0, i, case[0]) for i, case in enumerate(EDGE_CASES)]
    decoded = decode_changes(messages(rows), ["id", "v"], keep_value=True)
    good, dead = split_dead_letters(decoded, ["id"])
    reasons = {r.kafka_offset: (r.reason, r.value) for r in dead.collect()}
    assert reasons[3] == ("missing_key", "{bad")
    assert reasons[15] == ("unknown_operation", EDGE_CASES[15][0])
    assert good.count() + dead.count() == sum(case[1] for case in EDGE_CASES)


def test_each_payload_is_decoded_once(spark, messages, tmp_path):
    messages([("t", 0, 0, envelope("c", after={"id": "1"}))]).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    plain = decode_changes(log, ["id", "v"])
    assert physical_plan(plain).count("from_json(") == 1
    good, _ = split_dead_letters(decode_changes(log, ["id", "v"]), ["id"])
    assert physical_plan(good).count("from_json(") == 1


def test_source_block_is_optional():
    assert "source" not in envelope_schema(["id"]).names


def test_topic_routing(messages):
    topics = ["cdc_.public.orders", "orders", "a.b", "a.b.c.d", "x.y.z"]
    df = messages([(t, 0, 0, None) for t in topics])
    routed = [r[0] for r in df.select(table_of_topic(F.col("topic"))).collect()]
    assert routed == ["orders", "orders", "a.b", "a.b.c.d", "z"]
