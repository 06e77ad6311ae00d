import pytest
from conftest import physical_plan, values

from tidemark.operators import latest_per_key

METHODS = ["window", "aggregate"]


@pytest.mark.parametrize("method", METHODS)
def test_newest_version_wins_and_null_versions_are_oldest(changes, method):
    df = changes(
        [
            ("a", "null", None, 1, False),
            ("a", "low", 5, 1, False),
            ("a", "high", 5, 2, False),
            ("b", "only", None, 9, True),
        ]
    )
    assert values(latest_per_key(df, ["id"], method=method), "id", "v", "is_deleted") == [
        ("a", "high", False),
        ("b", "only", True),
    ]


@pytest.mark.parametrize("method", METHODS)
def test_partition_settles_equal_offsets(changes, method):
    base = changes([("a", "x", 5, 1, False)])
    df = base.unionByName(base.selectExpr("id", "'y' AS v", "cdc_timestamp_ms", "kafka_offset", "is_deleted", "3 AS kafka_partition"))
    assert latest_per_key(df, ["id"], method=method).first().v == "y"


@pytest.mark.parametrize("method", METHODS)
def test_null_keys_are_one_group(changes, method):
    df = changes([(None, "x", 1, 1, False), (None, "y", 2, 2, False)])
    assert values(latest_per_key(df, ["id"], method=method), "id", "v") == [(None, "y")]


def test_methods_agree_on_a_log_with_a_hot_key(spark):
    df = spark.range(0, 30_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 500 AS STRING) END AS id",
        "CAST(id AS STRING) AS v",
        "CAST(pmod(hash(id), 40) AS BIGINT) AS cdc_timestamp_ms",
        "id AS kafka_offset",
        "0 AS kafka_partition",
    )
    window, aggregate = (values(latest_per_key(df, ["id"], method=m)) for m in METHODS)
    assert window == aggregate
    assert len(window) == 501


def test_a_key_is_reduced_before_the_shuffle(changes):
    df = changes([("a", "x", 1, 1, False)])
    plan = physical_plan(latest_per_key(df, ["id"]))
    before = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before
    plan = physical_plan(latest_per_key(df, ["id"], method="aggregate"))
    assert "partial_max_by" in plan[plan.index("Exchange") :]


def test_unknown_method(changes):
    with pytest.raises(ValueError):
        latest_per_key(changes([]), ["id"], method="sort")
