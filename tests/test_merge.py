import random

import pytest
from conftest import physical_plan, values

from tidemark.operators import latest_per_key, merge

FORMS = ["outer", "split"]
COLUMNS = ("id", "v", "cdc_timestamp_ms", "kafka_offset")


def table(changes, rows):
    return changes([(*r, False) for r in rows]).drop("is_deleted")


def model(target, source, mode, guard):
    """The same merge on dictionaries: id -> (v, ts, offset); changes add a delete flag."""
    state = dict(target)
    for key, (v, ts, offset, deleted) in source.items():
        old = state.get(key)
        if deleted and mode == "upsert":
            continue
        newer = old is not None and ts is not None and old[1] is not None and ts >= old[1]
        if old is None:
            if not deleted:
                state[key] = (v, ts, offset)
        elif deleted:
            if newer or not guard:
                del state[key]
        elif newer:
            state[key] = (v, ts, offset)
    return state


@pytest.mark.parametrize("form", FORMS)
def test_every_arm(changes, form):
    target = table(
        changes,
        [("keep", "k", 5, 1), ("newer", "o", 5, 1), ("same", "o", 5, 1), ("older", "o", 5, 1),
         ("gone", "o", 5, 1), ("stale", "o", 5, 1), ("nover", "o", None, 1)],
    )
    source = changes(
        [("newer", "n", 6, 2, False), ("same", "n", 5, 2, False), ("older", "n", 4, 2, False),
         ("gone", "n", 6, 2, True), ("stale", "n", 4, 2, True), ("nover", "n", 6, 2, False),
         ("new", "n", 1, 2, False), ("never", "n", 1, 2, True)],
    )

    def state(**options):
        return dict(values(merge(target, source, ["id"], form=form, **options), "id", "v"))

    common = {"keep": "k", "newer": "n", "same": "n", "older": "o", "nover": "o", "new": "n"}
    assert state(mode="upsert_delete") == common
    assert state(mode="upsert_delete", guard_deletes=True) == {**common, "stale": "o"}
    assert state(mode="upsert") == {**common, "gone": "o", "stale": "o"}


@pytest.mark.parametrize("form", FORMS)
def test_null_keys_match_nothing(changes, form):
    target = table(changes, [(None, "old", 1, 1)])
    source = changes([(None, "new", 2, 2, False)])
    assert values(merge(target, source, ["id"], form=form), "v") == [("new",), ("old",)]


@pytest.mark.parametrize("form", FORMS)
def test_composite_key(spark, form):
    columns = "a INT, b INT, v STRING, cdc_timestamp_ms BIGINT"
    target = spark.createDataFrame([(1, 1, "x", 1), (1, 2, "y", 1)], columns)
    source = spark.createDataFrame([(1, 2, "z", 2), (2, 1, "w", 2)], columns).selectExpr(
        "*", "false AS is_deleted"
    )
    assert values(merge(target, source, ["a", "b"], form=form), "a", "b", "v") == [
        (1, 1, "x"), (1, 2, "z"), (2, 1, "w")
    ]


def random_log(seed, n, keys=40):
    rng = random.Random(seed)
    return [
        (f"k{rng.randrange(keys)}", f"v{i}", rng.choice([None, *range(30)]), i, rng.random() < 0.3)
        for i in range(n)
    ]


def newest(rows):
    best = {}
    for key, v, ts, offset, deleted in rows:
        rank = (-1 if ts is None else ts, offset)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, (v, ts, offset, deleted))
    return {k: row for k, (_, row) in best.items()}


@pytest.mark.parametrize("mode", ["upsert", "upsert_delete"])
@pytest.mark.parametrize("guard", [False, True])
def test_random_logs_match_the_model_in_both_forms(changes, mode, guard):
    for seed in range(3):
        first, second = random_log(seed, 150), random_log(seed + 100, 80)
        base = {k: r[:3] for k, r in newest(first).items() if not r[3]}
        expected = model(base, newest(second), mode, guard)
        expected = sorted(((k, *r) for k, r in expected.items()), key=repr)
        target = latest_per_key(changes(first), ["id"]).where("NOT is_deleted").drop("is_deleted")
        source = latest_per_key(changes(second), ["id"])
        for form in FORMS:
            got = merge(target, source, ["id"], mode, guard, form)
            assert values(got, *COLUMNS) == expected


def test_a_replay_changes_nothing(changes):
    first, second = random_log(1, 100), random_log(2, 60)
    target = latest_per_key(changes(first), ["id"]).where("NOT is_deleted").drop("is_deleted")
    source = latest_per_key(changes(second), ["id"])
    once = merge(target, source, ["id"], "upsert_delete")
    assert values(merge(once, source, ["id"], "upsert_delete")) == values(once)


def test_any_cut_of_an_ordered_log_gives_the_same_state(changes):
    log = [(k, v, i, i, d) for i, (k, v, _, _, d) in enumerate(random_log(3, 120))]
    whole = latest_per_key(changes(log), ["id"]).where("NOT is_deleted")
    for cut in (1, 37, 119):
        first = latest_per_key(changes(log[:cut]), ["id"]).where("NOT is_deleted").drop("is_deleted")
        second = latest_per_key(changes(log[cut:]), ["id"])
        assert values(merge(first, second, ["id"], "upsert_delete"), *COLUMNS) == values(whole, *COLUMNS)


def test_small_changes_do_not_shuffle_the_target(spark, tmp_path):
    spark.range(100_000).selectExpr(
        "CAST(id AS STRING) AS id", "'v' AS v", "1L AS cdc_timestamp_ms"
    ).write.parquet(str(tmp_path / "target"))
    spark.range(10).selectExpr(
        "CAST(id AS STRING) AS id", "'w' AS v", "2L AS cdc_timestamp_ms", "id = 3 AS is_deleted"
    ).write.parquet(str(tmp_path / "source"))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "source"))
    applied = merge(target, source, ["id"], "upsert_delete", form="split")
    plan = physical_plan(applied)
    joined = plan[: plan.index("LeftAnti")]
    assert "BroadcastHashJoin" in joined and "LeftOuter" in joined
    assert "SortMergeJoin" not in joined
    assert applied.count() == 99_999


def test_wrong_options(changes):
    target, source = table(changes, []), changes([])
    with pytest.raises(ValueError):
        merge(target, source, ["id"], mode="replace")
    with pytest.raises(ValueError):
        merge(target, source, ["id"], form="loop")
