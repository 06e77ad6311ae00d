"""Apply the latest change of each key to the current state of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.keys import all_equal
from tidemark.operators.latest import VERSION

MODES = ("upsert", "upsert_delete")
FORMS = ("outer", "split")


def merge(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    mode: str = "upsert",
    guard_deletes: bool = False,
    form: str = "outer",
) -> DataFrame:
    """The table after the changes, as a plain DataFrame with the columns of ``target``.

    ``changes`` has at most one row per key (``latest_per_key``) and carries ``is_deleted``.

    * a matched row is replaced if the change is at least as new; a replay changes nothing;
    * an unmatched change is inserted; a NULL key matches nothing;
    * ``upsert`` ignores deletes; ``upsert_delete`` removes the matched row, whatever its
      version, or only if the delete is at least as new when ``guard_deletes`` is set.

    ``outer`` shuffles both sides once and fits changes of any size. ``split`` reads the
    target twice, the second time only its keys, and joins from the target's side: while the
    changes are small enough for Catalyst to broadcast, no row of the target is shuffled.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    if form not in FORMS:
        raise ValueError(f"form {form!r} is not one of {FORMS}")
    if mode == "upsert":
        changes = changes.where(~F.col("is_deleted"))
    columns = target.columns
    old = target.withColumn("_there", F.lit(True)).alias("old")
    new = changes.withColumn("_there", F.lit(True)).alias("new")
    same_key = all_equal(keys, "old", "new")

    if form == "outer":
        return _resolve(old.join(new, same_key, "full_outer"), columns, guard_deletes)

    applied = _resolve(old.join(new, same_key, "left_outer"), columns, guard_deletes)
    key_names = list(keys)
    touched = target.select(key_names).join(changes.select(key_names), key_names, "left_semi")
    inserted = (
        changes.where(~F.col("is_deleted")).join(touched, key_names, "left_anti").select(columns)
    )
    return applied.unionByName(inserted)


def _resolve(pairs: DataFrame, columns: Sequence[str], guard_deletes: bool) -> DataFrame:
    """Choose between the old and the new side of each pair, and drop what is deleted."""
    no_old, no_new = F.col("old._there").isNull(), F.col("new._there").isNull()
    newer = F.coalesce(
        F.col("new.cdc_timestamp_ms") >= F.col("old.cdc_timestamp_ms"), F.lit(False)
    )
    deleted = F.coalesce(F.col("new.is_deleted"), F.lit(False))
    removed = deleted & (no_old | (newer if guard_deletes else F.lit(True)))
    replaced = no_old | (~no_new & ~deleted & newer)

    def pick(column: str) -> Column:
        return F.when(replaced, F.col(f"new.{column}")).otherwise(F.col(f"old.{column}"))

    return pairs.where(~removed).select(*[pick(c).alias(c) for c in columns])


def merge_keeping_deletes(
    state: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    forget_before_ms: Column | int | None = None,
    version: Sequence[str] = VERSION,
) -> DataFrame:
    """The state after the changes, with a row for deleted keys, too (``is_deleted``).

    Of a key's row and its change the newer version stays, whatever either is; the row stays if
    they are equal, and a NULL version is the oldest. A deleted key so keeps its version, and an
    older change that comes again neither brings the row back nor deletes a newer one.

    ``forget_before_ms`` ends that for deletes with an older ``cdc_timestamp_ms``: their rows go,
    and with them the memory of the key. A delete that is older than that on arrival still
    removes the row. ``changes`` has one row per key at most; a NULL key matches nothing.
    Both sides are shuffled once, on the key.
    """
    columns = state.columns
    old = state.withColumn("_there", F.lit(True)).alias("old")
    new = changes.select(columns).withColumn("_there", F.lit(True)).alias("new")
    pairs = old.join(new, all_equal(keys, "old", "new"), "full_outer")
    # Structs compare field by field, and NULL sorts first.
    at = {side: F.struct(*[F.col(f"{side}.{v}") for v in version]) for side in ("old", "new")}
    replaced = F.col("old._there").isNull() | (F.col("new._there").isNotNull() & (at["new"] > at["old"]))
    kept = pairs.select(*[F.when(replaced, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in columns])
    if forget_before_ms is None:
        return kept
    limit = F.lit(forget_before_ms) if isinstance(forget_before_ms, int) else forget_before_ms
    old_delete = F.col("is_deleted") & (F.coalesce("cdc_timestamp_ms", F.lit(0)) < limit)
    return kept.where(~old_delete)


def live(state: DataFrame) -> DataFrame:
    """The rows that are there: without deleted keys and without the flag."""
    return state.where(~F.col("is_deleted")).drop("is_deleted")
