"""The source database's constraints as Spark checks, and its generated key.

Checks report ``(table_name, rule, column_name, violations)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions.keys import any_null
from tidemark.functions.typed import silver_type, typed
from tidemark.model import TableSpec


def row_violations(df: DataFrame, spec: TableSpec, typed_input: bool = False) -> DataFrame:
    """All rules that look at one row, in one pass over the table.

    NOT NULL, VARCHAR length, "text fits its type" and CHECK. A NULL passes every rule but
    NOT NULL. ``typed_input`` says that the columns already have their types, not bronze text.
    """
    rules: list[tuple[str, str, Column]] = []
    for f in spec.schema.fields:
        value = F.col(f.name)
        if not f.nullable:
            rules.append(("not_null", f.name, value.isNull()))
        if isinstance(f.dataType, (T.VarcharType, T.CharType)):
            rules.append(("length", f.name, F.length(value.cast("string")) > f.dataType.length))
        elif not typed_input and not isinstance(f.dataType, T.StringType):
            fits = typed(value, f.dataType)
            rules.append(("type", f.name, value.isNotNull() & fits.isNull()))
    for name, passes in spec.checks.items():
        value = F.col(name) if typed_input else typed(F.col(name), silver_type(spec, name))
        rules.append(("check", name, ~passes(value)))
    return _report(df, spec.name, rules)


def _report(df: DataFrame, table: str, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    counted = df.agg(
        *[F.count_if(violated).alias(f"r{i}") for i, (_, _, violated) in enumerate(rules)]
    )
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule).alias("rule"),
            F.lit(column).alias("column_name"),
            F.col(f"r{i}").alias("violations"),
        )
        for i, (rule, column, _) in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*lines)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Counting starts before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def key_violations(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """PRIMARY KEY: surplus copies of a key, and rows whose key is NULL."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    counted = groups.agg(
        F.coalesce(F.sum(F.when(any_null(keys), F.col("copies"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.when(~any_null(keys), F.col("copies") - 1)), F.lit(0)).alias("surplus"),
    )
    column = F.lit(",".join(keys))
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(rule).alias("rule"),
                        column.alias("column_name"),
                        F.col(source).alias("violations"),
                    )
                    for rule, source in (("key_not_null", "nulls"), ("key_unique", "surplus"))
                ]
            )
        )
    )


def orphans(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]
) -> DataFrame:
    """Foreign key values without a parent row, with the number of child rows that use them.

    The child is counted per value first, so a value that a third of its rows share reaches
    the join as one row. A NULL in the key passes, as it does in a database.
    """
    used = (
        child.where(~any_null(columns))
        .groupBy(*columns)
        .agg(F.count("*").alias("child_rows"))
    )
    known = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_columns)])
    return used.join(known, list(columns), "left_anti")


def reference_violations(tables: Mapping[str, DataFrame], specs: Iterable[TableSpec]) -> DataFrame:
    """FOREIGN KEY: rows without a parent, for every reference of the given specs.

    A table that a reference needs and that is not given raises: a check that cannot run must
    not look like one that passed.
    """
    reports = []
    for spec in specs:
        for ref in spec.references:
            absent = {spec.name, ref.parent} - set(tables)
            if absent:
                raise ValueError(f"{spec.name} refers to {ref.parent}: {sorted(absent)} not given")
            missing = orphans(
                tables[spec.name], ref.columns, tables[ref.parent], ref.parent_columns
            )
            reports.append(
                missing.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("violations")).select(
                    F.lit(spec.name).alias("table_name"),
                    F.lit(f"reference_{ref.parent}").alias("rule"),
                    F.lit(",".join(ref.columns)).alias("column_name"),
                    "violations",
                )
            )
    return reduce(DataFrame.unionByName, reports)


def reference_deltas(
    tables: Mapping[str, DataFrame],
    changed: Mapping[str, DataFrame],
    deleted: Mapping[str, DataFrame],
    specs: Iterable[TableSpec],
) -> DataFrame:
    """FOREIGN KEY violations that one slice of changes brought about, without a pass over all children.

    ``tables`` are the contents after the slice, ``changed`` the rows it inserted or updated, and
    ``deleted`` the rows it removed; a table may be absent from the last two. Reports
    ``(table_name, rule, column_name, cause, violations)`` for every reference that the slice could break:

    * ``changed``: new or updated children whose parent is not there;
    * ``deleted``: other children, unchanged by the slice, that point at a parent which the slice removed.

    The slice's keys are counted or made distinct first and are the small side of each join. If all
    references held before the slice, none of the others is broken after it.
    """
    reports = []
    for spec in specs:
        for ref in spec.references:
            absent = {spec.name, ref.parent} - set(tables)
            if absent:
                raise ValueError(f"{spec.name} refers to {ref.parent}: {sorted(absent)} not given")
            found = []
            if spec.name in changed:
                new = changed[spec.name]
                missing = orphans(new, ref.columns, tables[ref.parent], ref.parent_columns)
                found.append(("changed", missing.select("child_rows")))
            if ref.parent in deleted:
                gone = deleted[ref.parent].select(*[F.col(p).alias(c) for c, p in zip(ref.columns, ref.parent_columns)])
                # A parent that was deleted and came back is there.
                back = tables[ref.parent].select(*[F.col(p).alias(c) for c, p in zip(ref.columns, ref.parent_columns)])
                gone = gone.distinct().join(back, list(ref.columns), "left_anti")
                left = tables[spec.name].join(gone, list(ref.columns), "left_semi")
                if spec.name in changed:
                    left = left.join(changed[spec.name].select(*spec.keys), list(spec.keys), "left_anti")
                found.append(("deleted", left.select(F.lit(1).alias("child_rows"))))
            for cause, rows in found:
                reports.append(
                    rows.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("violations")).select(
                        F.lit(spec.name).alias("table_name"),
                        F.lit(f"reference_{ref.parent}").alias("rule"),
                        F.lit(",".join(ref.columns)).alias("column_name"),
                        F.lit(cause).alias("cause"),
                        "violations",
                    )
                )
    if not reports:
        raise ValueError("the slice has neither changed children nor deleted parents of any reference")
    return reduce(DataFrame.unionByName, reports)


def surrogate_key(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Number the rows of a landed Parquet table 1, 2, 3 … in load order.

    Load order is file name, then position in the file, which the reader reports. The number
    is the file's start plus that position, and a re-run over the same files gives the same
    numbers. Only one count per file is gathered, and broadcast: Catalyst would judge it by the size of
    the table and bring the rows of a file together in one task.
    """
    landed = spark.read.parquet(path)
    rows = landed.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    per_file = (
        landed.select(F.col("_metadata.file_path").alias("_file"))
        .groupBy("_file")
        .agg(F.count("*").alias("_rows"))
    )
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_file.select(
        "_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    numbered = rows.join(F.broadcast(starts), "_file")
    return numbered.select((F.col("_start") + F.col("_row") + 1).alias(name), *landed.columns)
