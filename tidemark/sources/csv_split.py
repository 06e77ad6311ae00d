"""Large CSV files whose quoted fields hold line breaks, read by many tasks.

A task that starts in the middle of a file cannot see whether a line break there is inside quotes. The
number of quote characters before it tells: it is odd inside and even outside, doubled quotes included.
So the file is read twice, in blocks as Spark splits it:

1. Each block is reduced to one row: how many quote characters it has, its first line with an odd number
   of them, its first and last line that is not blank. Sums over the blocks before it tell whether a block
   starts inside a record, and in which earlier block that record began, its home.
2. Lines go to their home: those up to the first odd line of a block that starts inside a record go to
   that record's home, all others stay with their block. There, a record starts at every line that has an
   even number of quote characters before it.

One shuffle of the lines, by home, and none of them is a whole file. The row per block is written to the
shared folder, so that Catalyst knows its size when it chooses the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.session import new_folder


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the start of their block, and ``at``, which rises within a block."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _spoken(line: Column) -> Column:
    """Whether a line has anything but its line break, which is ``\\r\\n`` or ``\\n``."""
    return (line != "") & (line != "\r")


def block_homes(lines: DataFrame) -> DataFrame:
    """One row per block of a file: ``inside`` a record at its start or not, the last line of that record
    here (``until``, null where it goes on), the block where it began (``home``), and ``head``, the
    block in which the file's first record begins.
    """
    odd, spoken = F.col("quotes") % 2 == 1, _spoken(F.col("line"))
    blocks = (
        lines.withColumn("quotes", _quotes(F.col("line")))
        .groupBy("file", "block")
        .agg(
            F.sum("quotes").alias("quotes"),
            F.min(F.when(odd, F.col("at"))).alias("first_odd"),
            F.count_if(spoken).alias("spoken"),
            F.max(F.when(spoken, F.col("at"))).alias("last_spoken"),
        )
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    file = Window.partitionBy("file")
    inside = F.coalesce(F.sum("quotes").over(before) % 2 == 1, F.lit(False))
    # Inside a record, another one starts here only if that one ends and something follows.
    opens = F.when(F.col("inside"), F.coalesce(F.col("last_spoken") > F.col("first_odd"), F.lit(False))).otherwise(F.col("spoken") > 0)
    return (
        blocks.withColumn("inside", inside)
        .withColumn("opens", opens)
        .select(
            "file",
            "block",
            "inside",
            F.col("first_odd").alias("until"),
            F.last(F.when(F.col("opens"), F.col("block")), ignorenulls=True).over(before).alias("home"),
            F.min(F.when(F.col("opens"), F.col("block"))).over(file).alias("head"),
        )
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the CSV files at ``path``: ``file``, ``is_header`` (the file's first one) and ``record``.

    Line breaks inside quotes are kept as they are; blank lines between records are left out. Quote
    characters must stand around a field or doubled inside one, as RFC 4180 has it.
    """
    lines = _lines(spark, path)
    folder = new_folder(spark, "csv-blocks")
    block_homes(lines).write.parquet(folder)
    homes = spark.read.parquet(folder)
    carried = F.col("inside") & F.coalesce(F.col("at") <= F.col("until"), F.lit(True))
    placed = lines.join(homes, ["file", "block"]).select(
        "file", "at", "line", F.when(carried, F.col("home")).otherwise(F.col("block")).alias("home"),
        F.col("block"), F.col("head"),
    )
    order = Window.partitionBy("file", "home").orderBy("block", "at")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    between = F.coalesce(F.sum(_quotes(F.col("line"))).over(earlier), F.lit(0)) % 2 == 0
    starts = F.col("between") & _spoken(F.col("line"))
    pieces = placed.withColumn("between", between).where(~F.col("between") | _spoken(F.col("line")))
    numbered = pieces.withColumn("number", F.count_if(starts).over(so_far))
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "line")))
    text = F.array_join(F.transform(parts, lambda p: p["line"]), "\n")
    return (
        numbered.groupBy("file", "home", "number")
        .agg(text.alias("text"), F.first("head").alias("head"))
        .select(
            "file",
            ((F.col("number") == 1) & (F.col("home") == F.col("head"))).alias("is_header"),
            F.regexp_replace("text", "\r$", "").alias("record"),
        )
    )


def read_csv_records(spark: SparkSession, path: str, header: Sequence[str], options: dict[str, str]) -> DataFrame:
    """The rows of CSV files that all begin with ``header``, as text columns; the read fails on any other file."""
    # Generated names keep odd header names out of the schema string.
    names = [f"c{k}" for k in range(len(header))]
    fields = F.from_csv("record", ", ".join(f"{n} STRING" for n in names), {**options, "mode": "FAILFAST"})
    rows = csv_records(spark, path).select("file", "is_header", fields.alias("f"))
    expected = F.array(*map(F.lit, header))
    same = F.array(*(F.col(f"f.{n}") for n in names)) == expected
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
    data = rows.where(F.when(F.col("is_header"), F.when(same, F.lit(False)).otherwise(wrong)).otherwise(F.lit(True)))
    return data.select(*(F.col(f"f.{n}").alias(h) for n, h in zip(names, header, strict=True)))
