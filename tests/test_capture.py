import pytest
from conftest import physical_plan, values
from pyspark.sql import functions as F

from tidemark.functions import micros_of, millis_of, moment_of
from tidemark.operators import decode_changes, diff_events, snapshot_events
from tidemark.plans.silver import silver
from tidemark.model import TableSpec

SPEC = TableSpec("items", ("id",), "id INT NOT NULL, name STRING, price DECIMAL(10,2), at TIMESTAMP_NTZ")


def items(spark, rows):
    df = spark.createDataFrame(rows, "id INT, name STRING, price STRING, at STRING")
    return df.selectExpr("id", "name", "CAST(price AS DECIMAL(10,2)) price", "CAST(at AS TIMESTAMP_NTZ) at")


ROWS = [
    (1, "a", "2.50", "2017-10-02 08:40:00.123456"),
    (2, None, None, None),
    (3, 'quote " and \n line', "0.01", "1969-12-31 23:59:59.999999"),
]


def test_snapshot_survives_the_envelope(spark):
    df = items(spark, ROWS)
    events = snapshot_events(df, SPEC.keys, "items", ts_ms=F.lit(7))
    decoded = decode_changes(events, SPEC.columns)
    assert {r.operation_type for r in decoded.collect()} == {"READ"}
    assert values(silver(decoded, SPEC).select(*SPEC.columns)) == values(df)


def test_difference_replays_to_the_new_table(spark):
    old = items(spark, ROWS)
    new = items(spark, [(1, None, "2.50", ROWS[0][3]), ROWS[1], (4, "n", "1", None)])
    events = diff_events(old, new, SPEC.keys, "items", ts_ms=F.lit(8))
    decoded = decode_changes(events, SPEC.columns, "strict")
    assert values(decoded, "id", "operation_type", "name") == [
        ("1", "UPDATE", None), ("3", "DELETE", ROWS[2][1]), ("4", "CREATE", "n")
    ]
    assert values(decode_changes(events, SPEC.columns), "id", "name")[0] == ("1", "a")


def test_moments_do_not_depend_on_the_session_zone(spark):
    df = items(spark, ROWS).where("at IS NOT NULL")
    got = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got.append(values(df.select(micros_of(F.col("at")), millis_of(F.col("at")), moment_of(micros_of(F.col("at"))) == F.col("at"))))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == got[1] == [(-1, -1, True), (1506933600123456, 1506933600123, True)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Australia/Lord_Howe"])
def test_moments_in_whole_numbers(spark, zone):
    """Exact in any zone, also where its clocks jump and before 1970; no decimal is made on the way."""
    spring = 1_583_636_400_000_000  # 2020-03-08 03:00, half an hour into what New York skips below
    micros = [None, 0, 1, -1, 999_999, -999_999, -1_000_000, -1_500_000, spring - 1_800_000_001, -2_208_988_800_000_001]
    rows = spark.createDataFrame([(m,) for m in micros], "u BIGINT").withColumn("m", moment_of(F.col("u")))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        numbers = rows.select("u", micros_of(F.col("m")).alias("micros"), millis_of(F.col("m")).alias("millis"))
        assert "secondwithfraction" not in physical_plan(numbers)
        got = numbers.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in got] == [(m, m, None if m is None else m // 1000) for m in micros]
