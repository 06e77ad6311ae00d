"""The registered queries, each with the SQL that must give the same rows.

A query takes the session and the folder of the driver's tables and reads those tables whole.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import operators as op
from tidemark.operators.decode import dead_letter_reason
from tidemark.operators.offsets import document_positions, offsets_map
from tidemark.plans import oracles, samples
from tidemark.plans.gold import images, maintain_windows, totals_by_window, window_changes, window_totals
from tidemark.plans.jobs import Bronze, apply_messages, dead_letters, run_full, run_incremental, run_tables
from tidemark.plans.seeds import SEEDS, load_seeds
from tidemark.plans.silver import silver, silver_rejects
from tidemark.model import TABLES, TableSpec
from tidemark.session import new_folder
from tidemark.sources import files
from tidemark.sources.catalog import publish, register
from tidemark.sources.csv import load_csv
from tidemark.sources.message_log import MessageLog
from tidemark.sources.offset_log import newest_per_topic
from tidemark.sources.state_table import StateTable
from tidemark.streaming import apply_micro_batch, latest_rows, start_changes, start_latest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            ORACLES[query.__name__] = sql
        return query

    return add


# -- decode ------------------------------------------------------------------------------


def _users(spark: SparkSession, sf_dir: str, policy: str = "coalesce", **messages) -> DataFrame:
    return op.decode_changes(
        samples.event_messages(spark, sf_dir, **messages), samples.USERS.columns, policy
    )


def _user_rows(changes: DataFrame, *more: str) -> DataFrame:
    return changes.select(
        "user_id",
        "event_type",
        F.col("value").try_cast("double").alias("value"),
        "operation_type",
        F.col("cdc_timestamp_ms").alias("ts_ms"),
        F.col("kafka_partition").alias("p"),
        F.col("kafka_offset").alias("o"),
        *more,
    )


@_query(f"WITH {oracles.users_log()} SELECT {oracles.COLUMNS}, op, is_deleted, 'events' AS topic FROM log")
def cdc_parse_decode(spark, sf_dir):
    changes = _users(spark, sf_dir)
    return _user_rows(
        changes, F.col("cdc_operation").alias("op"), "is_deleted", F.col("kafka_topic").alias("topic")
    )


@_query(f"WITH {oracles.users_log('strict')} SELECT {oracles.COLUMNS}, is_deleted FROM log")
def cdc_parse_strict_image(spark, sf_dir):
    return _user_rows(_users(spark, sf_dir, "strict"), "is_deleted")


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log with some payloads replaced by the kinds of damage seen in practice."""
    payload = F.col("payload")
    kind = F.col("offset") % 17
    value = (
        F.when(kind == 0, F.substring(payload, 1, 30))
        .when(kind == 1, "null")
        .when(kind == 2, "[]")
        .when(kind == 3, F.concat(F.lit('{"schema":{},"payload":'), payload, F.lit("}")))
        .when(kind == 4, F.lit(None).cast("string"))
        .when(kind == 5, "  \t")
        .when(kind == 6, F.regexp_replace(payload, '"op":"."', '"op":"t"'))
        .otherwise(payload)
    )
    return samples.event_messages(spark, sf_dir, value=value)


_DAMAGE_SQL = """WITH messages AS (SELECT *, event_id % 17 AS kind FROM events),
changes AS (
  SELECT CAST(user_id % 4 AS INTEGER) AS p, event_id AS o,
         CASE WHEN kind < 4 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN kind < 4 THEN 'missing_key' WHEN kind = 6 THEN 'unknown_operation'
              ELSE 'applied' END AS outcome
  FROM messages WHERE kind NOT IN (4, 5))
"""


@_query(_DAMAGE_SQL + "SELECT p, o, user_id, outcome FROM changes")
def cdc_malformed_quarantine(spark, sf_dir):
    changes = op.decode_changes(_damaged(spark, sf_dir), samples.USERS.columns)
    return changes.select(
        F.col("kafka_partition").alias("p"),
        F.col("kafka_offset").alias("o"),
        "user_id",
        F.coalesce(dead_letter_reason(samples.USERS.keys), F.lit("applied")).alias("outcome"),
    )


@_query(
    _DAMAGE_SQL
    + """SELECT outcome AS reason, p, count(*) AS n, max(o) AS last_offset
         FROM changes WHERE outcome <> 'applied' GROUP BY ALL"""
)
def cdc_dead_letters(spark, sf_dir):
    changes = op.decode_changes(
        _damaged(spark, sf_dir), samples.USERS.columns, keep_value=True
    )
    _, dead = op.split_dead_letters(changes, samples.USERS.keys)
    return dead.groupBy("reason", F.col("kafka_partition").alias("p")).agg(
        F.count("*").alias("n"), F.max("kafka_offset").alias("last_offset")
    )


@_query(_DAMAGE_SQL + "SELECT p, o, outcome AS reason FROM changes WHERE outcome <> 'applied'")
def dead_letters_two_runs(spark, sf_dir):
    """Two runs and a reset over a log with damaged payloads: every bad message once."""
    root = new_folder(spark, "dead-letters")
    log = MessageLog(files.join(root, "log"))
    bronze = Bronze(files.join(root, "bronze"), dead_letters=files.join(root, "dead"))
    messages = _damaged(spark, sf_dir)
    for part in ("first_run", "NOT first_run"):
        log.write(messages.where(part))
        _expect_success(run_incremental(spark, samples.USERS, log, bronze))
    _expect_success(run_incremental(spark, samples.USERS, log, bronze, reset=True))
    dead = dead_letters(spark, bronze.dead_letters)
    return dead.select(F.col("kafka_partition").alias("p"), F.col("kafka_offset").alias("o"), "reason")


# -- latest version per key ----------------------------------------------------------------


_LATEST_LIVE = f"""WITH {oracles.users_log()}
SELECT {oracles.COLUMNS} FROM {oracles.latest('log')} WHERE NOT is_deleted"""


@_query(_LATEST_LIVE)
def cdc_dedup_latest(spark, sf_dir):
    newest = op.latest_per_key(_users(spark, sf_dir), samples.USERS.keys)
    return _user_rows(newest.where(~F.col("is_deleted")))


@_query(_LATEST_LIVE)
def cdc_dedup_max_by(spark, sf_dir):
    newest = op.latest_per_key(_users(spark, sf_dir), samples.USERS.keys, method="aggregate")
    return _user_rows(newest.where(~F.col("is_deleted")))


@_query(f"WITH {oracles.users_log()} SELECT {oracles.COLUMNS}, is_deleted FROM {oracles.latest('log')}")
def cdc_dedup_keep_deletes(spark, sf_dir):
    return _user_rows(op.latest_per_key(_users(spark, sf_dir), samples.USERS.keys), "is_deleted")


_LINE = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


def _whole_rows(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Every column of a table, typed; decimals as the doubles that the given tables have."""
    typed = silver(rows, spec)
    amount = lambda c: F.col(c).cast("double").alias(c)
    decimals = {f.name for f in spec.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return typed.select(*(amount(c) if c in decimals else c for c in spec.columns))


def _line_rows(rows: DataFrame) -> DataFrame:
    return _whole_rows(rows, samples.LINEITEM)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.decode_changes(samples.lineitem_messages(spark, sf_dir), samples.LINEITEM.columns)


@_query("SELECT user_id, count(*) AS changes, TRUE AS stamped, CAST(1 AS BIGINT) AS stamps FROM events GROUP BY user_id")
def cdc_processed_at(spark, sf_dir):
    """All changes of one reading have one processing time, that of the reading."""
    began = datetime.datetime.now()
    at = F.col("processed_at")
    fresh = F.bool_and((at >= F.lit(began)) & (at <= F.now())).alias("stamped")
    changes = _users(spark, sf_dir).groupBy(F.col("user_id").cast("bigint").alias("user_id"))
    return changes.agg(F.count(F.lit(1)).alias("changes"), fresh, F.count_distinct("processed_at").alias("stamps"))


@_query(
    f"""WITH {oracles.LINEITEM_LOG}
SELECT {_LINE} FROM {oracles.latest('log', 'l_orderkey, l_linenumber')} WHERE NOT is_deleted"""
)
def cdc_dedup_composite_key(spark, sf_dir):
    newest = op.latest_per_key(_lines(spark, sf_dir), samples.LINEITEM.keys)
    return _line_rows(newest.where(~F.col("is_deleted")))


# -- merge ---------------------------------------------------------------------------------


def _runs(spark: SparkSession, sf_dir: str, policy: str = "coalesce") -> tuple[DataFrame, DataFrame]:
    """Latest changes of the first and of the second run."""
    messages = samples.event_messages(spark, sf_dir)

    def newest(which):
        changes = op.decode_changes(messages.where(which), samples.USERS.columns, policy)
        return op.latest_per_key(changes, samples.USERS.keys)

    return newest(F.col("first_run")), newest(~F.col("first_run"))


def _live(changes: DataFrame) -> DataFrame:
    return changes.where(~F.col("is_deleted")).drop("is_deleted")


def _two_runs(spark, sf_dir, policy="coalesce", **options) -> DataFrame:
    first, second = _runs(spark, sf_dir, policy)
    return op.merge(_live(first), second, samples.USERS.keys, **options)


_STATE = f" SELECT {oracles.COLUMNS} FROM state"


@_query(oracles.two_runs(deletes=False) + _STATE)
def merge_upsert(spark, sf_dir):
    return _user_rows(_two_runs(spark, sf_dir, mode="upsert"))


@_query(oracles.two_runs() + _STATE)
def merge_upsert_delete(spark, sf_dir):
    return _user_rows(_two_runs(spark, sf_dir, mode="upsert_delete"))


@_query(oracles.two_runs() + _STATE)
def merge_split_form(spark, sf_dir):
    return _user_rows(_two_runs(spark, sf_dir, mode="upsert_delete", form="split"))


@_query(oracles.two_runs("strict", deletes=False) + _STATE)
def merge_strict_upsert(spark, sf_dir):
    return _user_rows(_two_runs(spark, sf_dir, "strict", mode="upsert"))


@_query(oracles.two_runs("strict") + _STATE)
def merge_strict_upsert_delete(spark, sf_dir):
    return _user_rows(_two_runs(spark, sf_dir, "strict", mode="upsert_delete"))


def _stale_replay(spark, sf_dir, guard: bool) -> DataFrame:
    """Both runs, then the first one again."""
    first, second = _runs(spark, sf_dir)
    options = {"mode": "upsert_delete", "guard_deletes": guard}
    state = op.merge(_live(first), second, samples.USERS.keys, **options)
    return op.merge(state, first, samples.USERS.keys, **options)


def _stale_sql(guard: bool) -> str:
    return oracles.two_runs(guard=guard) + oracles.merged("state", "first_changes", guard=guard)


@_query(_stale_sql(False))
def merge_stale_replay(spark, sf_dir):
    return _user_rows(_stale_replay(spark, sf_dir, guard=False))


@_query(_stale_sql(True))
def merge_guarded_delete(spark, sf_dir):
    return _user_rows(_stale_replay(spark, sf_dir, guard=True))


def _replay_with_tombstones(spark, sf_dir, forget_before_ms: int | None = None) -> DataFrame:
    """Both runs, then the first one again, with deleted keys kept."""
    first, second = _runs(spark, sf_dir)
    state = first
    for changes in (second, first):
        state = op.merge_keeping_deletes(state, changes, samples.USERS.keys, forget_before_ms)
    return op.live(state)


@_query(_LATEST_LIVE)
def merge_tombstones(spark, sf_dir):
    """An older change that comes again does not bring a deleted row back."""
    return _user_rows(_replay_with_tombstones(spark, sf_dir))


_FORGET_MS = 1_707_350_400_000  # 2024-02-08 00:00:00


@_query(
    f"""WITH {oracles.users_log()}, newest AS {oracles.latest('log')},
first_changes AS {oracles.latest('log', where='first_run')}
SELECT {oracles.COLUMNS} FROM newest WHERE NOT is_deleted
UNION ALL
SELECT {oracles.COLUMNS} FROM first_changes WHERE NOT is_deleted AND user_id IN (
  SELECT user_id FROM newest WHERE is_deleted AND ts_ms < {_FORGET_MS})"""
)
def merge_tombstones_expired(spark, sf_dir):
    """Deletes before a date are forgotten, so for their keys the older change is applied again."""
    return _user_rows(_replay_with_tombstones(spark, sf_dir, _FORGET_MS))


@_query(
    f"""WITH {oracles.LINEITEM_LOG},
first_changes AS {oracles.latest('log', 'l_orderkey, l_linenumber', "l_shipdate < DATE '1999-01-01'")},
second_changes AS {oracles.latest('log', 'l_orderkey, l_linenumber', "l_shipdate >= DATE '1999-01-01'")},
base AS (SELECT * FROM first_changes WHERE NOT is_deleted)
{oracles.merged('base', 'second_changes', _LINE, 'l_orderkey, l_linenumber')}"""
)
def merge_composite_key(spark, sf_dir):
    messages = samples.lineitem_messages(spark, sf_dir)
    keys = samples.LINEITEM.keys
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    first, second = (
        op.latest_per_key(op.decode_changes(messages.where(run), samples.LINEITEM.columns), keys)
        for run in (early, ~early)
    )
    return _line_rows(op.merge(_live(first), second, keys, mode="upsert_delete"))


# -- offsets -------------------------------------------------------------------------------


def _by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.event_messages(spark, sf_dir, topic=F.col("event_type"))


@_query(
    """SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
              max(event_id) + 1 AS next_offset, count(*) AS messages
       FROM events GROUP BY ALL"""
)
def offsets_next(spark, sf_dir):
    return op.next_offsets(_by_type(spark, sf_dir))


@_query(
    f"""WITH log AS (SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS p, event_id,
                           ts < TIMESTAMP '{samples.CUT}' AS first_run FROM events),
before AS (SELECT topic, p, max(event_id) + 1 AS n FROM log WHERE first_run GROUP BY ALL),
after AS (SELECT topic, p, max(event_id) + 1 AS n FROM log WHERE NOT first_run GROUP BY ALL)
SELECT topic, p AS "partition", coalesce(a.n, b.n) AS next_offset
FROM before b FULL JOIN after a USING (topic, p)"""
)
def offsets_carry_forward(spark, sf_dir):
    messages = _by_type(spark, sf_dir)
    before = offsets_map(op.next_offsets(messages.where("first_run")))
    after = offsets_map(op.next_offsets(messages.where("NOT first_run")))
    none = F.create_map().cast("map<string,bigint>")
    both = before.alias("b").join(after.alias("a"), "topic", "full_outer")
    return both.select(
        "topic",
        F.explode(
            op.carry_forward(
                F.coalesce("b.partitions", none), F.coalesce("a.partitions", none)
            )
        ).alias("partition", "next_offset"),
    ).withColumn("partition", F.col("partition").cast("int"))


_DAILY_POSITIONS = """
positions AS (SELECT event_type AS topic, date_trunc('day', ts) AS saved,
                     CAST(user_id % 4 AS INTEGER) AS p, max(event_id) + 1 AS n
              FROM events GROUP BY ALL)"""


def _saved_documents(spark, sf_dir) -> DataFrame:
    """An offset log with one entry per topic and day."""
    events = samples.table(spark, sf_dir, "events")
    daily = events.groupBy(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.date_trunc("day", "ts").alias("timestamp"),
    ).agg((F.max("event_id") + 1).alias("next_offset"))
    return op.offsets_document(daily, by=["timestamp"])


@_query(
    f"""WITH {_DAILY_POSITIONS},
documents AS (SELECT topic, saved, '{{"' || topic || '":{{' ||
                     string_agg('"' || p || '":' || n, ',' ORDER BY p) || '}}}}' AS offsets
              FROM positions GROUP BY topic, saved)
SELECT topic, offsets FROM documents
QUALIFY row_number() OVER (PARTITION BY topic ORDER BY saved DESC) = 1"""
)
def offsets_latest_per_topic(spark, sf_dir):
    return newest_per_topic(_saved_documents(spark, sf_dir))


@_query(
    f"""WITH {_DAILY_POSITIONS}
SELECT topic, p AS "partition", n AS next_offset FROM positions
QUALIFY rank() OVER (PARTITION BY topic ORDER BY saved DESC) = 1"""
)
def offsets_parse_document(spark, sf_dir):
    return document_positions(newest_per_topic(_saved_documents(spark, sf_dir)))


@_query(
    """WITH held AS (SELECT event_id % 4 AS p, event_id // 4 AS o FROM events),
bounds AS (SELECT p, max(o) + 3 AS n FROM held GROUP BY p),
missing AS (
  SELECT p, o FROM (SELECT p, unnest(range(2, n)) AS o FROM bounds)
  EXCEPT SELECT p, o FROM held WHERE o >= 5 AND o NOT BETWEEN 20 AND 34 AND (4 * o + p) % 61 <> 7),
islands AS (SELECT p, o, o - row_number() OVER (PARTITION BY p ORDER BY o) AS island FROM missing)
SELECT 'events' AS topic, CAST(p AS INTEGER) AS "partition", min(o) AS first_lost, max(o) AS last_lost,
       count(*) AS messages_lost
FROM islands GROUP BY p, island"""
)
def offsets_lost_ranges(spark, sf_dir):
    """A log with expired messages, a hole in all partitions, single holes, and two messages not there yet."""
    offset, partition = F.floor(F.col("event_id") / 4), (F.col("event_id") % 4).cast("int")
    numbered = samples.table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"), partition.alias("partition"), offset.alias("offset"),
        F.col("event_type").alias("value"), (F.col("event_id") % 61 == 7).alias("hole"),
    )
    log = MessageLog(new_folder(spark, "holes"))
    log.write(numbered.where("offset >= 5 AND offset NOT BETWEEN 20 AND 34 AND NOT hole"))
    positions = numbered.groupBy("topic", "partition")
    saved = positions.agg(F.lit(2).cast("bigint").alias("next_offset"))
    until = positions.agg((F.max("offset") + 3).alias("next_offset"))
    return op.lost_ranges(log.read(spark, "events"), saved, until)


# -- bounded, incremental and streaming loads ------------------------------------------------


@_query(
    f"""WITH log AS (SELECT CAST(user_id % 4 AS INTEGER) AS p, event_id AS o,
                           ts < TIMESTAMP '{samples.CUT}' AS first_run FROM events),
seen AS (SELECT p, max(o) + 1 AS n FROM log WHERE first_run GROUP BY p)
SELECT 'events' AS topic, p AS "partition", o AS "offset"
FROM log LEFT JOIN seen USING (p) WHERE o >= coalesce(n, 0)"""
)
def incremental_scan(spark, sf_dir):
    log = MessageLog(new_folder(spark, "log"))
    messages = samples.event_messages(spark, sf_dir)
    log.write(messages)
    seen = op.next_offsets(messages.where("first_run")).collect()  # one row per partition
    start = {r["partition"]: r["next_offset"] for r in seen}
    return log.read(spark, "events", start=start).select("topic", "partition", "offset")


@_query(oracles.two_runs() + _STATE)
def incremental_two_runs(spark, sf_dir):
    root = new_folder(spark, "incremental")
    log = MessageLog(files.join(root, "log"))
    bronze = Bronze(files.join(root, "bronze"), mode="upsert_delete")
    messages = samples.event_messages(spark, sf_dir)
    for part in ("first_run", "NOT first_run"):
        log.write(messages.where(part))
        _expect_success(run_incremental(spark, samples.USERS, log, bronze))
    return _user_rows(bronze.table(spark, samples.USERS).read())


def _expect_success(row: dict) -> None:
    if row["status"] != "SUCCESS":
        raise RuntimeError(f"{row['table']}: {row['status']} {row['error']}")


@_query(
    oracles.two_runs()
    + """, n AS (SELECT count(*) AS messages FROM events),
live AS (SELECT count(*) AS n FROM """
    + oracles.latest("log")
    + """ WHERE NOT is_deleted)
SELECT 'first' AS run, 'SUCCESS' AS status, messages, n AS records FROM n, live
UNION ALL SELECT 'again', 'SKIPPED', 0, 0
UNION ALL SELECT 'reset', 'SUCCESS', messages, n FROM n, live"""
)
def incremental_reset(spark, sf_dir):
    """A load, a load with nothing new, and a load that starts over; the table stays the same."""
    root = new_folder(spark, "reset")
    log = MessageLog(files.join(root, "log"))
    bronze = Bronze(files.join(root, "bronze"), mode="upsert_delete")
    log.write(samples.event_messages(spark, sf_dir))
    runs = []
    for name in ("first", "again", "reset"):
        row = run_incremental(spark, samples.USERS, log, bronze, reset=name == "reset")
        runs.append((name, row["status"], row["kafka_messages"], row["final_records"]))
    return spark.createDataFrame(runs, "run STRING, status STRING, messages BIGINT, records BIGINT")


@_query(oracles.two_runs() + _STATE)
def stream_replayed_batches(spark, sf_dir):
    """Micro-batches that come again, as after a crash, change nothing."""
    bronze = Bronze(new_folder(spark, "replay"), mode="upsert_delete")
    messages = samples.event_messages(spark, sf_dir)
    for number, part in ((0, "first_run"), (1, "NOT first_run"), (1, "NOT first_run"), (0, "first_run")):
        apply_messages(spark, messages.where(part), samples.USERS, bronze, batch=("replay", number))
    return _user_rows(bronze.table(spark, samples.USERS).read())


@_query(oracles.two_runs() + _STATE)
def stream_rate_limited(spark, sf_dir):
    """The same two parts through a stream that takes two files at a time; a file holds whole partitions."""
    root = new_folder(spark, "limited")
    log = MessageLog(files.join(root, "log"))
    bronze = Bronze(files.join(root, "bronze"), mode="upsert_delete")
    messages = samples.event_messages(spark, sf_dir)
    for part in ("first_run", "NOT first_run"):
        log.write(messages.where(part).repartition("partition"))
    start_changes(
        log.stream(spark, ["events"], max_files=2),
        files.join(root, "checkpoint"),
        bronze,
        {"events": samples.USERS},
        interval=None,
    ).awaitTermination()
    return _user_rows(bronze.table(spark, samples.USERS).read())


@_query(oracles.two_runs() + _STATE)
def stream_timed_batches(spark, sf_dir):
    """The same two parts through one running stream with a timer; what is quiet in between applies nothing."""
    root = new_folder(spark, "timed")
    log = MessageLog(files.join(root, "log"))
    bronze = Bronze(files.join(root, "bronze"), mode="upsert_delete")
    messages = samples.event_messages(spark, sf_dir)
    log.write(messages.where("first_run"))
    running = start_changes(
        log.stream(spark, ["events"]), files.join(root, "checkpoint"), bronze, {"events": samples.USERS}, interval="1 second"
    )
    try:
        running.processAllAvailable()
        log.write(messages.where("NOT first_run"))
        running.processAllAvailable()
        apply_micro_batch(messages.limit(0), 10**6, bronze, {"events": samples.USERS})  # an empty batch
    finally:
        running.stop()
    return _user_rows(bronze.table(spark, samples.USERS).read())


@_query(_LATEST_LIVE)
def stream_latest_state(spark, sf_dir):
    """The newer half first, then the older half in a second start: the state knows what is newer."""
    root = new_folder(spark, "latest-state")
    log = MessageLog(files.join(root, "log"))
    messages = samples.event_messages(spark, sf_dir)
    for part in ("NOT first_run", "first_run"):
        log.write(messages.where(part))
        start_latest(
            log.stream(spark, ["events"]),
            samples.USERS,
            files.join(root, "checkpoint"),
            files.join(root, "rows"),
            interval=None,
        ).awaitTermination()
    return _user_rows(latest_rows(spark, files.join(root, "rows"), samples.USERS))


def _load_snapshots(spark, sf_dir) -> tuple[Bronze, DataFrame]:
    log = samples.snapshot_log(spark, sf_dir)
    bronze = Bronze(new_folder(spark, "full-load"))
    specs = (*samples.SNAPSHOTS, samples.LINEITEM)  # nothing was captured for the last one
    return bronze, run_tables(spark, specs, lambda s: run_full(spark, s, log, bronze))


@_query(
    " UNION ALL BY NAME ".join(f"SELECT '{spec.name}' AS table_name, * FROM {spec.name}" for spec in samples.SNAPSHOTS)
)
def full_load_all_tables(spark, sf_dir):
    """Four tables loaded in one run, every column; a row is NULL in the columns of other tables."""
    bronze, _ = _load_snapshots(spark, sf_dir)
    loaded = [
        _whole_rows(bronze.table(spark, spec).read(), spec).withColumn("table_name", F.lit(spec.name))
        for spec in samples.SNAPSHOTS
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), loaded)


@_query(
    """SELECT 'SUCCESS' AS status, CAST(4 AS BIGINT) AS tables, n AS messages, n AS records FROM (
         SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer)
              + (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier) AS n)
       UNION ALL SELECT 'SKIPPED', 1, 0, 0"""
)
def run_summary(spark, sf_dir):
    _, log = _load_snapshots(spark, sf_dir)
    return op.run_totals(log).drop("seconds")


@_query(
    oracles.two_runs()
    + f" SELECT 'users_' || (CAST(user_id AS BIGINT) % 2) AS table_name, {oracles.COLUMNS} FROM state"
)
def stream_cdc_fanout(spark, sf_dir):
    """Two topics, two rounds of the same stream; the second resumes from the checkpoint."""
    root = new_folder(spark, "stream")
    log = MessageLog(files.join(root, "log"))
    bronze = Bronze(files.join(root, "bronze"), mode="upsert_delete")
    topic = F.concat(F.lit("shop.public.users_"), F.col("user_id") % 2)
    messages = op.route_topics(samples.event_messages(spark, sf_dir, topic=topic))
    tables = {
        name: TableSpec(name, samples.USERS.keys, samples.USERS.ddl) for name in ("users_0", "users_1")
    }
    for part in ("first_run", "NOT first_run"):
        log.write(messages.where(part))
        start_changes(
            log.stream(spark, list(tables)),
            files.join(root, "checkpoint"),
            bronze,
            tables,
            interval=None,
        ).awaitTermination()
    rows = [
        _user_rows(bronze.table(spark, spec).read(), F.lit(name).alias("table_name"))
        for name, spec in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


# The nine shop tables after a load, every column; a row is NULL in the columns of other tables.
_SHOP_SQL = """
WITH newest_lines AS (
  SELECT * FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC) = 1)
SELECT 'customers' AS table_name, CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
       lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix, c_mktsegment AS customer_city,
       lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS customer_state FROM customer
UNION ALL BY NAME
SELECT 'sellers' AS table_name, CAST(s_suppkey AS VARCHAR) AS seller_id,
       lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix, s_name AS seller_city,
       lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS seller_state FROM supplier
UNION ALL BY NAME
SELECT 'products' AS table_name, CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category_name,
       CAST(length(p_name) AS DOUBLE) AS product_name_lenght, CAST(length(p_brand) AS DOUBLE) AS product_description_lenght,
       CAST(p_size AS DOUBLE) AS product_photos_qty, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS product_weight_g,
       CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size + 1 AS DOUBLE) AS product_height_cm,
       CAST(p_size + 2 AS DOUBLE) AS product_width_cm FROM part
UNION ALL BY NAME
SELECT 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_orderstatus AS order_status, CAST(o_orderdate AS VARCHAR) AS order_purchase_timestamp,
       CAST(o_orderdate + INTERVAL 1 HOUR AS VARCHAR) AS order_approved_at,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate + INTERVAL 2 DAY AS VARCHAR) END AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 9 DAY AS VARCHAR) END AS order_delivered_customer_date,
       CAST(o_orderdate + INTERVAL 14 DAY AS VARCHAR) AS order_estimated_delivery_date FROM orders
UNION ALL BY NAME
SELECT 'order_items' AS table_name, CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
       CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
       CAST(l_shipdate AS VARCHAR) AS shipping_limit_date,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
       CAST(CAST(l_quantity AS DECIMAL(10,2)) AS DOUBLE) AS freight_value FROM newest_lines
UNION ALL BY NAME
SELECT 'order_payments' AS table_name, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(1 AS BIGINT) AS payment_sequential,
       o_orderpriority AS payment_type, CAST(1 AS BIGINT) AS payment_installments,
       CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS payment_value FROM orders
UNION ALL BY NAME
SELECT 'order_reviews' AS table_name, CAST(doc_id AS VARCHAR) AS review_id, CAST(doc_id AS VARCHAR) AS order_id,
       CAST(1 + n_chars % 5 AS INTEGER) AS review_score, source AS review_comment_title,
       md5(text) AS review_comment_message, '2020-01-01 00:00:00' AS review_creation_date,
       CAST(NULL AS VARCHAR) AS review_answer_timestamp FROM documents
UNION ALL BY NAME
SELECT 'geolocation' AS table_name, CAST(event_id AS INTEGER) AS geolocation_id,
       lpad(CAST(user_id AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
       CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS geolocation_lat, CAST(user_id AS DOUBLE) AS geolocation_lng,
       event_type AS geolocation_city, CAST(NULL AS VARCHAR) AS geolocation_state FROM events
UNION ALL BY NAME
SELECT 'product_category_name_translation' AS table_name, r_name AS product_category_name,
       lower(r_name) AS product_category_name_english FROM region"""


def _shop_state(spark, bronze: Bronze) -> DataFrame:
    """Times as text; of the long review texts their digest."""
    loaded = []
    for name, spec in TABLES.items():
        rows = _whole_rows(bronze.table(spark, spec).read(), spec)
        times = [f.name for f in spec.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
        rows = rows.withColumns({c: F.col(c).cast("string") for c in times})
        if name == "order_reviews":
            rows = rows.withColumn("review_comment_message", F.md5("review_comment_message"))
        loaded.append(rows.select(F.lit(name).alias("table_name"), "*"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), loaded)


@_query(_SHOP_SQL)
def shop_full_load(spark, sf_dir):
    """All nine e-commerce tables, loaded in batch from their topics."""
    log, bronze = samples.shop_log(spark, sf_dir), Bronze(new_folder(spark, "shop"))
    log_rows = run_tables(
        spark, list(TABLES.values()), lambda s: run_incremental(spark, s, log, bronze)
    )
    for row in log_rows.collect():  # one row per table
        _expect_success(row.asDict())
    return _shop_state(spark, bronze)


@_query(_SHOP_SQL)
def shop_stream(spark, sf_dir):
    """The same through one stream over the nine topics."""
    root = new_folder(spark, "shop-stream")
    log = samples.shop_log(spark, sf_dir)
    bronze = Bronze(files.join(root, "bronze"), mode="upsert_delete")
    start_changes(
        log.stream(spark, list(TABLES)), files.join(root, "checkpoint"), bronze, TABLES, interval=None, stage=False
    ).awaitTermination()
    return _shop_state(spark, bronze)


# -- topics ----------------------------------------------------------------------------------


@_query(
    """SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset"
       FROM events"""
)
def topic_routing(spark, sf_dir):
    topic = F.concat(F.lit("cdc_.public."), F.col("event_type"))
    routed = op.route_topics(samples.event_messages(spark, sf_dir, topic=topic))
    return routed.select("topic", "partition", "offset")


@_query(
    """SELECT event_type AS topic, event_id AS "offset" FROM events
       WHERE event_type IN ('signup', 'purchase')"""
)
def table_allow_list(spark, sf_dir):
    allowed = op.allow_tables(_by_type(spark, sf_dir), ["signup", "purchase"])
    return allowed.select("topic", "offset")


@_query("SELECT DISTINCT event_type AS topic FROM events")
def distinct_topics(spark, sf_dir):
    return op.topics_of(_by_type(spark, sf_dir))


# -- capture -----------------------------------------------------------------------------------


_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _order_rows(rows: DataFrame) -> DataFrame:
    typed = silver(rows, samples.ORDERS)
    return typed.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
        "operation_type",
    )


@_query(f"SELECT {_ORDER}, 'READ' AS operation_type FROM orders")
def capture_snapshot(spark, sf_dir):
    messages = samples.snapshot_log(spark, sf_dir).read(spark, "orders")
    return _order_rows(op.decode_changes(messages, samples.ORDERS.columns))


def _order_versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Old orders are archived, early ones are closed, new ones arrive."""
    orders = samples.typed_rows(spark, sf_dir, samples.ORDERS)
    old = orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    closed = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    new = orders.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).withColumn(
        "o_orderstatus", F.when(closed, "F").otherwise(F.col("o_orderstatus"))
    )
    return old, new


_ORDER_DIFF = f"""WITH old AS (SELECT * FROM orders WHERE o_orderdate < DATE '2000-01-01'),
new AS (SELECT * REPLACE (CASE WHEN o_orderdate < DATE '1997-01-01' THEN 'F'
                               ELSE o_orderstatus END AS o_orderstatus)
        FROM orders WHERE o_orderdate >= DATE '1996-01-01')
SELECT {_ORDER}, 'CREATE' AS operation_type FROM new
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)
UNION ALL
SELECT {_ORDER}, 'DELETE' FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)
UNION ALL
SELECT {', '.join('new.' + c.strip() for c in _ORDER.split(','))}, 'UPDATE'
FROM new JOIN old USING (o_orderkey) WHERE new.o_orderstatus <> old.o_orderstatus"""


def _captured_diff(spark, sf_dir, diff) -> DataFrame:
    old, new = _order_versions(spark, sf_dir)
    log = MessageLog(new_folder(spark, "diff"))
    log.write(diff(old, new, samples.ORDERS.keys, "orders", ts_ms=F.lit(2)))
    messages = log.read(spark, "orders")
    return _order_rows(op.decode_changes(messages, samples.ORDERS.columns, "strict"))


@_query(_ORDER_DIFF)
def capture_diff(spark, sf_dir):
    return _captured_diff(spark, sf_dir, op.diff_events)


@_query(_ORDER_DIFF)
def capture_diff_pruned(spark, sf_dir):
    """The same events, with only those key buckets joined whose hashes differ."""
    return _captured_diff(spark, sf_dir, op.diff_events_pruned)


@_query(
    """SELECT o_orderkey, o_custkey,
              CASE WHEN o_orderdate < DATE '1997-01-01' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
              o_totalprice, o_orderdate, o_orderpriority
       FROM orders WHERE o_orderdate >= DATE '1996-01-01'"""
)
def capture_then_incremental(spark, sf_dir):
    """A snapshot and then the changes after it, loaded one by one from one log, give the new orders."""
    old, new = _order_versions(spark, sf_dir)
    root, keys = new_folder(spark, "capture"), samples.ORDERS.keys
    log = MessageLog(files.join(root, "log"))
    bronze = Bronze(files.join(root, "bronze"), mode="upsert_delete", image_policy="strict")
    snapshot = op.snapshot_events(old, keys, "orders", ts_ms=F.lit(1))
    changes = op.diff_events(old, new, keys, "orders", ts_ms=F.lit(2))
    for events in (snapshot, changes):
        log.append(events)
        _expect_success(run_incremental(spark, samples.ORDERS, log, bronze))
    return _order_rows(bronze.table(spark, samples.ORDERS).read()).drop("operation_type")


# -- quality -----------------------------------------------------------------------------------


_RULE = "CAST(count(*) FILTER (WHERE {}) AS BIGINT) AS violations"


def _rules(source: str, table: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
        f"{_RULE.format(condition)} FROM {source}"
        for rule, column, condition in rules
    )


@_query(
    """WITH copies AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'lineitem' AS table_name, 'key_unique' AS rule,
       'l_orderkey,l_linenumber' AS column_name, CAST(sum(n - 1) AS BIGINT) AS violations FROM copies
UNION ALL SELECT 'lineitem', 'key_not_null', 'l_orderkey,l_linenumber', count(*) FROM lineitem
WHERE l_orderkey IS NULL OR l_linenumber IS NULL"""
)
def dq_pk(spark, sf_dir):
    lines = samples.table(spark, sf_dir, "lineitem")
    return op.key_violations(lines, samples.LINEITEM.keys, "lineitem")


@_query(
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
       GROUP BY ALL HAVING count(*) > 1"""
)
def dq_duplicate_keys(spark, sf_dir):
    return op.duplicate_keys(samples.table(spark, sf_dir, "lineitem"), samples.LINEITEM.keys)


@_query(
    f"WITH {oracles.users_log('strict')} "
    + _rules(
        "log",
        "events",
        [
            ("not_null", "user_id", "user_id IS NULL"),
            ("type", "user_id", "false"),
            ("not_null", "event_type", "event_type IS NULL"),
            ("not_null", "value", "value IS NULL"),
            ("type", "value", "false"),
        ],
    )
)
def dq_not_null(spark, sf_dir):
    return op.row_violations(_users(spark, sf_dir, "strict"), samples.USERS)


@_query(
    _rules(
        "lineitem",
        "lineitem",
        [
            *(
                ("not_null", c, f"{c} IS NULL")
                for c in (
                    "l_orderkey",
                    "l_linenumber",
                    "l_partkey",
                    "l_suppkey",
                    "l_quantity",
                    "l_extendedprice",
                )
            ),
            ("length", "l_returnflag", "length(l_returnflag) > 1"),
            ("length", "l_linestatus", "length(l_linestatus) > 1"),
            ("check", "l_quantity", "l_quantity NOT BETWEEN 1 AND 40"),
        ],
    )
)
def dq_check_range(spark, sf_dir):
    lines = samples.typed_rows(spark, sf_dir, samples.LINEITEM)
    return op.row_violations(lines, samples.LINEITEM, typed_input=True)


_SHORT_CUSTOMER = TableSpec(
    "customer",
    ("c_custkey",),
    "c_custkey BIGINT NOT NULL, c_name VARCHAR(17), c_mktsegment VARCHAR(8)",
)


@_query(
    _rules(
        "customer",
        "customer",
        [
            ("not_null", "c_custkey", "c_custkey IS NULL"),
            ("length", "c_name", "length(c_name) > 17"),
            ("length", "c_mktsegment", "length(c_mktsegment) > 8"),
        ],
    )
)
def dq_length(spark, sf_dir):
    customers = samples.table(spark, sf_dir, "customer")
    return op.row_violations(customers, _SHORT_CUSTOMER, typed_input=True)


_SMALL_ORDERS = TableSpec(
    "orders",
    ("o_orderkey",),
    "o_orderkey BIGINT NOT NULL, o_totalprice DECIMAL(7,2), o_orderpriority INT",
)


@_query(
    _rules(
        "orders",
        "orders",
        [
            ("not_null", "o_orderkey", "o_orderkey IS NULL"),
            ("type", "o_orderkey", "false"),
            ("type", "o_totalprice", "o_totalprice >= 99999.995"),
            ("type", "o_orderpriority", "o_orderpriority IS NOT NULL"),
        ],
    )
)
def dq_decimal(spark, sf_dir):
    """Bronze text that does not fit the declared type."""
    changes = op.decode_changes(
        samples.snapshot_log(spark, sf_dir).read(spark, "orders"), _SMALL_ORDERS.columns
    )
    return op.row_violations(changes, _SMALL_ORDERS)


@_query(
    """SELECT l_orderkey, count(*) AS child_rows FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1996-01-01')
       GROUP BY ALL"""
)
def dq_orphans(spark, sf_dir):
    """Lines whose order is not among those since 1996."""
    orders = samples.table(spark, sf_dir, "orders")
    kept = orders.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    lines = samples.table(spark, sf_dir, "lineitem")
    return op.orphans(lines, ["l_orderkey"], kept, ["o_orderkey"])


@_query(
    """SELECT 'lineitem' AS table_name, 'reference_orders' AS rule, 'l_orderkey' AS column_name,
              count(*) AS violations FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
       UNION ALL SELECT 'lineitem', 'reference_part', 'l_partkey', count(*) FROM lineitem
       WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)
       UNION ALL SELECT 'lineitem', 'reference_supplier', 'l_suppkey', count(*) FROM lineitem
       WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
       UNION ALL SELECT 'orders', 'reference_customer', 'o_custkey', count(*) FROM orders
       WHERE o_orderstatus <> 'P'
         AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')"""
)
def dq_references(spark, sf_dir):
    """Every declared reference, with the pending orders, one customer segment and large parts archived."""
    tables = {t: samples.table(spark, sf_dir, t) for t in ("lineitem", "supplier")}
    orders, customers = (samples.table(spark, sf_dir, t) for t in ("orders", "customer"))
    tables["orders"] = orders.where(F.col("o_orderstatus") != "P")
    tables["customer"] = customers.where(F.col("c_mktsegment") != "BUILDING")
    tables["part"] = samples.table(spark, sf_dir, "part").where("p_size <= 45")
    return op.reference_violations(tables, [samples.LINEITEM, samples.ORDERS])


@_query(
    """WITH late AS (SELECT * FROM lineitem WHERE l_shipdate >= DATE '2000-01-01'),
early AS (SELECT * FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM late n WHERE n.l_orderkey = l.l_orderkey AND n.l_linenumber = l.l_linenumber)),
pending AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'),
builders AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT 'lineitem' AS table_name, 'reference_orders' AS rule, 'l_orderkey' AS column_name, 'changed' AS cause,
       count(*) AS violations FROM late WHERE l_orderkey IN (FROM pending)
UNION ALL SELECT 'lineitem', 'reference_orders', 'l_orderkey', 'deleted', count(*) FROM early
WHERE l_orderkey IN (FROM pending)
UNION ALL SELECT 'lineitem', 'reference_part', 'l_partkey', 'changed', count(*) FROM late
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)
UNION ALL SELECT 'lineitem', 'reference_supplier', 'l_suppkey', 'changed', count(*) FROM late
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'orders', 'reference_customer', 'o_custkey', 'deleted', count(*) FROM orders
WHERE o_orderstatus <> 'P' AND o_custkey IN (FROM builders)"""
)
def dq_references_delta(spark, sf_dir):
    """One slice: the lines since 2000 changed, the pending orders and one customer segment were deleted."""
    lines, orders, customers, part, supplier = (
        samples.table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "part", "supplier")
    )
    pending, builders = F.col("o_orderstatus") == "P", F.col("c_mktsegment") == "BUILDING"
    tables = {
        "lineitem": lines, "orders": orders.where(~pending), "customer": customers.where(~builders),
        "part": part.where("p_size <= 45"), "supplier": supplier,
    }
    changed = {"lineitem": lines.where(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))}
    deleted = {"orders": orders.where(pending), "customer": customers.where(builders)}
    return op.reference_deltas(tables, changed, deleted, [samples.LINEITEM, samples.ORDERS])


@_query(
    "SELECT row_number() OVER () AS line_id, * FROM lineitem"
)
def surrogate_key(spark, sf_dir):
    return op.surrogate_key(spark, f"{sf_dir}/lineitem.parquet", "line_id")


# -- counts, catalog, seed files -----------------------------------------------------------------


_TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@_query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLE_NAMES
    )
)
def table_counts(spark, sf_dir):
    return op.table_counts({t: samples.table(spark, sf_dir, t) for t in _TABLE_NAMES})


@_query("SELECT * FROM orders")
def catalog_roundtrip(spark, sf_dir):
    """Land a table, register it twice (create, then refresh) and read it by name."""
    path = new_folder(spark, "orders")
    samples.table(spark, sf_dir, "orders").write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS bronze.landed_orders")
    for _ in range(2):
        register(spark, "bronze", "landed_orders", path)
    return spark.table("bronze.landed_orders")


@_query("SELECT * FROM orders")
def catalog_new_columns(spark, sf_dir):
    """A table registered with some of its columns shows the others once they are written."""
    path = new_folder(spark, "orders")
    orders = samples.table(spark, sf_dir, "orders")
    spark.sql("DROP TABLE IF EXISTS bronze.grown_orders")
    for rows in (orders.select("o_orderkey", "o_custkey"), orders):
        rows.write.mode("overwrite").parquet(path)
        register(spark, "bronze", "grown_orders", path)
    return spark.table("bronze.grown_orders")


@_query(oracles.two_runs() + _STATE)
def catalog_state_table(spark, sf_dir):
    """Publish a state table after each of two commits and read it by name."""
    first, second = _runs(spark, sf_dir)
    state = StateTable(spark, new_folder(spark, "users"), samples.USERS.keys)
    for changes in (first, second):
        state.apply(changes, "upsert_delete")
        publish(spark, "bronze", "users_now", state)
    return _user_rows(spark.table("bronze.users_now"))


_SEEDS = {
    "region": TableSpec("region", ("r_regionkey",), "r_regionkey INT NOT NULL, r_name STRING"),
    "nation": TableSpec(
        "nation", ("n_nationkey",), "n_nationkey INT NOT NULL, n_name STRING, n_regionkey INT"
    ),
    "customer": samples.CUSTOMER,
}


def _seed_csv(spark, sf_dir, spec: TableSpec) -> str:
    path = new_folder(spark, f"csv-{spec.name}")
    _write_csv(samples.table(spark, sf_dir, spec.name).select(spec.columns), path)
    return path


def _write_csv(rows: DataFrame, path: str) -> None:
    writer = rows.write.option("header", True).option("escape", '"').option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


@_query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS file_rows, count(*) AS stored_rows FROM {t}"
        for t in _SEEDS
    )
)
def csv_load_counts(spark, sf_dir):
    """Rows of the source tables against rows stored from their seed files."""
    landed = {}
    for name, spec in _SEEDS.items():
        landing = new_folder(spark, name)
        load_csv(spark, _seed_csv(spark, sf_dir, spec), spec, landing)
        landed[name] = spark.read.parquet(landing)
    source = op.table_counts({name: samples.table(spark, sf_dir, name) for name in _SEEDS})
    stored = op.table_counts(landed).withColumnRenamed("n_rows", "stored_rows")
    return source.withColumnRenamed("n_rows", "file_rows").join(stored, "table_name")


@_query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_load(spark, sf_dir):
    landing = new_folder(spark, "customer")
    load_csv(spark, _seed_csv(spark, sf_dir, samples.CUSTOMER), samples.CUSTOMER, landing)
    typed = silver(spark.read.parquet(landing), samples.CUSTOMER)
    return typed.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


_TEXTS = TableSpec("documents", ("doc_id",), "doc_id BIGINT NOT NULL, lang STRING, text STRING")


@_query("SELECT doc_id, lang, md5(text) AS text_md5, length(text) AS n_chars FROM documents")
def csv_load_free_text(spark, sf_dir):
    """Texts with quotes, commas and line breaks come back unchanged."""
    landing = new_folder(spark, "documents")
    load_csv(spark, _seed_csv(spark, sf_dir, _TEXTS), _TEXTS, landing)
    return _text_rows(silver(spark.read.parquet(landing), _TEXTS))


def _text_rows(texts: DataFrame) -> DataFrame:
    return texts.select(
        "doc_id",
        "lang",
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
        F.length("text").cast("bigint").alias("n_chars"),
    )


@_query("SELECT doc_id, lang, md5(text) AS text_md5, length(text) AS n_chars FROM documents")
def csv_load_split(spark, sf_dir):
    """The same texts from files that are split, wherever their line breaks stand."""
    landing = new_folder(spark, "documents")
    load_csv(spark, _seed_csv(spark, sf_dir, _TEXTS), _TEXTS, landing, split=True)
    return _text_rows(silver(spark.read.parquet(landing), _TEXTS))


_SEED_SOURCES = (
    "region", "customer", "supplier", "part", "orders", "lineitem", "orders", "documents", "events",
)


@_query(
    " UNION ALL ".join(
        f"SELECT CAST({n} AS INTEGER) AS load_order, '{seed.table}' AS table_name, 'LOADED' AS status, "
        f"count(*) AS file_rows, count(*) AS stored_rows FROM {source}"
        for n, (seed, source) in enumerate(zip(SEEDS, _SEED_SOURCES, strict=True), 1)
    )
)
def seed_load_all(spark, sf_dir):
    """All nine seed files, in order, with the key that one of them lacks."""
    folder = new_folder(spark, "seeds")
    shop = samples.shop_tables(spark, sf_dir)
    for seed in SEEDS:
        rows = shop[seed.table]
        rows = rows.drop(seed.generated) if seed.generated else rows
        _write_csv(rows, files.join(folder, seed.file))
    return load_seeds(spark, folder, new_folder(spark, "landed")).drop("error")


# -- silver and gold ---------------------------------------------------------------------------


@_query(f"SELECT {_ORDER}, 'READ' AS operation_type FROM orders")
def silver_typed(spark, sf_dir):
    """Bronze text of all orders, latest version per key, typed."""
    changes = op.decode_changes(samples.snapshot_log(spark, sf_dir).read(spark, "orders"), samples.ORDERS.columns)
    return _order_rows(op.latest_per_key(changes, samples.ORDERS.keys).drop("is_deleted"))


def _dirty_orders(spark, sf_dir) -> DataFrame:
    """Bronze orders with text in some amounts and dates, as a hand-edited source would have."""
    changes = op.decode_changes(
        samples.snapshot_log(spark, sf_dir).read(spark, "orders"), samples.ORDERS.columns
    )
    cancelled, urgent = F.col("o_orderstatus") == "P", F.col("o_orderpriority") == "1-URGENT"
    return changes.withColumn(
        "o_totalprice",
        F.when(cancelled, F.concat(F.col("o_totalprice"), F.lit(" EUR"))).otherwise(
            F.col("o_totalprice")
        ),
    ).withColumn("o_orderdate", F.when(urgent, "asap").otherwise(F.col("o_orderdate")))


@_query(
    """SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'o_totalprice' END,
                                        CASE WHEN o_orderpriority = '1-URGENT' THEN 'o_orderdate' END
                                   ) AS failures
       FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'"""
)
def silver_rejected(spark, sf_dir):
    rejects = silver_rejects(_dirty_orders(spark, sf_dir), samples.ORDERS)
    return rejects.select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
        F.array_join("cast_failures", ",").alias("failures"),
    )


@_query(
    f"""SELECT {_ORDER}, 'READ' AS operation_type FROM orders
        WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'"""
)
def silver_accepted(spark, sf_dir):
    return _order_rows(_dirty_orders(spark, sf_dir))


@_query(
    """SELECT date_trunc('day', l_shipdate) AS window_start,
              date_trunc('day', l_shipdate) + INTERVAL 1 DAY AS window_end, l_returnflag,
              count(l_extendedprice) AS n_values,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS total,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE)
                / count(l_extendedprice) AS average
       FROM lineitem GROUP BY ALL"""
)
def gold_daily(spark, sf_dir):
    lines = samples.typed_rows(spark, sf_dir, samples.LINEITEM)
    daily = totals_by_window(lines, "l_shipdate", "l_extendedprice", by=["l_returnflag"])
    return daily.withColumn("total", F.col("total").cast("double"))


_THIRTY_DAYS = "time_bucket(INTERVAL '30 days', l_shipdate, TIMESTAMP '1970-01-01')"


def _staged(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@_query(
    f"""WITH {oracles.LINEITEM_LOG},
first_changes AS {oracles.latest('log', 'l_orderkey, l_linenumber', "l_shipdate < DATE '1999-01-01'")},
second_changes AS {oracles.latest('log', 'l_orderkey, l_linenumber', "l_shipdate >= DATE '1999-01-01'")},
base AS (SELECT * FROM first_changes WHERE NOT is_deleted),
state AS ({oracles.merged('base', 'second_changes', _LINE, 'l_orderkey, l_linenumber')})
SELECT {_THIRTY_DAYS} AS window_start, {_THIRTY_DAYS} + INTERVAL 30 DAY AS window_end, l_returnflag,
       count(l_extendedprice) AS n_values,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS total,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) / count(l_extendedprice) AS average
FROM state GROUP BY ALL"""
)
def gold_incremental(spark, sf_dir):
    """Totals kept through two runs, the second one twice: only the windows of its changes are rewritten."""
    root, spec = new_folder(spark, "gold"), samples.LINEITEM
    gold, by, width = files.join(root, "totals"), ["l_returnflag"], "30 days"
    table = StateTable(spark, files.join(root, "lines"), spec.keys)
    messages = samples.lineitem_messages(spark, sf_dir)
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    for number, part in enumerate((early, ~early)):
        changes = op.latest_per_key(op.decode_changes(messages.where(part), spec.columns), spec.keys)
        # The table, both images and the totals all need them: decoded once.
        staged_at = files.join(root, f"changes-{number}")
        changes = _staged(changes, staged_at)
        before = table.read() if table.exists() else None
        table.apply(changes, "upsert_delete", staged_at=staged_at)
        after = table.read()
        before = after.limit(0) if before is None else before
        old, new = (silver(rows, spec) for rows in images(before, changes, after, spec.keys))
        sums = window_changes(old, new, "l_shipdate", "l_extendedprice", by, width)
        sums = _staged(sums, files.join(root, f"sums-{number}"))
        for _ in range(number + 1):
            maintain_windows(spark, gold, sums, number, by)
    kept = window_totals(spark.read.parquet(gold), by, width)
    return kept.withColumn("total", F.col("total").cast("double"))


def current_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the current state of every user from the whole change log."""
    return cdc_dedup_latest(spark, sf_dir)
