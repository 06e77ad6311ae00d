"""Building blocks of the SQL that the registered queries are compared with."""

from __future__ import annotations

from tidemark.plans.samples import CUT

COLUMNS = "user_id, event_type, value, operation_type, ts_ms, p, o"


def users_log(policy: str = "coalesce") -> str:
    """CTE ``log``: the decoded change rows of the events."""
    value = "value"
    if policy == "strict":
        value = (
            "CASE WHEN event_type IN ('click', 'purchase') AND event_id % 7 = 0 "
            "THEN NULL ELSE value END"
        )
    return f"""
log AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, {value} AS value,
         CASE event_type WHEN 'signup' THEN 'CREATE' WHEN 'view' THEN 'READ'
                         WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation_type,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r'
                         WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         event_type = 'error' AS is_deleted,
         epoch_us(ts) // 1000 AS ts_ms,
         CAST(user_id % 4 AS INTEGER) AS p, event_id AS o,
         ts < TIMESTAMP '{CUT}' AS first_run
  FROM events)"""


LINEITEM_LOG = """
log AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
         l_tax, l_returnflag, l_linestatus, l_shipdate, l_returnflag = 'R' AS is_deleted,
         epoch_us(l_shipdate) // 1000 AS ts_ms,
         CAST(l_suppkey % 4 AS INTEGER) AS p, l_partkey AS o
  FROM lineitem)"""


def latest(source: str, keys: str = "user_id", where: str = "true") -> str:
    return f"""(
  SELECT * FROM {source} WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY ts_ms DESC, o DESC, p DESC) = 1)"""


def merged(
    target: str,
    changes: str,
    columns: str = COLUMNS,
    keys: str = "user_id",
    deletes: bool = True,
    guard: bool = False,
) -> str:
    """SELECT of the merge result; ``target`` and ``changes`` are CTE names."""
    names = [c.strip() for c in columns.split(",")]
    key_list = [k.strip() for k in keys.split(",")]
    on = " AND ".join(f"t.{k} = s.{k}" for k in key_list)
    first = key_list[0]
    source = changes if deletes else f"(SELECT * FROM {changes} WHERE NOT is_deleted)"
    newer = "coalesce(s.ts_ms >= t.ts_ms, false)"
    picked = ", ".join(
        f"CASE WHEN t.{first} IS NULL OR (s.{first} IS NOT NULL AND NOT s.is_deleted AND {newer}) "
        f"THEN s.{c} ELSE t.{c} END AS {c}"
        for c in names
    )
    removed = "coalesce(s.is_deleted, false)"
    if guard:
        removed += f" AND (t.{first} IS NULL OR {newer})"
    return f"""SELECT {picked}
  FROM {target} t FULL JOIN {source} s ON {on}
  WHERE NOT ({removed})"""


def two_runs(policy: str = "coalesce", **options) -> str:
    """WITH clause ending in CTE ``state``: the table after both runs over the events."""
    return f"""WITH {users_log(policy)},
first_changes AS {latest('log', where='first_run')},
second_changes AS {latest('log', where='NOT first_run')},
base AS (SELECT {COLUMNS} FROM first_changes WHERE NOT is_deleted),
state AS ({merged('base', 'second_changes', **options)})"""
