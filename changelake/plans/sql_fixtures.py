"""The change-log derivation of ``changelake.sources.testlog`` in DuckDB SQL,
for oracles. ``log`` has every delivered record with its derived columns and
the reason it is rejected (null when good); ``good`` keeps the good ones."""

LOG_CTE = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'click' THEN 'u'
                         WHEN 'purchase' THEN 'u' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         CASE WHEN event_id % 7 = 3 AND event_id > 700 THEN event_id - 700 ELSE event_id END AS lsn,
         CAST(user_id % 6 AS INTEGER) AS part,
         lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_eid
  FROM events),
log AS (
  SELECT *, event_id AS off,
         CASE WHEN event_id % 79 = 0 THEN 'tombstone' WHEN event_id % 97 = 0 THEN 'bad_json'
              WHEN event_id % 89 = 0 THEN 'bad_lsn' WHEN event_id % 83 = 0 THEN 'bad_pk'
              WHEN (event_id % 71 = 0 OR op <> 'd') AND (op = 'd' OR event_id % 73 = 0) THEN 'after_missing'
              WHEN event_id % 71 = 0 THEN 'bad_op' END AS reason
  FROM ev
  UNION ALL
  SELECT *, event_id + 1099511627776 AS off,
         CASE WHEN event_id % 79 = 0 THEN 'tombstone' WHEN event_id % 97 = 0 THEN 'bad_json'
              WHEN event_id % 89 = 0 THEN 'bad_lsn' WHEN event_id % 83 = 0 THEN 'bad_pk'
              WHEN (event_id % 71 = 0 OR op <> 'd') AND (op = 'd' OR event_id % 73 = 0) THEN 'after_missing'
              WHEN event_id % 71 = 0 THEN 'bad_op' END AS reason
  FROM ev WHERE event_id % 10 = 0),
good AS (SELECT * FROM log WHERE reason IS NULL)
"""


def with_log(body: str) -> str:
    return "WITH " + LOG_CTE.strip() + ",\n" + body.strip()


# Latest good change per key (higher LSN, then earliest delivery).
LATEST_CTE = """
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, part, off) AS rn FROM good)
  WHERE rn = 1)
"""

TYPED_DOC_SELECT = """
  'users:' || CAST(user_id AS VARCHAR) AS _id, CAST(user_id AS VARCHAR) AS pk, user_id AS _pkId,
  event_type AS eventType, value AS amount, props, TRUE AS isActive, lsn AS sourceLsn,
  CAST(1 AS INTEGER) AS schemaVersion
"""

# Events classified by the gate: prefix max of earlier deliveries of the key.
CLASSIFIED_CTE = """
cl AS (
  SELECT *, max(lsn) OVER (PARTITION BY user_id ORDER BY part, off
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
  FROM good),
classified AS (
  SELECT *, CASE WHEN prev_max IS NULL OR lsn > prev_max THEN 'applied'
                 WHEN lsn = prev_max THEN 'duplicate' ELSE 'stale' END AS status
  FROM cl)
"""

# Second snapshot of orders (see testlog.orders_next_snapshot).
NEXT_ORDERS_CTE = """
nxt AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 13 = 0 THEN CASE o_orderstatus WHEN 'O' THEN 'F' WHEN 'F' THEN 'O' ELSE 'F' END
              ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 11 <> 0
  UNION ALL
  SELECT o_orderkey + (SELECT max(o_orderkey) FROM orders) + 1, o_custkey, o_orderstatus, o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey < 500)
"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def row_text_sql(cols, alias=""):
    p = (alias + ".") if alias else ""
    return "concat(" + ", ".join(
        f"coalesce(length(CAST({p}{c} AS VARCHAR)) || ':' || CAST({p}{c} AS VARCHAR), '-')" for c in cols) + ")"
