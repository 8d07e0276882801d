"""The rules of ``derive.py`` as SQL for the checking engine: common table expressions."""

from __future__ import annotations


def key_hash(key: str) -> str:
    return f"('0x' || substr(md5({key}), 1, 8))::BIGINT"


def part(key: str, n: int = 3) -> str:
    return f"({key_hash(key)} % {n})::INTEGER"


USER = "user_id::VARCHAR"

# The events topic.
LOG = f"""log AS (
  SELECT 'events' AS topic, {part(USER)} AS partition,
         row_number() OVER (PARTITION BY {part(USER)} ORDER BY event_id) - 1 AS "offset",
         ts AS "timestamp", {USER} AS "key", props AS "value",
         event_id, user_id, event_type, "value" AS amount
  FROM events)"""

BOUNDS = """bounds AS (
  SELECT topic, partition, min("offset") AS log_start, max("offset") + 1 AS log_end
  FROM log GROUP BY topic, partition)"""

COMMITS = """commits AS (
  SELECT 'a' AS group_id, topic, partition, log_end AS committed FROM bounds
  UNION ALL SELECT 'b', topic, partition, log_end // 2 FROM bounds)"""

GROUPS = """grp AS (SELECT * FROM (VALUES ('a'), ('b'), ('c')) g(group_id))"""

AT = """pos AS (
  SELECT g.group_id, b.topic, b.partition, b.log_start, b.log_end, c.committed
  FROM bounds b CROSS JOIN grp g
  LEFT JOIN commits c ON c.group_id = g.group_id AND c.topic = b.topic AND c.partition = b.partition)"""

POSITIONS = ", ".join([LOG, BOUNDS, COMMITS, GROUPS, AT])

# The same with three quarters of every partition expired.
EXPIRED = POSITIONS.replace(
    'min("offset") AS log_start', '((max("offset") + 1) // 4) * 3 AS log_start'
)

TYPES = f"""log AS (
  SELECT topic, partition, row_number() OVER (PARTITION BY topic, partition ORDER BY event_id) - 1 AS "offset",
         event_id, user_id, props AS "value", ts AS "timestamp"
  FROM (SELECT 'events.' || CASE WHEN event_type = 'purchase' AND "value" > 100 THEN 'purchse' ELSE event_type END AS topic,
               {part(USER)} AS partition, event_id, user_id, props, ts FROM events))"""

ALLOWED = """allowed AS (SELECT * FROM (VALUES ('events.click'), ('events.error'), ('events.purchase'),
  ('events.signup'), ('events.refund')) t(topic))"""

PRODUCED = LOG + """, produced AS (
  SELECT topic, partition, "offset", event_id AS seq, event_type, amount, "timestamp" FROM log
  UNION ALL
  SELECT l.topic, l.partition,
         e.n + row_number() OVER (PARTITION BY l.partition ORDER BY l.event_id) - 1,
         l.event_id, l.event_type, l.amount, l."timestamp"
  FROM log l JOIN (SELECT partition, count(*) AS n FROM log GROUP BY partition) e USING (partition)
  WHERE l.event_type = 'purchase')"""

DELIVERY = """delivery AS (
  SELECT 'events' AS topic, event_id AS seq, ts AS sent_at,
         CASE WHEN NOT (event_type = 'signup' AND "value" > 100)
              THEN epoch_us(ts) + round("value" * 1000)::BIGINT END AS acked_us,
         CASE WHEN event_type = 'signup' AND "value" > 150 THEN 'BROKER_NOT_AVAILABLE'
              WHEN event_type = 'signup' AND "value" > 100 THEN 'MESSAGE_TIMED_OUT' END AS error,
         CASE WHEN event_type IN ('view', 'click') THEN 50 ELSE 0 END AS linger_ms
  FROM events),
survived AS (
  SELECT event_id AS seq FROM events
  WHERE NOT (event_type = 'signup' AND "value" > 100) AND NOT (event_type = 'view' AND "value" > 150))"""

OKEY = "o_orderkey::VARCHAR"
ORDERS = f"""typed AS (
  SELECT 'order.created' AS topic, {part(OKEY)} AS partition,
         row_number() OVER (PARTITION BY {part(OKEY)} ORDER BY o_orderkey) - 1 AS "offset",
         {OKEY} AS id, 'customer-' || o_custkey AS customer_id, o_orderpriority AS item,
         o_totalprice AS amount,
         CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 3 ELSE 0 END AS status,
         o_orderdate AS created_at, coalesce(r_name, '') AS region,
         CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 2 ELSE 1 END AS schema_id
  FROM orders LEFT JOIN (
    SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey) ON o_custkey = c_custkey)"""

STATUS_NAME = """CASE status WHEN 0 THEN 'ORDER_STATUS_UNSPECIFIED' WHEN 1 THEN 'ORDER_STATUS_CREATED'
  WHEN 2 THEN 'ORDER_STATUS_PAID' WHEN 3 THEN 'ORDER_STATUS_FULFILLED'
  WHEN 4 THEN 'ORDER_STATUS_CANCELLED' ELSE 'UNKNOWN' END"""

REGISTRY = """registry AS (
  SELECT 'customer-' || o_custkey || '-value' AS subject,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::INTEGER AS version,
         (o_orderkey + 1)::INTEGER AS schema_id, o_orderstatus AS status
  FROM orders),
fields AS (
  SELECT (l_orderkey + 1)::INTEGER AS schema_id, l_linenumber AS field_no,
         'f' || (l_linenumber + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS name,
         CASE WHEN flag = 'A' AND line = 'F' THEN 'string' WHEN flag = 'A' THEN 'bytes'
              WHEN flag = 'N' AND line = 'F' THEN 'int32' WHEN flag = 'N' THEN 'int64'
              WHEN line = 'F' THEN 'sint32' ELSE 'int32' END AS type,
         tax = 0.0 AS reserved
  FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS flag, min(l_linestatus) AS line, max(l_tax) AS tax
        FROM lineitem GROUP BY l_orderkey, l_linenumber)
  JOIN orders ON l_orderkey = o_orderkey),
declared AS (SELECT r.subject, r.version, f.* FROM registry r JOIN fields f USING (schema_id))"""

# Segments of the events topic: 2,000 bytes or one day, jumping from start to start.
SEGMENTS = LOG + """, sized AS (
  SELECT topic, partition, "offset", octet_length(encode("value")) AS size, (epoch_us("timestamp") // 1000) AS ms,
         sum(octet_length(encode("value"))) OVER (PARTITION BY partition ORDER BY "offset"
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - octet_length(encode("value")) AS ahead
  FROM log),
starts AS (
  WITH RECURSIVE jump AS (
    SELECT partition, min("offset") AS base FROM sized GROUP BY partition
    UNION ALL
    SELECT j.partition, (
      SELECT min(n."offset") FROM sized n, sized s
      WHERE s.partition = j.partition AND s."offset" = j.base AND n.partition = j.partition AND n."offset" > j.base
        AND (n.ahead - s.ahead >= 2000 OR n.ms - s.ms >= 86400000)) AS base
    FROM jump j WHERE j.base IS NOT NULL)
  SELECT partition, base FROM jump WHERE base IS NOT NULL),
ranged AS (
  SELECT partition, base, lead(base) OVER (PARTITION BY partition ORDER BY base) AS nxt,
         row_number() OVER (PARTITION BY partition ORDER BY base) - 1 AS segment_id FROM starts),
segs AS (
  SELECT s.topic, s.partition, r.segment_id, r.base AS segment_base, max(s."offset") AS last_offset,
         count(*) AS n_records, sum(s.size)::BIGINT AS n_bytes, arg_min(s.ms, s."offset") AS first_ms,
         max(s.ms) AS last_ms,
         any_value(r.nxt) IS NULL AND sum(s.size) < 2000
           AND 1706659200000 < arg_min(s.ms, s."offset") + 86400000 AS is_active
  FROM sized s JOIN ranged r ON s.partition = r.partition AND s."offset" >= r.base
    AND (r.nxt IS NULL OR s."offset" < r.nxt)
  GROUP BY s.topic, s.partition, r.segment_id, r.base),
judged AS (
  SELECT *, is_active OR keep_young AS keep_time,
         is_active OR newest <= 20000 AS keep_bytes,
         is_active OR (bool_or(is_active OR keep_young) OVER (PARTITION BY partition ORDER BY segment_base)
                       AND newest <= 20000) AS keep
  FROM (SELECT *, last_ms >= 1706659200000 - 864000000 AS keep_young,
               sum(CASE WHEN is_active THEN 0 ELSE n_bytes END)
                 OVER (PARTITION BY partition ORDER BY segment_base DESC) AS newest FROM segs)),
cleaned AS (
  SELECT topic, partition, min(segment_base) AS log_start_before,
         coalesce(min(segment_base) FILTER (keep), max(last_offset) + 1)::BIGINT AS log_start_after,
         max(last_offset) + 1 AS log_end FROM judged GROUP BY topic, partition)"""

# Segments of the topics per event type, each by its own limits or those of the broker.
MIXED = TYPES + """, config AS (
  SELECT * FROM (VALUES ('events.click', 864000000, 20000, 2000, 86400000), ('events.view', NULL, NULL, 2000, 86400000))
    c(topic, ret_ms, ret_bytes, seg_bytes, seg_ms)),
limits AS (
  SELECT t.topic, CASE WHEN c.topic IS NULL THEN 604800000 ELSE c.ret_ms END AS ret_ms, c.ret_bytes,
         coalesce(c.seg_bytes, 1073741824) AS seg_bytes, coalesce(c.seg_ms, 604800000) AS seg_ms
  FROM (SELECT DISTINCT topic FROM log) t LEFT JOIN config c ON t.topic = c.topic),
sized AS (
  SELECT topic, partition, "offset", octet_length(encode("value")) AS size, (epoch_us("timestamp") // 1000) AS ms,
         sum(octet_length(encode("value"))) OVER (PARTITION BY topic, partition ORDER BY "offset"
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - octet_length(encode("value")) AS ahead,
         l.seg_bytes, l.seg_ms
  FROM log JOIN limits l USING (topic)),
starts AS (
  WITH RECURSIVE jump AS (
    SELECT topic, partition, min("offset") AS base FROM sized GROUP BY topic, partition
    UNION ALL
    SELECT j.topic, j.partition, (
      SELECT min(n."offset") FROM sized n, sized s
      WHERE s.topic = j.topic AND s.partition = j.partition AND s."offset" = j.base
        AND n.topic = j.topic AND n.partition = j.partition AND n."offset" > j.base
        AND (n.ahead - s.ahead >= s.seg_bytes OR n.ms - s.ms >= s.seg_ms)) AS base
    FROM jump j WHERE j.base IS NOT NULL)
  SELECT topic, partition, base FROM jump WHERE base IS NOT NULL),
ranged AS (
  SELECT topic, partition, base, lead(base) OVER (PARTITION BY topic, partition ORDER BY base) AS nxt FROM starts),
segs AS (
  SELECT s.topic, s.partition, r.base AS segment_base, max(s."offset") AS last_offset,
         sum(s.size)::BIGINT AS n_bytes, max(s.ms) AS last_ms,
         any_value(r.nxt) IS NULL AND sum(s.size) < any_value(s.seg_bytes)
           AND 1706659200000 < arg_min(s.ms, s."offset") + any_value(s.seg_ms) AS is_active
  FROM sized s JOIN ranged r ON s.topic = r.topic AND s.partition = r.partition AND s."offset" >= r.base
    AND (r.nxt IS NULL OR s."offset" < r.nxt)
  GROUP BY s.topic, s.partition, r.base),
judged AS (
  SELECT *, is_active OR (bool_or(is_active OR young) OVER (PARTITION BY topic, partition ORDER BY segment_base) AND fits) AS keep
  FROM (SELECT g.*, coalesce(g.last_ms >= 1706659200000 - l.ret_ms, true) AS young,
               coalesce(sum(CASE WHEN is_active THEN 0 ELSE n_bytes END)
                 OVER (PARTITION BY g.topic, g.partition ORDER BY segment_base DESC) <= l.ret_bytes, true) AS fits
        FROM segs g JOIN limits l ON g.topic = l.topic))"""
