"""Queries over topic logs: scans, positions, routing, order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.operators import filters, matching, ordering, positions, reports, routing
from tidelog.operators.lookup import lookup
from tidelog.plans import derive as d
from tidelog.plans import sql as s
from tidelog.plans.catalog import query
from tidelog.sources import generate, sinks, topics

ADDRESS = ["topic", "partition", "offset"]


def _shown(df, *cols):
    """Address and payload in types that compare across engines."""
    return df.select(
        *ADDRESS, F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.unix_millis("timestamp").alias("ts_ms"), *cols,
    )


SHOWN = 'topic, partition, "offset", "key", "value", (epoch_us("timestamp") // 1000) AS ts_ms'


# Scans.


@query("topic_scan", f"WITH {s.LOG} SELECT {SHOWN} FROM log")
def topic_scan(spark, sf):
    return _shown(d.events_log(spark, sf))


@query("bounded_drain", f"WITH {s.LOG}, {s.BOUNDS} SELECT {SHOWN} FROM log JOIN bounds USING (topic, partition) WHERE \"offset\" < log_end // 2")
def bounded_drain(spark, sf):
    log = d.events_log(spark, sf)
    until = positions.bounds(log).withColumn("log_end", F.floor(F.col("log_end") / F.lit(2)).cast("bigint"))
    return _shown(topics.drain(log, until))


@query("read_first_n", f"WITH {s.LOG} SELECT {SHOWN} FROM log WHERE \"offset\" < 10")
def read_first_n(spark, sf):
    return _shown(topics.read_first(d.events_log(spark, sf), 10))


@query("read_first_topic", f"WITH {s.LOG} SELECT {SHOWN} FROM log ORDER BY topic, partition, \"offset\" LIMIT 25")
def read_first_topic(spark, sf):
    return _shown(topics.read_first(d.events_log(spark, sf), 25, per_partition=False))


@query(
    "offset_range",
    f"WITH {s.LOG}, {s.BOUNDS} SELECT {SHOWN} FROM log JOIN bounds USING (topic, partition) "
    'WHERE "offset" >= log_end // 4 AND "offset" < log_end // 2',
)
def offset_range(spark, sf):
    log = d.events_log(spark, sf)
    ranges = positions.bounds(log).select(
        "topic", "partition",
        F.floor(F.col("log_end") / F.lit(4)).cast("bigint").alias("from_offset"),
        F.floor(F.col("log_end") / F.lit(2)).cast("bigint").alias("to_offset"),
    )
    return _shown(topics.read_range(log, ranges))


@query(
    "offset_for_time",
    f"WITH {s.LOG} SELECT topic, partition, min(\"offset\") AS \"offset\" FROM log "
    f"WHERE \"timestamp\" >= TIMESTAMP '{d.DEPLOY}' GROUP BY topic, partition",
)
def offset_for_time(spark, sf):
    return topics.offset_for_time(d.events_log(spark, sf), d.DEPLOY)


@query("tiered_read", f"WITH {s.LOG} SELECT {SHOWN} FROM log")
def tiered_read(spark, sf):
    """Archive holds the first three quarters, the live log the last two: they overlap."""
    log = d.events_log(spark, sf)
    edges = positions.bounds(log).select("topic", "partition", "log_end")
    placed = lookup(log, edges, ["topic", "partition"])
    hot = placed.where(F.col("offset") >= F.floor(F.col("log_end") / F.lit(2))).drop("log_end")
    cold = placed.where(F.col("offset") < F.floor(F.col("log_end") / F.lit(4)) * 3).drop("log_end")
    return _shown(topics.read_tiered(hot, cold))


# Publishing.


@query(
    "publish_assign",
    f"WITH {s.LOG}, {s.BOUNDS} SELECT topic, partition, \"offset\" + log_end AS \"offset\", event_id "
    "FROM log JOIN bounds USING (topic, partition)",
)
def publish_assign(spark, sf):
    """The same events published again after the log they already form."""
    base = positions.bounds(d.events_log(spark, sf))
    rows = d.raw_events(spark, sf).drop("topic")
    out = sinks.publish(rows, "events", d.PARTITIONS, ["event_id"], base, unique="event_id")
    return out.select(*ADDRESS, "event_id")


@query(
    "delivery_report",
    f"WITH sent AS (SELECT {s.part(s.USER)} AS partition, event_id AS seq, octet_length(encode(props)) > 8 AS big FROM events) "
    "SELECT 'events' AS topic, partition, seq, CASE WHEN big THEN 'MESSAGE_TOO_LARGE' END AS error, "
    'CASE WHEN NOT big THEN row_number() OVER (PARTITION BY partition, big ORDER BY seq) - 1 END AS "offset" FROM sent',
)
def delivery_report(spark, sf):
    sent = routing.assign_partition(d.raw_events(spark, sf), "key", d.PARTITIONS).withColumn("seq", F.col("event_id"))
    out = sinks.delivery_report(sent, d.topic_config(spark))
    return out.select("topic", "partition", "seq", "offset", "error")


@query(
    "restore_offsets",
    f"WITH {s.LOG}, {s.BOUNDS} SELECT topic, partition, \"offset\" AS old_offset, \"offset\" + log_end AS \"offset\" "
    "FROM log JOIN bounds USING (topic, partition) WHERE \"offset\" < log_end // 2",
)
def restore_offsets(spark, sf):
    log = d.events_log(spark, sf)
    edges = positions.bounds(log)
    half = edges.withColumn("log_end", F.floor(F.col("log_end") / F.lit(2)).cast("bigint"))
    return sinks.restore(topics.drain(log, half), edges).select(*ADDRESS, "old_offset")


@query(
    "payload_rows",
    "SELECT event_id AS record, printf('msg-%04d', event_id) AS \"key\", printf('payload-%04d', event_id) AS \"value\" FROM events",
)
def payload_rows(spark, sf):
    return generate.payload_rows(d.table(spark, sf, "events"), "event_id")


def _draw(purpose: str, size: int, record: str = "o_orderkey") -> str:
    return f"(('0x' || substr(md5('42/{purpose}/' || {record}), 1, 8))::BIGINT % {size})::INTEGER"


def _uuid(purpose: str, record: str = "o_orderkey") -> str:
    h = f"md5('42/{purpose}/' || {record})"
    return " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def _one_of(values: list[str], purpose: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_draw(purpose, len(values))} + 1]"


@query(
    "gen_orders",
    f"SELECT o_orderkey AS record, {_uuid('order')} AS id, 'customer-' || ({_draw('customer', 50)} + 1) AS customer_id, "
    f"{_one_of(generate.ITEMS, 'item')} AS item, ({_draw('amount', 49001)} + 999)::DOUBLE / 100.0::DOUBLE AS amount, "
    f"{_draw('status', 3)} + 1 AS status, {_one_of(generate.REGIONS, 'region')} AS region FROM orders",
)
def gen_orders(spark, sf):
    return generate.gen_orders(d.table(spark, sf, "orders"), "o_orderkey")


@query(
    "gen_payments",
    f"SELECT o_orderkey AS record, {_uuid('payment')} AS payment_id, {_uuid('payment-order')} AS order_id, "
    f"'cust-' || ({_draw('customer', 200)} + 1) AS customer_id, "
    f"({_draw('amount', 199501)} + 500)::DOUBLE / 100.0::DOUBLE AS amount, {_one_of(generate.CURRENCIES, 'currency')} AS currency, "
    f"{_draw('status', 4)} + 1 AS status, {_one_of(generate.PROCESSORS, 'processor')} AS processor FROM orders",
)
def gen_payments(spark, sf):
    return generate.gen_payments(d.table(spark, sf, "orders"), "o_orderkey")


# Filters.


@query(
    "non_null_values",
    f"WITH {s.LOG} SELECT {SHOWN} FROM log WHERE event_type <> 'error'",
)
def non_null_values(spark, sf):
    return _shown(filters.drop_null_values(d.tombstone_log(spark, sf)))


@query(
    "event_kind",
    f"WITH {s.DELIVERY} SELECT CASE WHEN error IS NULL THEN 'data' ELSE 'error' END AS kind, count(*) AS n "
    "FROM delivery GROUP BY 1 UNION ALL SELECT 'eof', count(DISTINCT user_id) FROM events",
)
def event_kind(spark, sf):
    """Polled events: delivered and failed records, and one end mark per user's stream."""
    polled = d.delivery(spark, sf).select("error")
    ends = d.table(spark, sf, "events").select("user_id").distinct().select(F.lit("_PARTITION_EOF").alias("error"))
    return polled.unionByName(ends).groupBy(filters.event_kind("error").alias("kind")).agg(F.count("*").alias("n"))


@query(
    "oversize",
    f"WITH {s.LOG} SELECT topic, partition, \"offset\", CASE WHEN octet_length(encode(\"value\")) > 8 THEN 'MESSAGE_TOO_LARGE' END AS error FROM log",
)
def oversize(spark, sf):
    return filters.check_size(d.events_log(spark, sf), d.topic_config(spark)).select(*ADDRESS, "error")


@query("topics_like", f"WITH {s.TYPES} SELECT DISTINCT topic FROM log WHERE contains(topic, 'urch')")
def topics_like(spark, sf):
    return filters.topics_like(d.topic_per_type(spark, sf), "urch")


# Topic lists.


@query(
    "ghost_topics",
    f"WITH {s.TYPES}, {s.ALLOWED}, ghosts AS (SELECT topic, count(*) AS n_records FROM log "
    "WHERE topic NOT IN (SELECT topic FROM allowed) GROUP BY topic), near AS ("
    "SELECT g.topic, a.topic AS nearest, levenshtein(g.topic, a.topic) AS distance, "
    "row_number() OVER (PARTITION BY g.topic ORDER BY levenshtein(g.topic, a.topic), a.topic) AS r "
    "FROM ghosts g, allowed a WHERE levenshtein(g.topic, a.topic) <= 2) "
    "SELECT g.topic, g.n_records, n.nearest, n.distance::INTEGER AS distance FROM ghosts g "
    "LEFT JOIN near n ON g.topic = n.topic AND n.r = 1",
)
def ghost_topics(spark, sf):
    return matching.ghost_topics(d.topic_per_type(spark, sf), d.allowed_topics(spark), 2)


@query("silent_topics", f"WITH {s.TYPES}, {s.ALLOWED} SELECT topic FROM allowed WHERE topic NOT IN (SELECT topic FROM log)")
def silent_topics(spark, sf):
    return matching.silent_topics(d.allowed_topics(spark), d.topic_per_type(spark, sf))


# Bounds, spread, members.


@query("topic_bounds", f"WITH {s.LOG}, {s.BOUNDS} SELECT * FROM bounds")
def topic_bounds(spark, sf):
    return positions.bounds(d.events_log(spark, sf))


@query(
    "partition_spread",
    f"WITH {s.LOG}, c AS (SELECT topic, partition, count(*) AS n_records FROM log GROUP BY ALL) "
    "SELECT topic, partition, n_records, n_records / (sum(n_records) OVER (PARTITION BY topic))::BIGINT AS share, "
    "(n_records * count(*) OVER (PARTITION BY topic)) / (sum(n_records) OVER (PARTITION BY topic))::BIGINT AS skew FROM c",
)
def partition_spread(spark, sf):
    return reports.partition_spread(d.events_log(spark, sf))


ASSIGNED = """assigned AS (SELECT 'g' AS group_id, topic, partition, 'member-' || (partition % 4 + 1) AS member_id
  FROM (SELECT DISTINCT topic, partition FROM log))"""


@query("assign_members", f"WITH {s.LOG}, {ASSIGNED} SELECT * FROM assigned")
def assign_members(spark, sf):
    return routing.assign_members(d.events_log(spark, sf), d.members(spark))


@query(
    "member_counts",
    f"WITH {s.LOG}, {ASSIGNED} SELECT group_id, member_id, count(*) AS n_records FROM log JOIN assigned USING (topic, partition) GROUP BY ALL",
)
def member_counts(spark, sf):
    log = d.events_log(spark, sf)
    return reports.member_counts(log, routing.assign_members(log, d.members(spark)))


@query(
    "consume_by_member",
    f"WITH {s.LOG}, {ASSIGNED} SELECT topic, partition, \"offset\", member_id FROM log JOIN assigned USING (topic, partition)",
)
def consume_by_member(spark, sf):
    log = d.events_log(spark, sf)
    return matching.consume_by_member(log, routing.assign_members(log, d.members(spark))).select(*ADDRESS, "member_id")


MEMBERS = "members AS (SELECT 'g' AS group_id, 'events' AS topic, 'member-' || i AS member_id FROM range(1, 5) r(i))"
REPORT = f"""report AS (
  SELECT m.group_id, m.topic, m.member_id, coalesce(string_agg(a.partition::VARCHAR, ',' ORDER BY a.partition), '') AS partitions,
         coalesce(sum(c.n), 0)::BIGINT AS n_records, count(a.partition) = 0 AS idle
  FROM members m LEFT JOIN assigned a USING (group_id, topic, member_id)
  LEFT JOIN (SELECT topic, partition, count(*) AS n FROM log GROUP BY ALL) c ON c.topic = a.topic AND c.partition = a.partition
  GROUP BY m.group_id, m.topic, m.member_id)"""


@query("member_report", f"WITH {s.LOG}, {ASSIGNED}, {MEMBERS}, {REPORT} SELECT * FROM report")
def member_report(spark, sf):
    log, members = d.events_log(spark, sf), d.members(spark)
    out = reports.member_report(log, routing.assign_members(log, members), members)
    return out.withColumn("partitions", F.array_join(F.col("partitions").cast("array<string>"), ","))


@query(
    "member_totals",
    f"WITH {s.LOG}, {ASSIGNED}, {MEMBERS}, {REPORT} SELECT group_id, topic, count(*) AS running, "
    "count(*) FILTER (NOT idle) AS active, count(*) FILTER (idle) AS idle FROM report GROUP BY group_id, topic",
)
def member_totals(spark, sf):
    log, members = d.events_log(spark, sf), d.members(spark)
    return reports.member_totals(reports.member_report(log, routing.assign_members(log, members), members))


@query(
    "effective_retention",
    f"WITH {s.LOG}, f AS (SELECT topic, partition, sum(octet_length(encode(\"value\")))::BIGINT AS n_bytes, "
    "(epoch_us(max(\"timestamp\")) // 1000) - (epoch_us(min(\"timestamp\")) // 1000) AS span_ms FROM log GROUP BY ALL) "
    "SELECT *, ceil(least(2000 * span_ms / n_bytes, 86400000::DOUBLE))::BIGINT AS roll_ms, "
    "ceil(least(2000 * span_ms / n_bytes, 86400000::DOUBLE))::BIGINT + 864000000 AS longest_life_ms FROM f",
)
def effective_retention(spark, sf):
    return reports.effective_retention(d.events_log(spark, sf), d.topic_config(spark))


@query(
    "partition_advice",
    f"WITH {s.LOG} SELECT topic, max(n) AS peak, (ceil(max(n) / 7.0) * 2)::INTEGER AS partitions FROM ("
    "SELECT topic, date_trunc('hour', \"timestamp\") AS h, count(*) AS n FROM log GROUP BY ALL) GROUP BY topic",
)
def partition_advice(spark, sf):
    return reports.partition_advice(d.events_log(spark, sf), 7.0)


# Order.


@query("assign_offsets", f"WITH {s.LOG} SELECT partition, \"offset\", event_id FROM log")
def assign_offsets(spark, sf):
    """Offsets by time and key: an order no single column fixes."""
    routed = routing.assign_partition(d.raw_events(spark, sf), "key", d.PARTITIONS)
    return ordering.assign_offsets(routed, ["timestamp", "key"]).select("partition", "offset", "event_id")


@query("log_order", f"WITH {s.LOG} SELECT {SHOWN} FROM log")
def log_order(spark, sf):
    return ordering.log_order(_shown(d.events_log(spark, sf)))


@query(
    "offset_gaps",
    f"WITH {s.LOG} SELECT topic, partition, prev + 1 AS gap_start, \"offset\" - 1 AS gap_end, \"offset\" - prev - 1 AS missing FROM ("
    "SELECT *, lag(\"offset\") OVER (PARTITION BY topic, partition ORDER BY \"offset\") AS prev FROM log WHERE event_type <> 'view') "
    "WHERE \"offset\" - prev > 1",
)
def offset_gaps(spark, sf):
    return ordering.offset_gaps(d.events_log(spark, sf).where("event_type <> 'view'"))


LIFE = "CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 END"


def lifecycle_steps():
    return F.when(F.col("status") == "signup", 1).when(F.col("status") == "view", 2).when(F.col("status") == "purchase", 3)


@query(
    "lifecycle_breaks",
    f"WITH {s.LOG} SELECT topic, partition, \"offset\", \"key\", status, \"rank\", previous FROM ("
    "SELECT *, lag(\"rank\") OVER w AS prev_rank, lag(status) OVER w AS previous FROM ("
    f"SELECT *, event_type AS status, {LIFE} AS \"rank\" FROM log) WHERE \"rank\" IS NOT NULL "
    "WINDOW w AS (PARTITION BY topic, partition, \"key\" ORDER BY \"offset\")) WHERE prev_rank > \"rank\"",
)
def lifecycle_breaks(spark, sf):
    log = d.events_log(spark, sf).withColumnRenamed("event_type", "status")
    out = ordering.lifecycle_breaks(log, lifecycle_steps())
    return out.select(*ADDRESS, F.col("key").cast("string").alias("key"), "status", "rank", "previous")


@query(
    "liveness_gaps",
    "SELECT member_id, (epoch_us(prev) // 1000) AS last_ms, (epoch_us(ts) // 1000) AS next_ms, epoch_us(ts) - epoch_us(prev) AS gap_us FROM ("
    "SELECT user_id AS member_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events) "
    "WHERE epoch_us(ts) - epoch_us(prev) > 86400000000",
)
def liveness_gaps(spark, sf):
    beats = d.table(spark, sf, "events").select(F.col("user_id").alias("member_id"), F.col("ts").cast("timestamp").alias("timestamp"))
    return ordering.liveness_gaps(beats, 86_400_000).select(
        "member_id", F.unix_millis("last_beat").alias("last_ms"), F.unix_millis("next_beat").alias("next_ms"), "gap_us"
    )


SNAPSHOTS = """snap AS (
  SELECT topic, partition, day, (sum(n) OVER (PARTITION BY topic, partition ORDER BY day))::BIGINT AS log_end
  FROM (SELECT topic, partition, ((epoch_us("timestamp") // 1000) // 86400000) AS day, count(*) AS n FROM log GROUP BY ALL)),
lags AS (
  SELECT topic, partition, day, log_end,
         log_end - coalesce(lag(log_end, 2) OVER (PARTITION BY topic, partition ORDER BY day), 0) AS lag FROM snap)"""


@query(
    "lag_trend",
    f"WITH {s.LOG}, {SNAPSHOTS} SELECT 'late' AS group_id, topic, partition, day AS snapshot, lag, "
    "lag - lag(lag) OVER w AS change, coalesce(lag - lag(lag) OVER w > 0, false) AS growing FROM lags "
    "WINDOW w AS (PARTITION BY topic, partition ORDER BY day)",
)
def lag_trend(spark, sf):
    """A group that is always two days behind."""
    day = F.expr("unix_millis(timestamp) div 86400000L").alias("snapshot")
    counts = d.events_log(spark, sf).groupBy("topic", "partition", day).agg(F.count("*").alias("n"))
    w = Window.partitionBy("topic", "partition").orderBy("snapshot")
    ends = counts.withColumn("log_end", F.sum("n").over(w))
    lag = F.col("log_end") - F.coalesce(F.lag("log_end", 2).over(w), F.lit(0))
    snaps = ends.select(F.lit("late").alias("group_id"), "topic", "partition", "snapshot", lag.alias("lag"))
    return ordering.lag_trend(snaps)


# Set operations.


@query(
    "unfinished_partitions",
    f"WITH {s.LOG} SELECT DISTINCT topic, partition FROM log EXCEPT "
    f"SELECT topic, partition FROM log WHERE \"offset\" >= (SELECT count(*) // 3 FROM log)",
)
def unfinished_partitions(spark, sf):
    """Partitions without a record at the mean length of a partition have not come so far."""
    log = d.events_log(spark, sf)
    mean = log.agg(F.expr("count(*) div 3").alias("mean"))
    reached = log.join(F.broadcast(mean), F.col("offset") >= F.col("mean")).drop("mean")
    return matching.unfinished(log, reached)


@query(
    "missing_addresses",
    f"WITH {s.LOG} SELECT topic, partition, \"offset\" FROM log EXCEPT SELECT topic, partition, \"offset\" FROM log WHERE event_type <> 'view'",
)
def missing_addresses(spark, sf):
    log = d.events_log(spark, sf)
    return matching.missing_addresses(log, log.where("event_type <> 'view'"))


# Partitioning.


@query("key_partition", f"SELECT event_id, {s.part(s.USER)} AS partition FROM events")
def key_partition(spark, sf):
    return routing.assign_partition(d.raw_events(spark, sf), "key", d.PARTITIONS).select("event_id", "partition")


@query(
    "null_key_spread",
    f"SELECT event_id, CASE WHEN event_type <> 'error' THEN {s.part(s.USER)} "
    f"ELSE {s.part('event_id::VARCHAR')} END AS partition FROM events",
)
def null_key_spread(spark, sf):
    """Keyed records are where their key says, those without a key where their id says."""
    key = F.when(F.col("event_type") != "error", F.col("key"))
    out = routing.assign_partition(d.raw_events(spark, sf).withColumn("key", key), "key", d.PARTITIONS, "event_id")
    return out.select("event_id", "partition")


@query(
    "remap_audit",
    f"WITH k AS (SELECT {s.USER} AS k, count(*) AS n FROM events GROUP BY 1), "
    f"m AS (SELECT n, {s.part('k', 3)} <> {s.part('k', 4)} AS moved FROM k) "
    "SELECT count(*) AS n_keys, count(*) FILTER (moved) AS moved_keys, sum(n)::BIGINT AS n_records, "
    "coalesce(sum(n) FILTER (moved), 0)::BIGINT AS moved_records FROM m",
)
def remap_audit(spark, sf):
    return routing.remap(d.raw_events(spark, sf), "key", 3, 4)


@query(
    "route_counts",
    "SELECT CASE WHEN event_type = 'purchase' AND \"value\" > 0 THEN 'order.paid' WHEN event_type = 'view' THEN 'order.viewed' "
    "WHEN event_type = 'signup' THEN 'customer.created' ELSE 'dead.letter' END AS target_topic, count(*) AS n_records FROM events GROUP BY 1",
)
def route_counts(spark, sf):
    rules = [
        ((F.col("event_type") == "purchase") & (F.col("amount") > 0), "order.paid"),
        (F.col("event_type") == "view", "order.viewed"),
        (F.col("event_type") == "signup", "customer.created"),
    ]
    return routing.route(d.raw_events(spark, sf), rules, "dead.letter").groupBy("target_topic").agg(
        F.count("*").alias("n_records")
    )


# Positions.


@query(
    "group_lag",
    f"WITH {s.POSITIONS} SELECT *, log_end - coalesce(committed, log_start) AS lag FROM pos",
)
def group_lag(spark, sf):
    log = d.events_log(spark, sf)
    return positions.group_lag(log, d.commits(positions.bounds(log)), d.subscriptions(spark))


@query(
    "lag_totals",
    f"WITH {s.POSITIONS}, lags AS (SELECT *, log_end - coalesce(committed, log_start) AS lag FROM pos) "
    "SELECT group_id, topic, partition, sum(lag)::BIGINT AS lag FROM lags "
    "GROUP BY GROUPING SETS ((group_id, topic, partition), (group_id, topic), (group_id))",
)
def lag_totals(spark, sf):
    return positions.lag_totals(group_lag(spark, sf))


@query(
    "commit_positions",
    f"WITH {s.LOG}, {s.BOUNDS}, {s.COMMITS}, done AS (SELECT 'b' AS group_id, topic, partition, max(\"offset\") + 1 AS committed "
    f"FROM log WHERE \"timestamp\" < TIMESTAMP '2024-01-20' GROUP BY topic, partition) "
    "SELECT group_id, topic, partition, max(committed) AS committed FROM "
    "(SELECT * FROM commits UNION ALL SELECT * FROM done) GROUP BY ALL",
)
def commit_positions(spark, sf):
    log = d.events_log(spark, sf)
    batch = log.where(F.col("timestamp") < F.lit("2024-01-20").cast("timestamp"))
    return positions.commit(batch, "b", d.commits(positions.bounds(log)))


def _resume(policy):
    target = "log_start" if policy == "earliest" else "log_end"
    return f"CASE WHEN committed >= log_start AND committed <= log_end THEN committed ELSE {target} END"


def _resume_query(policy):
    @query(
        f"resume_{policy}",
        f"WITH {s.EXPIRED} SELECT group_id, topic, partition, committed, log_start, log_end, {_resume(policy)} AS resume FROM pos",
    )
    def resume(spark, sf):
        log = d.events_log(spark, sf)
        return positions.resume_from(
            d.expired_edges(log), d.commits(positions.bounds(log)), d.subscriptions(spark), policy
        )

    return resume


resume_earliest = _resume_query("earliest")
resume_latest = _resume_query("latest")


@query(
    "skipped_offsets",
    f"WITH {s.EXPIRED} SELECT group_id, topic, partition, {_resume('latest')} AS resume, "
    "greatest(log_start - coalesce(committed, 0), 0) AS expired, "
    f"greatest({_resume('latest')} - greatest(coalesce(committed, 0), log_start), 0) AS passed_over FROM pos",
)
def skipped_offsets(spark, sf):
    log = d.events_log(spark, sf)
    return positions.skipped(d.expired_edges(log), d.commits(positions.bounds(log)), d.subscriptions(spark), "latest")


def _seek_query(name, to, sql):
    @query(name, sql)
    def seek(spark, sf):
        return positions.seek(d.events_log(spark, sf), d.subscriptions(spark), to)

    return seek


for _name, _to, _target in (
    ("seek_start", "start", "log_start"),
    ("seek_end", "end", "log_end"),
    ("seek_offset", 100, "greatest(least(100, log_end), log_start)"),
):
    _seek_query(_name, _to, f"WITH {s.POSITIONS} SELECT group_id, topic, partition, {_target}::BIGINT AS committed FROM pos")
_seek_query(
    "seek_time", dt.datetime(2024, 1, 16, tzinfo=dt.timezone.utc),
    f"WITH {s.POSITIONS}, t AS (SELECT topic, partition, min(\"offset\") AS o FROM log WHERE \"timestamp\" >= TIMESTAMP '2024-01-16' GROUP BY ALL) "
    "SELECT group_id, topic, partition, coalesce(o, log_end) AS committed FROM pos LEFT JOIN t USING (topic, partition)",
)


def _processed(edges, share):
    return d.commits(edges).where("group_id = 'b'").drop("committed").join(edges, ["topic", "partition"]).select(
        "group_id", "topic", "partition", F.floor(F.col("log_end") * share).cast("bigint").alias("processed")
    )


@query(
    "reprocessed",
    f"WITH {s.LOG}, {s.BOUNDS} SELECT 'b' AS group_id, topic, partition, \"offset\" FROM log JOIN bounds USING (topic, partition) "
    'WHERE "offset" >= log_end // 2 AND "offset" < floor(log_end * 0.75::DOUBLE)',
)
def reprocessed(spark, sf):
    log = d.events_log(spark, sf)
    edges = positions.bounds(log)
    return positions.reprocessed(log, d.commits(edges), _processed(edges, 0.75)).select("group_id", *ADDRESS)


@query(
    "lost_on_crash",
    f"WITH {s.LOG}, {s.BOUNDS} SELECT 'b' AS group_id, topic, partition, \"offset\" FROM log JOIN bounds USING (topic, partition) "
    'WHERE "offset" >= floor(log_end * 0.25::DOUBLE) AND "offset" < log_end // 2',
)
def lost_on_crash(spark, sf):
    log = d.events_log(spark, sf)
    edges = positions.bounds(log)
    return positions.lost_on_crash(log, d.commits(edges), _processed(edges, 0.25)).select("group_id", *ADDRESS)
