"""Queries over delivery reports and logs with retried, lost or reordered records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import matching, ordering, reports
from tidelog.plans import derive as d
from tidelog.plans import sql as s
from tidelog.plans.catalog import query
from tidelog.streaming.state import dedupe_retries as drop_retries


@query(
    "lost_records",
    f"WITH {s.DELIVERY} SELECT topic, seq, linger_ms FROM delivery WHERE error IS NULL AND acked_us IS NOT NULL "
    "AND seq NOT IN (SELECT seq FROM survived)",
)
def lost_records(spark, sf):
    return matching.lost_records(d.delivery(spark, sf), d.survived(spark, sf), ["topic", "seq"]).select(
        "topic", "seq", "linger_ms"
    )


@query(
    "delivery_totals",
    f"WITH {s.DELIVERY} SELECT topic, count(*) FILTER (error IS NULL) AS delivered, count(error) AS failed FROM delivery GROUP BY topic",
)
def delivery_totals(spark, sf):
    return reports.delivery_totals(d.delivery(spark, sf))


@query("distinct_errors", f"WITH {s.DELIVERY} SELECT DISTINCT topic, error FROM delivery WHERE error IS NOT NULL")
def distinct_errors(spark, sf):
    return reports.distinct_errors(d.delivery(spark, sf))


@query(
    "duplicates",
    f"WITH {s.PRODUCED} SELECT topic, count(DISTINCT seq) AS expected, count(*) AS on_log, "
    "count(*) - count(DISTINCT seq) AS extra FROM produced GROUP BY topic",
)
def duplicates(spark, sf):
    return reports.duplicates(d.producer_log(spark, sf), ["producer_id", "seq"])


@query(
    "duplicate_records",
    f"WITH {s.PRODUCED} SELECT topic, seq, count(*) - 1 AS extra FROM produced GROUP BY topic, seq HAVING count(*) > 1",
)
def duplicate_records(spark, sf):
    return reports.duplicate_records(d.producer_log(spark, sf), ["producer_id", "seq"]).drop("producer_id")


@query(
    "durability_gap",
    f"WITH {s.DELIVERY} SELECT 'events' AS topic, c AS confirmed, n AS on_log, greatest(c - n, 0) AS gap FROM "
    "(SELECT count(*) FILTER (error IS NULL AND acked_us IS NOT NULL) AS c FROM delivery), (SELECT count(*) AS n FROM survived)",
)
def durability_gap(spark, sf):
    return reports.durability_gap(d.delivery(spark, sf), d.survived(spark, sf))


@query(
    "delivery_stats",
    f"WITH {s.DELIVERY} SELECT linger_ms, count(*) AS messages, max(acked_us) - min(epoch_us(sent_at)) AS duration_us, "
    "count(*) * 1000000 / (max(acked_us) - min(epoch_us(sent_at))) AS msg_per_s, "
    "sum(acked_us - epoch_us(sent_at))::BIGINT / count(*) AS mean_latency_us FROM delivery WHERE acked_us IS NOT NULL GROUP BY linger_ms",
)
def delivery_stats(spark, sf):
    return reports.delivery_stats(d.delivery(spark, sf))


@query(
    "reordered",
    f"WITH {s.PRODUCED} SELECT topic, partition, \"offset\", seq, highest_before FROM (SELECT *, "
    "max(seq) OVER (PARTITION BY partition ORDER BY \"offset\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest_before "
    "FROM produced) WHERE highest_before > seq",
)
def reordered(spark, sf):
    return ordering.reordered(d.producer_log(spark, sf)).select("topic", "partition", "offset", "seq", "highest_before")


@query(
    "dedupe_retries",
    f"WITH {s.PRODUCED} SELECT topic, partition, seq, min(\"offset\") AS \"offset\" FROM produced GROUP BY topic, partition, seq",
)
def dedupe_retries(spark, sf):
    return drop_retries(d.producer_log(spark, sf)).select("topic", "partition", "seq", "offset")


@query(
    "capacity",
    "WITH c AS (SELECT 'supplier-' || s_suppkey AS topic, (s_nationkey + 1) * (s_suppkey * 1024 + 5120) AS held, "
    "CASE WHEN s_acctbal < 0 THEN 1 ELSE 3 END AS r FROM supplier) "
    "SELECT topic, sum(held)::BIGINT AS max_bytes, sum(held * r)::BIGINT AS max_bytes_with_copies FROM c GROUP BY ROLLUP (topic)",
)
def capacity(spark, sf):
    return reports.capacity(d.supplier_config(spark, sf))


@query(
    "size_chain",
    "WITH l AS (SELECT 'supplier-' || s_suppkey AS topic, s_suppkey, 30 + s_nationkey AS g1, 40 + s_nationkey % 3 * 10 - 10 AS g2, "
    "40 + s_nationkey AS g3, 35 + s_nationkey * 2 AS g4 FROM supplier), "
    "v AS (SELECT l_suppkey, max(octet_length(encode(l_returnflag || '/' || l_partkey || '/' || l_orderkey)) * (1 + l_linenumber)) AS largest "
    "FROM lineitem GROUP BY l_suppkey) "
    "SELECT topic, largest::INTEGER AS largest, CASE WHEN g2 < g1 THEN 'message_max_bytes' WHEN g3 < g2 THEN 'replica_fetch_max_bytes' "
    "WHEN g4 < g3 THEN 'max_partition_fetch_bytes' END AS narrower_gate, "
    "CASE WHEN largest > g1 THEN 'max_request_size' WHEN largest > g2 THEN 'message_max_bytes' "
    "WHEN largest > g3 THEN 'replica_fetch_max_bytes' WHEN largest > g4 THEN 'max_partition_fetch_bytes' END AS stuck_at "
    "FROM l LEFT JOIN v ON s_suppkey = l_suppkey",
)
def size_chain(spark, sf):
    """One topic per supplier; its records are the order lines, as repeated text."""
    log = d.table(spark, sf, "lineitem").select(
        F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")).alias("topic"),
        F.expr("repeat(concat_ws('/', l_returnflag, cast(l_partkey as string), cast(l_orderkey as string)), 1 + l_linenumber)").cast("binary").alias("value"),
    )
    nation = F.col("s_nationkey")
    limits = d.table(spark, sf, "supplier").select(
        F.concat(F.lit("supplier-"), F.col("s_suppkey").cast("string")).alias("topic"),
        (nation + 30).alias("max_request_size"),
        (F.lit(30) + nation % 3 * 10).alias("message_max_bytes"),
        (nation + 40).alias("replica_fetch_max_bytes"),
        (nation * 2 + 35).alias("max_partition_fetch_bytes"),
    )
    return reports.size_chain(log, limits)
