"""Positions, members, delivery and topic lists on hand rows with known answers."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidelog.operators import filters, matching, positions, reports, routing
from tidelog.schemas import ORDER_V1, PAYMENT_V1, TOPIC
from tidelog.sources import generate, sinks, topics

COMMITS = "group_id string, topic string, partition int, committed bigint"
EDGES = "topic string, partition int, log_start bigint, log_end bigint"


def reset(spark, start, end, committed, policy):
    edges = spark.createDataFrame([("t", 0, start, end)], EDGES)
    commits = spark.createDataFrame([] if committed is None else [("g", "t", 0, committed)], COMMITS)
    subs = spark.createDataFrame([("g", "t")], "group_id string, topic string")
    r = positions.skipped(edges, commits, subs, policy).first()
    return r.resume, r.expired, r.passed_over


def test_reset_fixtures(spark):
    assert reset(spark, 8000, 15234, 3500, "earliest") == (8000, 4500, 0)
    assert reset(spark, 8000, 15234, 3500, "latest") == (15234, 4500, 7234)
    assert reset(spark, 0, 1000, None, "earliest") == (0, 0, 0)
    assert reset(spark, 0, 1000, None, "latest") == (1000, 0, 1000)
    assert reset(spark, 16, 30, 10, "earliest") == (16, 6, 0)
    assert reset(spark, 8000, 15234, 9000, "error") == (9000, 0, 0)
    assert reset(spark, 0, 10, 20, "earliest")[0] == 0  # a commit beyond the end is no commit
    for committed in (3500, None):
        with pytest.raises(PySparkException, match="OFFSET_OUT_OF_RANGE"):
            reset(spark, 8000, 15234, committed, "error")
    with pytest.raises(ValueError):
        reset(spark, 0, 1, 0, "newest")


def test_lag_fixtures(spark):
    ends = [("t", 0, 36), ("t", 1, 32), ("t", 2, 32)]
    log = spark.createDataFrame([(t, p, o) for t, p, n in ends for o in range(n)], "topic string, partition int, offset bigint")
    commits = spark.createDataFrame([("g", "t", 2, 20)], COMMITS)
    subs = spark.createDataFrame([("g", "t")], "group_id string, topic string")
    lag = positions.group_lag(log, commits, subs)
    assert [r.lag for r in lag.orderBy("partition").collect()] == [36, 32, 12]
    totals = {(r.group_id, r.topic, r.partition): r.lag for r in positions.lag_totals(lag).collect()}
    assert totals[("g", None, None)] == totals[("g", "t", None)] == 80
    commits = spark.createDataFrame([("g", "t", 0, 15)], COMMITS)
    done = commits.select("group_id", "topic", "partition", F.lit(20).cast("bigint").alias("processed"))
    again = positions.reprocessed(log, commits, done)
    assert sorted(r.offset for r in again.collect()) == [15, 16, 17, 18, 19]


def test_members(spark):
    partitions = spark.createDataFrame([("t", p) for p in range(3)], "topic string, partition int")
    log = partitions.withColumn("offset", F.lit(0))
    for n, idle in ((1, 0), (3, 0), (4, 1)):
        members = spark.createDataFrame([("g", "t", f"m{i}") for i in range(n)], "group_id string, topic string, member_id string")
        assignment = routing.assign_members(partitions, members)
        assert assignment.select("partition").distinct().count() == assignment.count() == 3
        totals = reports.member_totals(reports.member_report(log, assignment, members)).first()
        assert (totals.running, totals.idle) == (n, idle)


def test_null_keys_spread_evenly(spark):
    df = spark.range(30000).select("id", F.lit(None).cast("string").alias("key"))
    counts = [r["count"] for r in routing.assign_partition(df, "key", 3, "id").groupBy("partition").count().collect()]
    assert len(counts) == 3 and max(counts) - min(counts) < 1000


def test_ghost_topics_against_brute_force(spark):
    r = random.Random(5)

    def edit(name):
        for _ in range(r.randint(0, 4)):
            i = r.randint(0, len(name))
            name = r.choice([name[:i] + "x" + name[i:], name[:i] + name[i + 1 :], name[:i] + "y" + name[i + 1 :]])
        return name or "z"

    allowed = ["payment.processed", "order.created", "a", "ab", "order.paid", "x.y"]
    written = sorted({edit(r.choice(allowed)) for _ in range(300)} | {"payment.procesed"})
    log = spark.createDataFrame([(t,) for t in written], "topic string")
    names = spark.createDataFrame([(t,) for t in allowed], "topic string")
    for dist in (1, 2, 3):
        got = {(x.topic, x.nearest, x.distance) for x in matching.ghost_topics(log, names, dist).collect()}
        pairs = log.crossJoin(names.withColumnRenamed("topic", "nearest")).withColumn("d", F.levenshtein("topic", "nearest"))
        best = {}
        for x in pairs.collect():
            if x.topic not in allowed and x.d <= dist:
                best[x.topic] = min(best.get(x.topic, (99, "")), (x.d, x.nearest))
        want = {(t, best[t][1], best[t][0]) if t in best else (t, None, None) for t in written if t not in allowed}
        assert got == want


def test_duplicates_and_gap(spark):
    rows = [("t", 0, i, i % 50) for i in range(57)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset bigint, seq bigint")
    r = reports.duplicates(log, ["seq"]).first()
    assert (r.expected, r.on_log, r.extra) == (50, 57, 7)
    acked = spark.createDataFrame([("t", i) for i in range(47)], "topic string, seq bigint").withColumns(
        {"error": F.lit(None).cast("string"), "acked_at": F.current_timestamp()})
    r = reports.durability_gap(acked, log.where("offset < 43")).first()
    assert (r.confirmed, r.on_log, r.gap) == (47, 43, 4)


def test_capacity_and_empty_values(spark):
    config = spark.createDataFrame([("t", 3, 3, 5120)], "topic string, partitions int, replication int, retention_bytes bigint")
    assert {(r.topic, r.max_bytes, r.max_bytes_with_copies) for r in reports.capacity(config).collect()} == {
        ("t", 15360, 46080), (None, 15360, 46080)}
    from pyspark.sql import Observation

    df = spark.createDataFrame([(b"a",), (None,), (None,)], "value binary")
    seen = Observation()
    assert filters.drop_null_values(df, seen).count() == 1 and seen.get["skipped"] == 2


def test_publish_and_read_back(spark):
    from tidelog.scratch import fresh_path

    path = fresh_path(spark, "log")
    rows = generate.payload_rows(spark.range(50)).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.timestamp_millis("record").alias("timestamp"), "record",
    )
    first = sinks.publish(rows, "t", 3, ["timestamp", "key"])
    sinks.append(first, path)
    log = topics.read_topic(spark, ["t"], path=path)
    sinks.append(sinks.publish(rows, "t", 3, ["record"], positions.bounds(log), unique="record"), path)
    again = topics.read_topic(spark, ["t"], path=path)
    assert again.count() == 100
    ends = {r.partition: r.log_end for r in positions.bounds(again).collect()}
    for p, n in ends.items():
        assert sorted(r.offset for r in again.where(F.col("partition") == p).collect()) == list(range(n))
    restored = sinks.restore(log.where("offset < 5"), positions.bounds(again))
    assert {(r.partition, r.old_offset, r.offset - ends[r.partition]) for r in restored.collect()} == {
        (p, o, o) for p in ends for o in range(5)}


def test_report_text(spark):
    from tidelog.scratch import fresh_path
    from tidelog.schemas import ORDER_STATUS

    df = spark.createDataFrame([(0, 1, "customer-7", "Hub", 9, "eu"), (0, 0, "c", "x" * 30, 1, "")],
                               "partition int, offset bigint, customer_id string, item string, status int, region string")
    lines = sinks.report_lines(df, ORDER_STATUS, ["top"], ["{count} read"], F.col("region"))
    path = fresh_path(spark, "report")
    sinks.write_report(lines, path)
    text = [r.line for r in lines.orderBy("section", "partition", "offset").collect()]
    assert text[0] == "top" and text[-1] == "2 read" and len(text) == 7
    assert text[3] == "p=0         | 0      | c               | " + "x" * 30 + "| ORDER_STATUS_CREATED    | "
    assert "| ?                       | eu" in text[4]
    assert spark.read.text(path).count() == 7


def test_generators_repeat(spark):
    ids = spark.range(2000)
    orders = generate.gen_orders(ids)
    assert orders.exceptAll(generate.gen_orders(ids)).count() == 0
    r = orders.agg(F.min("amount"), F.max("amount"), F.countDistinct("item"), F.countDistinct("region"),
                   F.countDistinct("customer_id"), F.countDistinct("id"), F.min("status"), F.max("status")).first()
    assert r[0] >= 9.99 and r[1] <= 499.99 and tuple(r)[2:] == (10, 4, 50, 2000, 1, 3)
    p = generate.gen_payments(ids).agg(F.min("amount"), F.max("amount"), F.countDistinct("currency"), F.max("status")).first()
    assert p[0] >= 5 and p[1] <= 2000 and tuple(p)[2:] == (4, 4)


def test_topic_types_and_connector_options(spark):
    got = topics.topic_types({"order.v1.Order": ORDER_V1, "payment.v1.Payment": PAYMENT_V1}, [("order.created", "order.v1.Order")], spark).first()
    assert (got.topic, got.message) == ("order.created", "order.v1.Order") and "amount:double" in got.layout
    batch = topics.broker_options(["a", "b"], "host:1")
    assert batch["subscribe"] == "a,b" and batch["endingOffsets"] == "latest"
    stream = topics.broker_options(["a"], "host:1", streaming=True, max_per_trigger=5, fail_on_data_loss=False)
    assert stream["maxOffsetsPerTrigger"] == "5" and stream["failOnDataLoss"] == "false"


def test_seek_time_past_the_end(spark):
    log = spark.createDataFrame([("t", 0, 0, 0), ("t", 0, 1, 10)], "topic string, partition int, offset bigint, s bigint").withColumn("timestamp", F.timestamp_seconds("s"))
    subs = spark.createDataFrame([("g", "t")], "group_id string, topic string")
    at = lambda s: dt.datetime.fromtimestamp(s, dt.timezone.utc)
    assert positions.seek(log, subs, at(5)).first().committed == 1
    assert positions.seek(log, subs, at(50)).first().committed == 2


def test_log_schema():
    assert TOPIC.names == ["topic", "partition", "offset", "timestamp", "key", "value"]
