"""Topic logs and metadata tables computed from the driver's tables.

Every log is a rule over a whole table; ``sql.py`` states the same rules for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.encode import encode_topic
from tidelog.functions.wire import build_envelope
from tidelog.operators.ordering import assign_offsets
from tidelog.operators.positions import bounds
from tidelog.operators.routing import assign_partition
from tidelog.schemas import ORDER_V1
from tidelog.scratch import cut

PARTITIONS = 3
DEPLOY = "2024-01-16 00:00:00"
NOW_MS = 1706659200000  # 2024-01-31 00:00:00 UTC, just after the last event.
ADDRESS = ["topic", "partition", "offset"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as unpublished records of one topic."""
    e = table(spark, sf, "events").select(
        F.lit("events").alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        "event_id", "user_id", "event_type", F.col("value").alias("amount"),
    )
    return e


def events_log(spark: SparkSession, sf: str) -> DataFrame:
    """The events topic: key user, partition by key hash, offset by event id."""
    routed = assign_partition(raw_events(spark, sf), "key", PARTITIONS)
    return assign_offsets(routed, ["event_id"], unique="event_id")


def tombstone_log(spark: SparkSession, sf: str) -> DataFrame:
    """The events topic with null values on errors."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return events_log(spark, sf).withColumn("value", value)


def enveloped_log(spark: SparkSession, sf: str) -> DataFrame:
    """The events topic with enveloped values, schema 1 before the deploy and 2 after."""
    schema_id = F.when(F.col("timestamp") < F.lit(DEPLOY).cast("timestamp"), 1).otherwise(2)
    return events_log(spark, sf).withColumn("value", build_envelope(schema_id, F.col("value")))


def topic_per_type(spark: SparkSession, sf: str) -> DataFrame:
    """One topic per event type; purchases above 100 went to a misspelt topic."""
    typo = (F.col("event_type") == "purchase") & (F.col("amount") > 100)
    named = raw_events(spark, sf).withColumn(
        "topic", F.concat(F.lit("events."), F.when(typo, "purchse").otherwise(F.col("event_type")))
    )
    return assign_offsets(assign_partition(named, "key", PARTITIONS), ["event_id"], unique="event_id")


def allowed_topics(spark: SparkSession) -> DataFrame:
    names = ["events.click", "events.error", "events.purchase", "events.signup", "events.refund"]
    return spark.createDataFrame([(n,) for n in names], "topic string")


def subscriptions(spark: SparkSession) -> DataFrame:
    rows = [(g, "events") for g in ("a", "b", "c")]
    return spark.createDataFrame(rows, "group_id string, topic string")


def commits(edges: DataFrame) -> DataFrame:
    """Group a has read everything, group b half of it, group c nothing."""
    share = F.explode(F.array(
        F.struct(F.lit("a").alias("group_id"), F.col("log_end").alias("committed")),
        F.struct(F.lit("b").alias("group_id"), F.floor(F.col("log_end") / F.lit(2)).cast("bigint").alias("committed")),
    )).alias("c")
    return edges.select("topic", "partition", share).select("c.group_id", "topic", "partition", "c.committed")


def expired_edges(log: DataFrame) -> DataFrame:
    """Bounds of the log after three quarters of each partition have expired."""
    gone = (F.floor(F.col("log_end") / F.lit(4)) * 3).cast("bigint")
    return bounds(log).withColumn("log_start", gone)


def members(spark: SparkSession) -> DataFrame:
    rows = [("g", "events", f"member-{i}") for i in range(1, 5)]
    return spark.createDataFrame(rows, "group_id string, topic string, member_id string")


def producer_log(spark: SparkSession, sf: str) -> DataFrame:
    """The events topic as producers sent it: purchases are retried and stand at the end again.

    ``seq`` is the event id; a retry has the same sequence and a later offset.
    """
    sent = cut(events_log(spark, sf)).withColumn("producer_id", F.lit("p")).withColumn("seq", F.col("event_id"))
    ends = bounds(sent).select("topic", "partition", "log_end")
    again = sent.where("event_type = 'purchase'").withColumnRenamed("offset", "first_offset")
    again = assign_offsets(again, ["event_id"], unique="event_id")
    again = again.join(ends, ["topic", "partition"]).withColumn("offset", F.col("offset") + F.col("log_end"))
    return sent.unionByName(again.drop("first_offset", "log_end"))


def delivery(spark: SparkSession, sf: str) -> DataFrame:
    """A delivery report per event: signups above 100 failed."""
    failed = (F.col("event_type") == "signup") & (F.col("amount") > 100)
    late = F.round(F.col("amount") * 1000).cast("bigint")
    acked = F.timestamp_micros(F.unix_micros("timestamp") + late)
    return raw_events(spark, sf).select(
        F.lit("p").alias("producer_id"), "topic", F.col("event_id").alias("seq"), "key",
        F.col("timestamp").alias("sent_at"),
        F.when(~failed, acked).alias("acked_at"),
        F.when(failed & (F.col("amount") > 150), "BROKER_NOT_AVAILABLE").when(failed, "MESSAGE_TIMED_OUT").alias("error"),
        F.when(F.col("event_type").isin("view", "click"), 50).otherwise(0).alias("linger_ms"),
    )


def survived(spark: SparkSession, sf: str) -> DataFrame:
    """What is on the log of the delivery reports: failed ones are not, and views above 150 were lost."""
    kept = raw_events(spark, sf).where(
        ~((F.col("event_type") == "signup") & (F.col("amount") > 100))
        & ~((F.col("event_type") == "view") & (F.col("amount") > 150))
    ).withColumn("seq", F.col("event_id"))
    routed = assign_partition(kept, "key", PARTITIONS)
    return assign_offsets(routed, ["event_id"], unique="event_id")


def typed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as typed messages of ``order.created``, with their address."""
    o = table(spark, sf, "orders").withColumns({
        "topic": F.lit("order.created"), "key": F.col("o_orderkey").cast("string").cast("binary"),
    })
    # Addresses first: counting rows per partition must not wait for the joins.
    o = assign_offsets(assign_partition(o, "key", PARTITIONS), ["o_orderkey"], unique="o_orderkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    where = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    status = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "P", 2).when(
        F.col("o_orderstatus") == "F", 3
    ).otherwise(0)
    return o.join(where.select("c_custkey", "r_name"), F.col("o_custkey") == F.col("c_custkey"), "left").select(
        *ADDRESS, "key",
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("customer-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderpriority").alias("item"),
        F.col("o_totalprice").alias("amount"),
        status.alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.coalesce("r_name", F.lit("")).alias("region"),
    )


NEWER = "1998-01-01 00:00:00"


def order_topic(spark: SparkSession, sf: str) -> DataFrame:
    """``order.created`` as bytes: schema 1 with the region before 1998, schema 2 without it after."""
    typed = typed_orders(spark, sf)
    new = F.col("created_at") >= F.lit(NEWER).cast("timestamp")
    # An empty region takes no bytes, so one pass writes both schemas.
    region = F.when(~new, F.col("region")).otherwise(F.lit(""))
    rows = typed.withColumn("region", region).withColumn("schema_id", F.when(new, 2).otherwise(1))
    value = build_envelope(F.col("schema_id"), F.col("payload"))
    return encode_topic(rows, ORDER_V1).select(*ADDRESS, "timestamp", "key", value.alias("value"))


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """A registry: each customer is a subject, each of their orders a version."""
    from tidelog.operators.blocks import number_rows

    o = table(spark, sf, "orders").select(
        F.concat(F.lit("customer-"), F.col("o_custkey").cast("string"), F.lit("-value")).alias("subject"),
        F.col("o_orderkey"), F.col("o_orderstatus"),
    )
    return number_rows(o, ["subject"], ["o_orderkey"], "v", unique="o_orderkey").select(
        "subject", (F.col("v") + 1).cast("int").alias("version"),
        (F.col("o_orderkey") + 1).cast("int").alias("schema_id"),
        F.lit("Order").alias("message"), F.col("o_orderstatus").alias("status"),
    )


def fields(spark: SparkSession, sf: str) -> DataFrame:
    """Declared fields: the lines of an order; finished orders shift every name by one number."""
    # Lines are moved once, by schema id: that serves the grouping and the joins on the id.
    lines = table(spark, sf, "lineitem").withColumn("schema_id", (F.col("l_orderkey") + 1).cast("int")).repartition(
        "schema_id"
    ).groupBy("schema_id", "l_linenumber").agg(
        F.min("l_returnflag").alias("flag"), F.min("l_linestatus").alias("line"), F.max("l_tax").alias("tax")
    )
    o = table(spark, sf, "orders").select((F.col("o_orderkey") + 1).cast("int").alias("schema_id"), "o_orderstatus")
    kind = (
        F.when((F.col("flag") == "A") & (F.col("line") == "F"), "string")
        .when(F.col("flag") == "A", "bytes")
        .when((F.col("flag") == "N") & (F.col("line") == "F"), "int32")
        .when(F.col("flag") == "N", "int64")
        .when(F.col("line") == "F", "sint32")
        .otherwise("int32")
    )
    shift = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    return lines.join(o, "schema_id").select(
        "schema_id",
        F.col("l_linenumber").alias("field_no"),
        F.concat(F.lit("f"), (F.col("l_linenumber") + shift).cast("string")).alias("name"),
        kind.alias("type"),
        (F.col("tax") == 0.0).alias("reserved"),
    )


def topic_config(spark: SparkSession, cleanup: str = "delete") -> DataFrame:
    rows = [("events", PARTITIONS, 3, 10 * 86_400_000, 20_000, 2_000, 86_400_000, cleanup, 8)]
    return spark.createDataFrame(
        rows,
        "topic string, partitions int, replication int, retention_ms bigint, retention_bytes bigint, "
        "segment_bytes bigint, segment_ms bigint, cleanup_policy string, message_max_bytes bigint",
    )


def mixed_config(spark: SparkSession) -> DataFrame:
    """Topics per event type: clicks have limits, views have -1, the others have no row."""
    rows = [
        ("events.click", 10 * 86_400_000, 20_000, 2_000, 86_400_000, "compact,delete"),
        ("events.view", -1, -1, 2_000, 86_400_000, "delete"),
    ]
    return spark.createDataFrame(
        rows,
        "topic string, retention_ms bigint, retention_bytes bigint, segment_bytes bigint, segment_ms bigint, cleanup_policy string",
    )


def supplier_config(spark: SparkSession, sf: str) -> DataFrame:
    """Settings of one topic per supplier."""
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("supplier-"), F.col("s_suppkey").cast("string")).alias("topic"),
        (F.col("s_nationkey") + 1).cast("int").alias("partitions"),
        F.when(F.col("s_acctbal") < 0, 1).otherwise(3).alias("replication"),
        (F.col("s_suppkey") * 1024 + 5120).cast("bigint").alias("retention_bytes"),
    )
