"""Aggregate reports over logs, deliveries and settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.operators.lookup import lookup
from tidelog.operators.positions import bounds
from tidelog.operators.settings import settings

ADDRESS = ["topic", "partition"]


def partition_spread(log: DataFrame) -> DataFrame:
    """AGG-2: records per partition, share of the topic, and share against an even spread."""
    counts = log.groupBy(*ADDRESS).agg(F.count("*").alias("n_records"))
    topic = Window.partitionBy("topic")
    share = F.col("n_records") / F.sum("n_records").over(topic)
    return counts.select(
        *ADDRESS, "n_records", share.alias("share"),
        (F.col("n_records") * F.count("*").over(topic) / F.sum("n_records").over(topic)).alias("skew"),
    )


def member_report(log: DataFrame, assignment: DataFrame, members: DataFrame) -> DataFrame:
    """AGG-3, SRT-2: partitions and records of every member, idle ones included."""
    counts = log.groupBy(*ADDRESS).agg(F.count("*").alias("n"))
    mine = assignment.join(counts, ADDRESS, "left")
    return (
        members.join(mine, ["group_id", "topic", "member_id"], "left")
        .groupBy("group_id", "topic", "member_id")
        .agg(
            F.sort_array(F.collect_set("partition")).alias("partitions"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_records"),
        )
        .withColumn("idle", F.size("partitions") == 0)
    )


def member_totals(report: DataFrame) -> DataFrame:
    """AGG-3: members running, active and idle per group."""
    return report.groupBy("group_id", "topic").agg(
        F.count("*").alias("running"),
        F.count_if(~F.col("idle")).alias("active"),
        F.count_if("idle").alias("idle"),
    )


def delivery_totals(delivery: DataFrame) -> DataFrame:
    """AGG-4: delivered and failed records per topic."""
    return delivery.groupBy("topic").agg(
        F.count_if(F.col("error").isNull()).alias("delivered"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def distinct_errors(delivery: DataFrame) -> DataFrame:
    """AGG-5: error texts that occur."""
    return delivery.where(F.col("error").isNotNull()).select("topic", "error").distinct()


def duplicates(log: DataFrame, identity: list[str]) -> DataFrame:
    """AGG-6: records on the log, distinct records, and extra copies, per topic.

    Copies of one record are counted map-side, so a record repeated without end is one
    partial row per task.
    """
    per_record = log.groupBy("topic", *identity).agg(F.count("*").alias("n"))
    return per_record.groupBy("topic").agg(
        F.count("*").alias("expected"),
        F.sum("n").cast("bigint").alias("on_log"),
        F.sum(F.col("n") - 1).cast("bigint").alias("extra"),
    )


def duplicate_records(log: DataFrame, identity: list[str]) -> DataFrame:
    """AGG-6: the records that are on the log more than once."""
    return (
        log.groupBy("topic", *identity).agg((F.count("*") - 1).alias("extra")).where("extra > 0")
    )


def durability_gap(delivery: DataFrame, log: DataFrame) -> DataFrame:
    """AGG-7: confirmed records against records on the log, per topic."""
    confirmed = (
        delivery.where(F.col("error").isNull() & F.col("acked_at").isNotNull())
        .groupBy("topic").agg(F.count("*").alias("confirmed"))
    )
    on_log = bounds(log).groupBy("topic").agg(F.sum("log_end").cast("bigint").alias("on_log"))
    n = F.coalesce("on_log", F.lit(0))
    return confirmed.join(on_log, "topic", "left").select(
        "topic", "confirmed", n.alias("on_log"),
        F.greatest(F.col("confirmed") - n, F.lit(0)).alias("gap"),
    )


def schema_mix(df: DataFrame, bucket: str = "1 day") -> DataFrame:
    """AGG-9: records per writer schema over time."""
    return df.groupBy("topic", F.window("timestamp", bucket).alias("w"), "schema_id").agg(
        F.count("*").alias("n_records")
    ).select("topic", F.col("w.start").alias("bucket"), "schema_id", "n_records")


def blank_rate(df: DataFrame, zeros: dict[str, object]) -> DataFrame:
    """AGG-10: share of zero values per field and writer schema.

    ``zeros`` maps each field to its zero value. One pass for all fields, unpivoted after
    the aggregate.
    """
    blank = [F.count_if(F.col(c).eqNullSafe(F.lit(z)) | F.col(c).isNull()).alias(c) for c, z in zeros.items()]
    counts = df.groupBy("schema_id").agg(F.count("*").alias("n_records"), *blank)
    return counts.unpivot(["schema_id", "n_records"], list(zeros), "field", "n_blank").withColumn(
        "blank_rate", F.col("n_blank") / F.col("n_records")
    )


def size_ratio(df: DataFrame, json: Column, encoded: Column) -> DataFrame:
    """AGG-11: bytes as JSON text against encoded bytes."""
    totals = df.select(F.octet_length(json).cast("bigint").alias("j"), encoded.cast("bigint").alias("e"))
    return totals.agg(
        F.sum("j").cast("bigint").alias("json_bytes"), F.sum("e").cast("bigint").alias("encoded_bytes")
    ).withColumn("ratio", F.col("json_bytes") / F.col("encoded_bytes"))


def delivery_stats(delivery: DataFrame) -> DataFrame:
    """AGG-12: messages, duration, rate and mean latency per linger setting."""
    sent, acked = F.unix_micros("sent_at"), F.unix_micros("acked_at")
    return (
        delivery.where(F.col("acked_at").isNotNull())
        .groupBy("linger_ms")
        .agg(
            F.count("*").alias("messages"),
            (F.max(acked) - F.min(sent)).alias("duration_us"),
            F.sum(acked - sent).cast("bigint").alias("latency_us"),
        )
        .select(
            "linger_ms", "messages", "duration_us",
            (F.col("messages") * 1000000 / F.col("duration_us")).alias("msg_per_s"),
            (F.col("latency_us") / F.col("messages")).alias("mean_latency_us"),
        )
    )


def capacity(config: DataFrame) -> DataFrame:
    """AGG-13: most bytes a topic can hold, and the total over all topics with copies."""
    held = F.col("partitions").cast("bigint") * F.col("retention_bytes")
    return config.select("topic", held.alias("h"), (held * F.col("replication")).alias("c")).rollup(
        "topic"
    ).agg(F.sum("h").cast("bigint").alias("max_bytes"), F.sum("c").cast("bigint").alias("max_bytes_with_copies"))


def effective_retention(log: DataFrame, config: DataFrame) -> DataFrame:
    """AGG-14: fill rate, time until a segment rolls, longest life of a record, per partition.

    A roll comes at the segment size or the segment age, whichever is first; a setting
    that is null or -1 does not apply, and a topic without settings has the broker's.
    """
    at = F.unix_millis("timestamp")
    filled = log.groupBy(*ADDRESS).agg(
        F.sum(F.octet_length("value")).cast("bigint").alias("n_bytes"),
        (F.max(at) - F.min(at)).alias("span_ms"),
    )
    by_size = F.when(F.col("n_bytes") > 0, F.col("segment_bytes") * F.col("span_ms") / F.col("n_bytes"))
    to_roll = F.least(by_size, F.col("segment_ms").cast("double"))
    limits = settings(filled, config, ["retention_ms", "segment_bytes", "segment_ms"])
    return filled.join(limits, "topic").select(
        *ADDRESS, "n_bytes", "span_ms",
        F.ceil(to_roll).alias("roll_ms"),
        (F.ceil(to_roll) + F.col("retention_ms")).alias("longest_life_ms"),
    )


def partition_advice(log: DataFrame, reader_rate: float, bucket: str = "1 hour") -> DataFrame:
    """AGG-15: partitions to create: peak records per bucket over what one reader handles, doubled."""
    counts = log.groupBy("topic", F.window("timestamp", bucket)).agg(F.count("*").alias("n"))
    return counts.groupBy("topic").agg(F.max("n").alias("peak")).withColumn(
        "partitions", (F.ceil(F.col("peak") / F.lit(reader_rate)) * 2).cast("int")
    )


def size_chain(log: DataFrame, limits: DataFrame) -> DataFrame:
    """AGG-16: first gate that is narrower than the one before it, and the first a record is too big for.

    ``limits(topic, max_request_size, message_max_bytes, replica_fetch_max_bytes,
    max_partition_fetch_bytes)``.
    """
    gates = ["max_request_size", "message_max_bytes", "replica_fetch_max_bytes", "max_partition_fetch_bytes"]
    narrower, too_big = F.lit(None).cast("string"), F.lit(None).cast("string")
    for wide, narrow in list(zip(gates, gates[1:]))[::-1]:
        narrower = F.when(F.col(narrow) < F.col(wide), F.lit(narrow)).otherwise(narrower)
    for gate in gates[::-1]:
        too_big = F.when(F.col("largest") > F.col(gate), F.lit(gate)).otherwise(too_big)
    seen = log.groupBy("topic").agg(F.max(F.octet_length("value")).alias("largest"))
    return limits.join(seen, "topic", "left").select(
        "topic", "largest", narrower.alias("narrower_gate"), too_big.alias("stuck_at"),
    )


def member_counts(log: DataFrame, assignment: DataFrame) -> DataFrame:
    """JN-5 with AGG-3: records each member reads."""
    return lookup(log, assignment, ADDRESS).groupBy("group_id", "member_id").agg(
        F.count("*").alias("n_records")
    )
