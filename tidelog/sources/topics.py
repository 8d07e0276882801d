"""Reading topics: from a broker, from a landed log, and parts of either."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.operators.lookup import lookup, settled
from tidelog.schemas import TOPIC, Field

ADDRESS = ["topic", "partition"]
# Disjoint intervals that a scan is asked for one by one.
INTERVALS = 64


def read_topic(
    spark: SparkSession,
    topics: list[str],
    path: str | None = None,
    servers: str | None = None,
    reset: str = "earliest",
    streaming: bool = False,
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """SRC-1: records with their address, as a bounded table or a stream.

    With ``path`` the topic is a landed log: parquet with the ``TOPIC`` columns, laid out
    by topic and partition. With ``servers`` it is read through the Kafka connector.
    ``max_per_trigger`` counts records of a broker, but files of a landed log, where
    ``streaming.landed.budgeted`` counts records (SRC-3).
    ``fail_on_data_loss`` is STR-8: stop, or go on, when offsets have expired. On a landed log
    ``reset="latest"`` and the check for lost offsets need tables beside the stream, which
    ``streaming.landed`` keeps (``start_positions``, ``read_from``, ``guarded``); here they are
    refused rather than ignored.
    """
    if path is not None:
        if reset != "earliest" or not fail_on_data_loss:
            raise ValueError("on a landed log use start_positions, read_from and guarded of tidelog.streaming.landed")
        reader = spark.readStream if streaming else spark.read
        if streaming and max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.schema(TOPIC).parquet(path).where(F.col("topic").isin(topics))
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(
        **broker_options(topics, servers, reset, streaming, max_per_trigger, fail_on_data_loss)
    )
    return reader.load().select(*TOPIC.names)


def broker_options(
    topics: list[str],
    servers: str,
    reset: str = "earliest",
    streaming: bool = False,
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Connector options of a topic scan; a batch scan ends where the log ends now (SRC-2)."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": reset,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if not streaming:
        options["endingOffsets"] = "latest"
    elif max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def drain(topic: DataFrame, until: DataFrame) -> DataFrame:
    """SRC-2: every record below the given ends; ``until`` is ``bounds(log)`` at one moment."""
    ends = _once(until.select(*ADDRESS, F.col("log_end").alias("_end")))
    near = _reachable(topic, ends, None, "_end")
    return lookup(near, ends, ADDRESS).where(F.col("offset") < F.col("_end")).drop("_end")


def _once(table: DataFrame) -> DataFrame:
    few = settled(table)
    return table if few is None else few


def merged(ranges: DataFrame, low: str | None, high: str) -> DataFrame:
    """``topic, partition, lo, hi``: the ranges as disjoint intervals, by one sweep in order of their starts."""
    spans = ranges.select(*ADDRESS, (F.col(low) if low else F.lit(0)).cast("bigint").alias("lo"), F.col(high).cast("bigint").alias("hi"))
    order = Window.partitionBy(*ADDRESS).orderBy("lo", "hi")
    far = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("far").isNull() | (F.col("lo") > F.col("far")), 1).otherwise(0)
    swept = spans.where("hi > lo").withColumn("far", far).withColumn("run", F.sum(opens).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return swept.groupBy(*ADDRESS, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run")


def _reachable(df: DataFrame, ranges: DataFrame, low: str | None, high: str) -> DataFrame:
    """The records in any of the ranges, or around them if they are many.

    The bounds are literals, so a landed log leaves out the folders, files and row groups
    that no range touches, also between two that lie far apart. More than ``INTERVALS``
    disjoint intervals become the one box that holds them all. Rows that are left too many
    find no partner in the join that follows.
    """
    intervals = merged(ranges, low, high)
    few = settled(intervals, INTERVALS)
    if few is None:
        row = intervals.agg(
            *[F.min(c).alias(f"lo_{c}") for c in ADDRESS], *[F.max(c).alias(f"hi_{c}") for c in ADDRESS],
            F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        ).first()
        for c in ADDRESS:
            df = df.where(F.col(c).between(F.lit(row[f"lo_{c}"]), F.lit(row[f"hi_{c}"])))
        return df.where((F.col("offset") >= F.lit(row["lo"])) & (F.col("offset") < F.lit(row["hi"])))
    return df.where(within(few.collect()))


def within(intervals: list[Row]) -> Column:
    """Whether a record lies in one of a few intervals ``topic, partition, lo, hi``, as literals for the scan."""
    inside = F.lit(False)
    for r in intervals:
        here = (F.col("topic") == F.lit(r.topic)) & (F.col("partition") == F.lit(r.partition))
        inside = inside | (here & (F.col("offset") >= F.lit(r.lo)) & (F.col("offset") < F.lit(r.hi)))
    return inside


def read_first(df: DataFrame, n: int, per_partition: bool = True) -> DataFrame:
    """SRC-3: the first ``n`` records of each partition, or of the whole topic in log order.

    Each task keeps only its own first ``n`` before the shuffle.
    """
    if not per_partition:
        return df.orderBy(*ADDRESS, "offset").limit(n)
    order = Window.partitionBy(*ADDRESS).orderBy("offset")
    return df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")


def read_range(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """SRC-4: records with ``from_offset <= offset < to_offset`` of their partition."""
    inside = (F.col("offset") >= F.col("from_offset")) & (F.col("offset") < F.col("to_offset"))
    ranges = _once(ranges)
    near = _reachable(df, ranges, "from_offset", "to_offset")
    return lookup(near, ranges, ADDRESS).where(inside).drop("from_offset", "to_offset")


def offset_for_time(df: DataFrame, moment: dt.datetime | str) -> DataFrame:
    """SRC-5: first offset at or after a moment, per partition."""
    at = F.lit(moment).cast("timestamp")
    return df.where(F.col("timestamp") >= at).groupBy(*ADDRESS).agg(F.min("offset").alias("offset"))


def read_tiered(hot: DataFrame, cold: DataFrame) -> DataFrame:
    """SRC-6: archive and live log as one log.

    Where the live log is one unbroken range, the archive adds what lies outside it: a
    filter on two numbers per partition. Only partitions with holes, as compaction leaves
    them, are compared address by address.
    """
    edges = hot.groupBy(*ADDRESS).agg(
        F.min("offset").alias("_lo"), F.max("offset").alias("_hi"), F.count("*").alias("_n")
    )
    outside = F.col("_lo").isNull() | (F.col("offset") < F.col("_lo")) | (F.col("offset") > F.col("_hi"))
    holes = F.col("_n") < F.col("_hi") - F.col("_lo") + 1
    placed = lookup(cold, edges, ADDRESS, "left")
    held = lookup(hot.select(*ADDRESS, "offset"), edges.where(holes).select(*ADDRESS), ADDRESS, "left_semi")
    between = placed.where(~outside & holes).join(held, [*ADDRESS, "offset"], "left_anti")
    only_cold = placed.where(outside).unionByName(between).drop("_lo", "_hi", "_n")
    return hot.unionByName(only_cold)


def read_tiered_compacted(hot: DataFrame, cold: DataFrame) -> DataFrame:
    """SRC-6 for a live log with holes: addresses are compared one by one."""
    address = [*ADDRESS, "offset"]
    return hot.unionByName(cold.join(hot.select(*address), address, "left_anti"))


def topic_types(messages: dict[str, list[Field]], mapping: Iterable[tuple[str, str]], spark: SparkSession) -> DataFrame:
    """SRC-7: message type and typed layout of each mapped topic, for layouts that are stated in code.

    ``sources.descriptors.topic_types`` reads them from the registry's descriptor bytes.
    """
    from tidelog.schemas import struct_of

    rows = [(topic, name, struct_of(messages[name]).simpleString()) for topic, name in mapping]
    return spark.createDataFrame(rows, "topic string, message string, layout string")
