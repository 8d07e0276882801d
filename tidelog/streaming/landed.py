"""Streams over landed logs: where they begin, what was lost, and how far behind they are.

A file source knows files, not offsets. Positions are therefore tables beside the stream: the
start of each partition is written once, and each micro-batch writes what it reached under its
own number, so that a batch that runs again replaces its row and counts once. These tables
have one row per partition and batch, whatever the records are.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.operators.blocks import number_rows
from tidelog.operators.lookup import lookup, settled
from tidelog.operators.ordering import offset_gaps
from tidelog.operators.positions import bounds
from tidelog.schemas import TOPIC
from tidelog.sources.topics import INTERVALS, read_range, read_topic, within
from tidelog.streaming.consume import Sink

ADDRESS = ["topic", "partition"]
_REACHED = "topic string, partition int, first bigint, past bigint, batch_id bigint"
_LOST = "topic string, partition int, lost_from bigint, lost_to bigint, batch_id bigint"
_ENDS = "topic string, partition int, log_end bigint, at bigint"
_SLICES = "topic string, partition int, from_offset bigint, to_offset bigint, number bigint, batch_id bigint"
# Files that a budgeted stream plans at once, and repeats at most when it is cut off.
FILES = 1_000


class DataLoss(Exception):
    """Offsets that a stream had still to read are gone (STR-8)."""


def _table(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """A table of positions; one that nobody has written has no rows."""
    try:
        return spark.read.schema(columns).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], columns)


def start_positions(log: DataFrame, place: str, reset: str = "earliest", commits: DataFrame | None = None) -> DataFrame:
    """SRC-1: ``topic, partition, from_offset``, settled when the stream first starts.

    A partition with a commit in ``commits (topic, partition, committed)`` that the log still
    holds, or that is its end, begins there; others begin at the ``earliest`` or ``latest``
    offset of this moment, or fail (``error``). Written to ``place`` once: a stream that
    starts again reads its positions there. Partitions that come later begin at 0.
    """
    if reset not in ("earliest", "latest", "error"):
        raise ValueError(f"unknown reset policy: {reset}")
    spark, columns = log.sparkSession, "topic string, partition int, from_offset bigint"
    path = f"{place}/start"
    try:
        return spark.read.schema(columns).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    edges = bounds(log)
    none = spark.createDataFrame([], "topic string, partition int, committed bigint")
    at = edges.join((commits if commits is not None else none).select(*ADDRESS, "committed"), ADDRESS, "left")
    valid = F.coalesce(F.col("committed").between(F.col("log_start"), F.col("log_end")), F.lit(False))
    other = F.raise_error(F.lit("OFFSET_OUT_OF_RANGE")).cast("bigint") if reset == "error" else F.col("log_start" if reset == "earliest" else "log_end")
    at.select(*ADDRESS, F.when(valid, F.col("committed")).otherwise(other).alias("from_offset")).write.parquet(path)
    return spark.read.schema(columns).parquet(path)


def read_from(spark: SparkSession, topics: list[str], path: str, starts: DataFrame, max_per_trigger: int | None = None) -> DataFrame:
    """SRC-1: the stream of a landed log from ``start_positions`` on."""
    stream = read_topic(spark, topics, path=path, streaming=True, max_per_trigger=max_per_trigger)
    few = settled(starts)
    placed = stream.join(F.broadcast(few) if few is not None else starts, ADDRESS, "left")
    return placed.where(F.col("offset") >= F.coalesce("from_offset", F.lit(0))).drop("from_offset")


def _reached(spark: SparkSession, place: str, starts: DataFrame, batch_id: int) -> DataFrame:
    """The next offset of each partition before a batch."""
    earlier = _table(spark, f"{place}/reached", _REACHED).where(F.col("batch_id") < batch_id)
    both = starts.select(*ADDRESS, F.col("from_offset").alias("next")).unionByName(earlier.select(*ADDRESS, F.col("past").alias("next")))
    return both.groupBy(*ADDRESS).agg(F.max("next").alias("next"))


def guarded(sink: Sink, place: str, starts: DataFrame, fail_on_data_loss: bool = True) -> Sink:
    """STR-8: a sink that first compares the offsets of a batch with those it should go on from.

    What is missing is the difference of two sets of offset intervals: from the next offset of
    each partition to the end of the batch, less the ranges that the batch holds. With
    ``fail_on_data_loss`` the stream stops before the sink sees the batch; otherwise the
    ranges are kept in ``lost_ranges`` and it goes on. For logs that land in order and are not
    compacted, as compaction leaves holes on purpose.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = batch.select(*ADDRESS, "offset")
        span = held.groupBy(*ADDRESS).agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("past"))
        span.write.mode("overwrite").parquet(f"{place}/reached/batch_id={batch_id}")
        now = _table(spark, f"{place}/reached", _REACHED).where(F.col("batch_id") == batch_id).drop("batch_id")
        ahead = now.join(_reached(spark, place, starts, batch_id), ADDRESS, "left").withColumn("next", F.coalesce("next", F.lit(0)))
        front = ahead.where("first > next").select(*ADDRESS, F.col("next").alias("lost_from"), F.col("first").alias("lost_to"))
        inside = offset_gaps(held).select(*ADDRESS, F.col("gap_start").alias("lost_from"), (F.col("gap_end") + 1).alias("lost_to"))
        front.unionByName(inside).write.mode("overwrite").parquet(f"{place}/lost/batch_id={batch_id}")
        if fail_on_data_loss:
            gone = lost_ranges(spark, place).where(F.col("batch_id") == batch_id).orderBy(*ADDRESS, "lost_from").limit(5).collect()
            if gone:
                raise DataLoss("; ".join(f"{r.topic}-{r.partition} [{r.lost_from}, {r.lost_to})" for r in gone))
        sink(batch, batch_id)

    return write


def lost_ranges(spark: SparkSession, place: str) -> DataFrame:
    """``topic, partition, lost_from, lost_to, batch_id`` that a guarded stream found missing."""
    return _table(spark, f"{place}/lost", _LOST)


def addresses(spark: SparkSession, topics: list[str], path: str, files: int = FILES) -> DataFrame:
    """SRC-3: the stream that ``budgeted`` plans on: addresses and their files, no payload."""
    stream = spark.readStream.schema(TOPIC).option("maxFilesPerTrigger", files).parquet(path)
    return stream.where(F.col("topic").isin(topics)).select(*ADDRESS, "offset", F.col("_metadata.file_path").alias("file"))


def _slices(held: DataFrame, max_records: int, per_partition: bool) -> DataFrame:
    """``topic, partition, from_offset, to_offset, slice``: offset ranges of the budgets, in order."""
    sizes = held.groupBy(*ADDRESS).agg(F.count("*").alias("_n"), (F.max("offset") + 1).alias("_past"))
    earlier = Window.orderBy(*ADDRESS).rowsBetween(Window.unboundedPreceding, -1)
    start = F.lit(0) if per_partition else F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    ranked = number_rows(held.select(*ADDRESS, "offset"), ADDRESS, ["offset"], "_rank", unique="offset")
    placed = lookup(ranked, sizes.withColumn("_start", start).drop("_n"), ADDRESS).withColumn("_pos", F.col("_rank") + F.col("_start"))
    # Only the first record of each slice is left, so the window below sees few rows.
    cuts = placed.where((F.col("_pos") % max_records == 0) | (F.col("_rank") == 0))
    after = F.lead("offset").over(Window.partitionBy(*ADDRESS).orderBy("offset"))
    return cuts.select(
        *ADDRESS, F.col("offset").alias("from_offset"), F.coalesce(after, "_past").alias("to_offset"),
        F.expr(f"_pos div {int(max_records)}L").alias("slice"),
    )


def budgeted(sink: Sink, path: str, place: str, max_records: int, per_partition: bool = True) -> Sink:
    """SRC-3: a sink for ``addresses`` that hands on the landed records in batches of ``max_records``.

    A file source counts files. Here the addresses of the new files are ranked in order of
    offset, and every ``max_records``-th one is where a batch begins: of each partition, or
    of the whole topic in log order. Batches are full but the last of a plan, whatever the
    sizes of the files, their overlaps, and holes in the offsets. ``sink`` gets the records
    of a batch, read from the files that hold its offsets alone, and its number. The plan is
    kept beside the stream; a stream that is cut off repeats its last plan under the same numbers, so
    a sink that replaces by number holds each record once. An address may land once only.
    """
    if max_records < 1:
        raise ValueError("a batch has at least one record")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = _table(spark, f"{place}/slices", _SLICES)
        last = known.where(F.col("batch_id") < batch_id).agg(F.max("number")).first()[0]
        base = 0 if last is None else last + 1
        planned = _slices(batch, max_records, per_partition).withColumn("number", F.col("slice") + base).drop("slice")
        planned.write.mode("overwrite").parquet(f"{place}/slices/batch_id={batch_id}")
        mine = spark.read.schema(_SLICES).parquet(f"{place}/slices/batch_id={batch_id}").drop("batch_id")
        spread = batch.groupBy(*ADDRESS, "file").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
        spread.write.mode("overwrite").parquet(f"{place}/files/batch_id={batch_id}")
        spread = spark.read.parquet(f"{place}/files/batch_id={batch_id}")
        top = mine.agg(F.max("number")).first()[0]
        for number in range(base, base if top is None else top + 1):
            ranges = mine.where(F.col("number") == number).drop("number")
            touched = spread.join(ranges, ADDRESS).where("lo < to_offset and hi >= from_offset").select("file").distinct()
            files = [r.file for r in touched.collect()]
            records = spark.read.schema(TOPIC).option("basePath", path).parquet(*files)
            few = ranges.select(*ADDRESS, F.col("from_offset").alias("lo"), F.col("to_offset").alias("hi")).limit(INTERVALS + 1).collect()
            sink(records.where(within(few)) if len(few) <= INTERVALS else read_range(records, ranges), number)

    return write


def tracked(sink: Sink, place: str) -> Sink:
    """STR-10: a sink that then writes the highest offset of each partition under its batch number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        done = batch.groupBy(*ADDRESS).agg((F.max("offset") + 1).alias("log_end")).withColumn("at", F.lit(time.time_ns() // 1000))
        done.write.mode("overwrite").parquet(f"{place}/progress/batch_id={batch_id}")

    return write


def record_ends(log: DataFrame, place: str) -> None:
    """Append the ends of the log at this moment to the snapshots beside a stream."""
    ends = bounds(log).select(*ADDRESS, "log_end").withColumn("at", F.lit(time.time_ns() // 1000))
    ends.write.mode("append").parquet(f"{place}/ends")


def landed_lag(spark: SparkSession, place: str, group: str) -> DataFrame:
    """STR-10: ``group_id, topic, partition, snapshot, committed, log_end, lag`` at each ``record_ends``.

    As-of join: each snapshot of the ends meets the last batch that had ended by then, both on
    one line of time per partition. The shape fits ``lag_trend``; snapshots count from 0.
    """
    ends = _table(spark, f"{place}/ends", _ENDS).withColumn("committed", F.lit(None).cast("bigint"))
    progress = _table(spark, f"{place}/progress", _ENDS).select(
        *ADDRESS, F.lit(None).cast("bigint").alias("log_end"), "at", F.col("log_end").alias("committed")
    )
    line = Window.partitionBy(*ADDRESS).orderBy("at", F.col("log_end").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    met = ends.unionByName(progress).withColumn("committed", F.coalesce(F.max("committed").over(line), F.lit(0)))
    moments = ends.select("at").distinct().withColumn("snapshot", F.row_number().over(Window.orderBy("at")) - 1)
    return met.where(F.col("log_end").isNotNull()).join(moments, "at").select(
        F.lit(group).alias("group_id"), *ADDRESS, F.col("snapshot").cast("bigint").alias("snapshot"), "committed", "log_end",
        (F.col("log_end") - F.col("committed")).alias("lag"),
    )


def sessions(beats: DataFrame, timeout_ms: int = 45_000, watermark: str = "1 hour") -> DataFrame:
    """WIN-5: ``member_id, first_beat, last_beat`` of the runs of heartbeats without a long pause.

    ``beats(member_id, timestamp)``. On a stream the runs are session windows: a late beat
    that stands between two open runs makes them one, and a run is given when the watermark has
    passed its end, so beats may be late by ``watermark``.
    """
    if beats.isStreaming:
        beats = beats.withWatermark("timestamp", watermark)
    # Beats that are exactly the timeout apart still belong together.
    window = F.session_window("timestamp", f"{timeout_ms * 1000 + 1} microseconds")
    return beats.groupBy("member_id", window).agg(F.min("timestamp").alias("first_beat"), F.max("timestamp").alias("last_beat")).drop("session_window")


def session_gaps(runs: DataFrame) -> DataFrame:
    """WIN-5: the pauses between the sessions of each member, as ``liveness_gaps`` gives them."""
    prev = F.lag("last_beat").over(Window.partitionBy("member_id").orderBy("first_beat"))
    return runs.withColumn("prev", prev).where("prev is not null").select(
        "member_id", F.col("prev").alias("last_beat"), F.col("first_beat").alias("next_beat"),
        (F.unix_micros("first_beat") - F.unix_micros("prev")).alias("gap_us"),
    )
