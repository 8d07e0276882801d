"""Offsets, order checks, gaps and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.operators.blocks import BLOCK, before, number_rows
from tidelog.operators.lookup import lookup

ADDRESS = ["topic", "partition"]


def assign_offsets(
    df: DataFrame,
    order: list[str],
    base: DataFrame | None = None,
    unique: str | None = None,
    width: int = BLOCK,
) -> DataFrame:
    """WIN-1: dense offsets per partition, from 0 or from the log end of an existing log.

    ``base`` is ``bounds(log)``: only new rows are numbered on append.
    """
    numbered = number_rows(df, ADDRESS, order, "offset", unique, width)
    if base is None:
        return numbered
    ends = base.select(*ADDRESS, F.col("log_end").alias("_base"))
    return lookup(numbered, ends, ADDRESS, "left").withColumn(
        "offset", F.col("offset") + F.coalesce("_base", F.lit(0))
    ).drop("_base")


def reordered(df: DataFrame, seq: str = "seq", width: int = BLOCK) -> DataFrame:
    """WIN-2: records whose sequence is lower than one already before them in the log."""
    marked = before(
        df, ["producer_id", *ADDRESS], "offset", {"highest_before": ("max", seq)}, width
    )
    return marked.where(F.col("highest_before") > F.col(seq))


def lifecycle_breaks(
    df: DataFrame, rank: Column, status: str = "status", width: int = BLOCK
) -> DataFrame:
    """WIN-3: records whose status step is below the step their key had just before.

    ``rank`` orders the steps; rows where it is null are not lifecycle steps.
    """
    steps = df.withColumn("rank", rank).where(F.col("rank").isNotNull())
    steps = steps.withColumn("_step", F.struct("rank", F.col(status).alias("status")))
    seen = before(steps, [*ADDRESS, "key"], "offset", {"_prev": ("last", "_step")}, width)
    return (
        seen.where(F.col("_prev.rank") > F.col("rank"))
        .withColumn("previous", F.col("_prev.status"))
        .drop("_prev", "_step")
    )


def offset_gaps(df: DataFrame, width: int = BLOCK) -> DataFrame:
    """WIN-4: ranges of offsets missing inside the log."""
    seen = before(df.select(*ADDRESS, "offset"), ADDRESS, "offset", {"_prev": ("max", "offset")}, width)
    return seen.where(F.col("offset") - F.col("_prev") > 1).select(
        *ADDRESS,
        (F.col("_prev") + 1).alias("gap_start"),
        (F.col("offset") - 1).alias("gap_end"),
        (F.col("offset") - F.col("_prev") - 1).alias("missing"),
    )


def liveness_gaps(beats: DataFrame, timeout_ms: int = 45_000) -> DataFrame:
    """WIN-5: pauses between heartbeats of a member that are longer than the session timeout.

    Two beats inside one timeout-wide slot are never too far apart, so each slot is
    reduced to its first and last beat (map-side) and only slots are ordered.
    ``beats(member_id, timestamp)``.
    """
    wide = timeout_ms * 1000
    slots = (
        beats.select("member_id", F.unix_micros("timestamp").alias("_at"))
        .groupBy("member_id", F.expr(f"_at div {wide}L").alias("_slot"))
        .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    )
    last = F.lag("_last").over(Window.partitionBy("member_id").orderBy("_slot"))
    return (
        slots.withColumn("_prev", last)
        .where(F.col("_first") - F.col("_prev") > wide)
        .select(
            "member_id",
            F.timestamp_micros("_prev").alias("last_beat"),
            F.timestamp_micros("_first").alias("next_beat"),
            (F.col("_first") - F.col("_prev")).alias("gap_us"),
        )
    )


def lag_trend(snapshots: DataFrame) -> DataFrame:
    """WIN-6: change of lag from one snapshot to the next.

    ``snapshots(group_id, topic, partition, snapshot, lag)``, one row per group, partition
    and snapshot: positions, not records.
    """
    w = Window.partitionBy("group_id", *ADDRESS).orderBy("snapshot")
    return snapshots.withColumn("change", F.col("lag") - F.lag("lag").over(w)).withColumn(
        "growing", F.coalesce(F.col("change") > 0, F.lit(False))
    )


def log_order(df: DataFrame, within_tasks: bool = False) -> DataFrame:
    """SRT-1: by topic, partition, offset; over the whole table, or inside each task only."""
    by = [*ADDRESS, "offset"]
    return df.sortWithinPartitions(*by) if within_tasks else df.orderBy(*by)
