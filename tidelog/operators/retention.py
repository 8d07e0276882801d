"""What a retention or compaction policy keeps, and whom it leaves behind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.operators.lookup import lookup, settled
from tidelog.operators.positions import bounds
from tidelog.operators.segments import segment_table
from tidelog.operators.settings import settings

ADDRESS = ["topic", "partition"]


def judged(table: DataFrame, config: DataFrame, now_ms: int) -> DataFrame:
    """Segments with ``keep_time``, ``keep_bytes`` and ``keep`` (RET-2, RET-3, RET-4).

    Works on the segment table only. A limit that is null keeps everything. ``keep``
    applies both rules, oldest first, so that what is left is one unbroken range.
    """
    limits = settings(table, config, ["retention_ms", "retention_bytes"])
    newest_first = Window.partitionBy(*ADDRESS).orderBy(F.desc("segment_base")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    oldest_first = Window.partitionBy(*ADDRESS).orderBy("segment_base").rowsBetween(
        Window.unboundedPreceding, 0
    )
    closed_bytes = F.when(F.col("is_active"), F.lit(0)).otherwise(F.col("n_bytes"))
    young = F.coalesce(F.col("last_ms") >= F.lit(now_ms) - F.col("retention_ms"), F.lit(True))
    fits = F.coalesce(F.sum(closed_bytes).over(newest_first) <= F.col("retention_bytes"), F.lit(True))
    return (
        table.join(limits, "topic")
        .withColumn("keep_time", F.col("is_active") | young)
        .withColumn("keep_bytes", F.col("is_active") | fits)
        .withColumn(
            "keep",
            F.col("is_active") | (F.max("keep_time").over(oldest_first) & F.col("keep_bytes")),
        )
        .drop("retention_ms", "retention_bytes")
    )


def retain_time(records: DataFrame, segs: DataFrame) -> DataFrame:
    """RET-2: records of segments the time rule keeps. ``records`` carry ``segment_base``."""
    kept = segs.where("keep_time").select(*ADDRESS, "segment_base")
    return lookup(records, kept, [*ADDRESS, "segment_base"], "left_semi")


def log_start_after(segs: DataFrame) -> DataFrame:
    """RET-5: log start of each partition before and after retention, and the advance."""
    kept = F.min(F.when(F.col("keep"), F.col("segment_base")))
    after = F.coalesce(kept, F.max("last_offset") + 1)
    return segs.groupBy(*ADDRESS).agg(
        F.min("segment_base").alias("log_start_before"),
        after.alias("log_start_after"),
        (F.max("last_offset") + 1).alias("log_end"),
    ).withColumn("advanced", F.col("log_start_after") - F.col("log_start_before"))


def _from_start(log: DataFrame, segs: DataFrame, rule: str) -> DataFrame:
    starts = log_start_after(segs.withColumn("keep", F.col(rule))).select(
        *ADDRESS, F.col("log_start_after").alias("_from")
    )
    return lookup(log, starts, ADDRESS).where(F.col("offset") >= F.col("_from")).drop("_from")


def retain_bytes(log: DataFrame, segs: DataFrame) -> DataFrame:
    """RET-3: records the size rule keeps: always the newest range of each partition."""
    return _from_start(log, segs, "keep_bytes")


def retain(log: DataFrame, segs: DataFrame) -> DataFrame:
    """RET-4: records left when either rule may delete; a filter on the new log start."""
    return _from_start(log, segs, "keep")


def stranded(segs: DataFrame, commits: DataFrame) -> DataFrame:
    """RET-6: groups whose position is below the new log start."""
    return (
        commits.join(log_start_after(segs).select(*ADDRESS, "log_start_after"), ADDRESS)
        .where(F.col("committed") < F.col("log_start_after"))
        .withColumn("behind", F.col("log_start_after") - F.col("committed"))
    )


def compact(
    log: DataFrame, now_ms: int | None = None, delete_retention_ms: int = 86_400_000
) -> DataFrame:
    """RET-7, RET-8: latest record per key, at its own offset.

    The newest offset of each key is found without payloads, by hash aggregates on both
    sides of the shuffle, so a key with a third of the log costs one row per task. The
    records at those addresses are then picked from the log: by broadcast if they are few.
    With ``now_ms``, tombstones older than ``delete_retention_ms`` go too.
    """
    newest = log.groupBy(*ADDRESS, "key").agg(F.max("offset").alias("offset")).select(*ADDRESS, "offset")
    few = settled(newest)
    address = [*ADDRESS, "offset"]
    kept = log.join(newest if few is None else F.broadcast(few), address, "left_semi").select(*log.columns)
    if now_ms is None:
        return kept
    old = F.unix_millis("timestamp") < F.lit(now_ms - delete_retention_ms)
    return kept.where(~(F.col("value").isNull() & old))


def clean(log: DataFrame, config: DataFrame, now_ms: int, delete_retention_ms: int = 86_400_000) -> DataFrame:
    """RET-9: each topic cleaned by its own policy: delete, compact, or both."""
    policy = settings(log, config, ["cleanup_policy"])
    table = segment_table(log, config, now_ms)
    segs = judged(table, config, now_ms)
    deletes = F.col("cleanup_policy").contains("delete")
    starts = log_start_after(segs).join(policy, "topic").select(
        *ADDRESS, "cleanup_policy",
        F.when(deletes, F.col("log_start_after")).otherwise(F.col("log_start_before")).alias("_from"),
    )
    placed = lookup(log, starts, ADDRESS)
    compacts = F.col("cleanup_policy").contains("compact")
    # A superseded record goes even when its successor is deleted too, so the newest
    # record of a key is looked for in the whole log and the start is applied afterwards.
    plain = placed.where(~compacts & (F.col("offset") >= F.col("_from")))
    newest = compact(placed.where(compacts), now_ms, delete_retention_ms).where(
        F.col("offset") >= F.col("_from")
    )
    return plain.unionByName(newest).drop("cleanup_policy", "_from")


def expired_before(log: DataFrame, segs: DataFrame) -> DataFrame:
    """RET-5 with AGG-1: bounds of a log after retention."""
    return bounds(retain(log, segs))
