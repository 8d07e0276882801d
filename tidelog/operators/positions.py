"""Log bounds, group positions, lag, resume points and replayed or skipped ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.lookup import lookup

ADDRESS = ["topic", "partition"]


def bounds(log: DataFrame) -> DataFrame:
    """AGG-1: log start and log end of each partition; one map-side reduced aggregate."""
    return log.groupBy(*ADDRESS).agg(
        F.min("offset").alias("log_start"), (F.max("offset") + 1).alias("log_end")
    )


def positions(edges: DataFrame, commits: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Each subscribed group on each partition, with its commit where it has one."""
    return edges.join(subscriptions, "topic").join(commits, ["group_id", *ADDRESS], "left")


def group_lag(log: DataFrame, commits: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """AGG-8, OFF-7: lag of every group on every partition of its topics.

    The log is reduced to one row per partition before any join.
    """
    return positions(bounds(log), commits, subscriptions).select(
        "group_id", *ADDRESS, "log_start", "log_end", "committed",
        (F.col("log_end") - F.coalesce("committed", "log_start")).alias("lag"),
    )


def lag_totals(lag: DataFrame) -> DataFrame:
    """AGG-8: lag per partition, per topic and per group in one pass (nulls mark totals)."""
    g, t, p = F.col("group_id"), F.col("topic"), F.col("partition")
    return lag.groupingSets([[g, t, p], [g, t], [g]], g, t, p).agg(
        F.sum("lag").cast("bigint").alias("lag")
    )


def commit(batch: DataFrame, group: str, commits: DataFrame | None = None) -> DataFrame:
    """OFF-1: next offset per partition after a batch, never moving a position back."""
    done = batch.groupBy(*ADDRESS).agg((F.max("offset") + 1).alias("committed"))
    mine = done.select(F.lit(group).alias("group_id"), *ADDRESS, "committed")
    if commits is None:
        return mine
    return commits.unionByName(mine).groupBy("group_id", *ADDRESS).agg(
        F.max("committed").alias("committed")
    )


def _resume(at: DataFrame, policy: str) -> DataFrame:
    if policy not in ("earliest", "latest", "error"):
        raise ValueError(f"unknown reset policy: {policy}")
    valid = (F.col("committed") >= F.col("log_start")) & (F.col("committed") <= F.col("log_end"))
    if policy == "error":
        fallback = F.raise_error(F.lit("OFFSET_OUT_OF_RANGE")).cast("bigint")
    else:
        fallback = F.col("log_start" if policy == "earliest" else "log_end")
    return at.withColumn("resume", F.when(F.coalesce(valid, F.lit(False)), F.col("committed")).otherwise(fallback))


def resume_from(
    edges: DataFrame, commits: DataFrame, subscriptions: DataFrame, policy: str
) -> DataFrame:
    """OFF-2: where each group goes on; the policy fires only without a valid commit.

    ``edges`` is ``bounds(log)``, taken once so that ``latest`` means one moment.
    """
    return _resume(positions(edges, commits, subscriptions), policy).select(
        "group_id", *ADDRESS, "committed", "log_start", "log_end", "resume"
    )


def skipped(
    edges: DataFrame, commits: DataFrame, subscriptions: DataFrame, policy: str
) -> DataFrame:
    """OFF-3: offsets gone before they were read, and offsets jumped although still there."""
    at = _resume(positions(edges, commits, subscriptions), policy)
    c = F.coalesce("committed", F.lit(0))
    return at.select(
        "group_id", *ADDRESS, "resume",
        F.greatest(F.col("log_start") - c, F.lit(0)).alias("expired"),
        F.greatest(F.col("resume") - F.greatest(c, F.col("log_start")), F.lit(0)).alias("passed_over"),
    )


def seek(
    log: DataFrame, subscriptions: DataFrame, to: str | int | dt.datetime
) -> DataFrame:
    """OFF-4: new positions of all subscribed groups at start, end, an offset or a time."""
    edges = bounds(log)
    if isinstance(to, dt.datetime):
        # First offset at the moment, in the same pass as the bounds.
        first = F.min(F.when(F.col("timestamp") >= F.lit(to), F.col("offset")))
        edges = log.groupBy(*ADDRESS).agg(F.coalesce(first, F.max("offset") + 1).alias("_at"))
        target = F.col("_at")
    elif to == "start":
        target = F.col("log_start")
    elif to == "end":
        target = F.col("log_end")
    else:
        target = F.greatest(F.least(F.lit(int(to)).cast("bigint"), F.col("log_end")), F.col("log_start"))
    return edges.join(subscriptions, "topic").select(
        "group_id", *ADDRESS, target.alias("committed")
    )


def _between(log: DataFrame, at: DataFrame, low: str, high: str) -> DataFrame:
    inside = (F.col("offset") >= F.col(low)) & (F.col("offset") < F.col(high))
    return lookup(log, at, ADDRESS).where(inside)


def reprocessed(log: DataFrame, commits: DataFrame, processed: DataFrame) -> DataFrame:
    """OFF-5: records read again after a crash, offsets ``[committed, processed)``.

    ``processed(group_id, topic, partition, processed)`` is the next offset not yet handled.
    """
    at = processed.join(commits, ["group_id", *ADDRESS])
    return _between(log, at, "committed", "processed")


def lost_on_crash(log: DataFrame, commits: DataFrame, processed: DataFrame) -> DataFrame:
    """OFF-6: records never handled when the commit ran ahead, offsets ``[processed, committed)``."""
    at = processed.join(commits, ["group_id", *ADDRESS])
    return _between(log, at, "processed", "committed")
