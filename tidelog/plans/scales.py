"""Queries that take the paths of long logs: blocks, levels and salts in small units.

Their twins are those of the queries with the usual units.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import ordering, positions
from tidelog.operators import registry as reg
from tidelog.operators import segments as seg
from tidelog.operators.lookup import lookup
from tidelog.operators.routing import assign_partition
from tidelog.plans import derive as d
from tidelog.plans import sql as s
from tidelog.plans.catalog import ORACLES, query
from tidelog.plans.logs import lifecycle_steps

ADDRESS = ["topic", "partition", "offset"]


@query("segments_levels", ORACLES["segment_table"])
def segments_levels(spark, sf):
    return seg.segment_table(d.events_log(spark, sf), d.topic_config(spark), d.NOW_MS, leaf=256, fan=4)


@query("offsets_blocks", ORACLES["assign_offsets"])
def offsets_blocks(spark, sf):
    routed = assign_partition(d.raw_events(spark, sf), "key", d.PARTITIONS)
    return ordering.assign_offsets(routed, ["event_id"], unique="event_id", width=64).select("partition", "offset", "event_id")


@query("offsets_ranges", ORACLES["assign_offsets"])
def offsets_ranges(spark, sf):
    """Placed by a range shuffle, as where no number is known to be unique."""
    routed = assign_partition(d.raw_events(spark, sf), "key", d.PARTITIONS)
    return ordering.assign_offsets(routed, ["event_id"]).select("partition", "offset", "event_id")


@query("reordered_blocks", ORACLES["reordered"])
def reordered_blocks(spark, sf):
    return ordering.reordered(d.producer_log(spark, sf), width=64).select("topic", "partition", "offset", "seq", "highest_before")


@query("gaps_blocks", ORACLES["offset_gaps"])
def gaps_blocks(spark, sf):
    return ordering.offset_gaps(d.events_log(spark, sf).where("event_type <> 'view'"), width=64)


@query("lifecycle_blocks", ORACLES["lifecycle_breaks"])
def lifecycle_blocks(spark, sf):
    log = d.events_log(spark, sf).withColumnRenamed("event_type", "status")
    out = ordering.lifecycle_breaks(log, lifecycle_steps(), width=64)
    return out.select(*ADDRESS, F.col("key").cast("string").alias("key"), "status", "rank", "previous")


@query("compat_blocks", ORACLES["compat_matrix"])
def compat_blocks(spark, sf):
    return reg.compat(d.registry(spark, sf), d.fields(spark, sf), width=2)


@query(
    "lookup_salted",
    f'WITH {s.LOG}, {s.BOUNDS} SELECT topic, partition, "offset", event_id, log_end FROM log JOIN bounds USING (topic, partition)',
)
def lookup_salted(spark, sf):
    """No table counts as small, so that the hot partitions are salted."""
    log = d.events_log(spark, sf)
    ends = positions.bounds(log).select("topic", "partition", "log_end")
    return lookup(log, ends, ["topic", "partition"], rows=0).select(*ADDRESS, "event_id", "log_end")
