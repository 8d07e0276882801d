"""Queries about segments, retention and compaction of the events topic."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import positions
from tidelog.operators import retention as ret
from tidelog.operators import segments as seg
from tidelog.plans import derive as d
from tidelog.plans import sql as s
from tidelog.plans.catalog import query

ADDRESS = ["topic", "partition", "offset"]


def _judged(spark, sf):
    config = d.topic_config(spark)
    return ret.judged(seg.segment_table(d.events_log(spark, sf), config, d.NOW_MS), config, d.NOW_MS)


@query("segment_table", f"WITH {s.SEGMENTS} SELECT * FROM segs")
def segment_table(spark, sf):
    return seg.segment_table(d.events_log(spark, sf), d.topic_config(spark), d.NOW_MS)


@query(
    "segments",
    f"WITH {s.SEGMENTS} SELECT l.topic, l.partition, l.\"offset\", g.segment_base, g.segment_id, g.is_active FROM log l JOIN segs g "
    'ON l.partition = g.partition AND l."offset" BETWEEN g.segment_base AND g.last_offset',
)
def segments(spark, sf):
    out = seg.segments(d.events_log(spark, sf), d.topic_config(spark), d.NOW_MS)
    return out.select(*ADDRESS, "segment_base", "segment_id", "is_active")


def _kept(rule):
    return (
        f"WITH {s.SEGMENTS} SELECT l.topic, l.partition, l.\"offset\" FROM log l JOIN judged g ON l.partition = g.partition "
        f'AND l."offset" BETWEEN g.segment_base AND g.last_offset WHERE g.{rule}'
    )


@query("retain_time", _kept("keep_time"))
def retain_time(spark, sf):
    log, config = d.events_log(spark, sf), d.topic_config(spark)
    table = seg.segment_table(log, config, d.NOW_MS)
    records = seg.segments(log, config, d.NOW_MS, table)
    return ret.retain_time(records, ret.judged(table, config, d.NOW_MS)).select(*ADDRESS)


@query("retain_bytes", _kept("keep_bytes"))
def retain_bytes(spark, sf):
    return ret.retain_bytes(d.events_log(spark, sf), _judged(spark, sf)).select(*ADDRESS)


@query("retain_both", _kept("keep"))
def retain_both(spark, sf):
    return ret.retain(d.events_log(spark, sf), _judged(spark, sf)).select(*ADDRESS)


@query(
    "log_start_after",
    f"WITH {s.SEGMENTS} SELECT *, log_start_after - log_start_before AS advanced FROM cleaned",
)
def log_start_after(spark, sf):
    return ret.log_start_after(_judged(spark, sf))


@query(
    "stranded_groups",
    f"WITH {s.SEGMENTS}, {s.BOUNDS}, {s.COMMITS} SELECT group_id, topic, partition, committed, log_start_after, "
    "log_start_after - committed AS behind FROM commits JOIN cleaned USING (topic, partition) WHERE committed < log_start_after",
)
def stranded_groups(spark, sf):
    return ret.stranded(_judged(spark, sf), d.commits(positions.bounds(d.events_log(spark, sf))))


@query(
    "archive_closed",
    f"WITH {s.SEGMENTS} SELECT l.topic, l.partition, count(*) AS archived FROM log l JOIN segs g "
    'ON l.partition = g.partition AND l."offset" BETWEEN g.segment_base AND g.last_offset WHERE NOT g.is_active GROUP BY ALL',
)
def archive_closed(spark, sf):
    from tidelog.scratch import fresh_path
    from tidelog.sources.sinks import archive

    path = fresh_path(spark, "archive")
    archive(seg.segments(d.events_log(spark, sf), d.topic_config(spark), d.NOW_MS), path)
    return spark.read.parquet(path).groupBy("topic", "partition").agg(F.count("*").alias("archived"))


def _shown(df):
    return df.select(
        *ADDRESS, F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.unix_millis("timestamp").alias("ts_ms"),
    )


LATEST = 'row_number() OVER (PARTITION BY topic, partition, "key" ORDER BY "offset" DESC) = 1'
SHOWN = 'topic, partition, "offset", "key", "value", (epoch_us("timestamp") // 1000) AS ts_ms'


@query("compact", f"WITH {s.LOG} SELECT {SHOWN} FROM log QUALIFY {LATEST}")
def compact(spark, sf):
    return _shown(ret.compact(d.events_log(spark, sf)))


@query(
    "compact_tombstones",
    f"WITH {s.LOG} SELECT {SHOWN.replace(chr(34) + 'value' + chr(34), 'v AS ' + chr(34) + 'value' + chr(34))} FROM ("
    f"SELECT * EXCLUDE (\"value\"), CASE WHEN event_type <> 'error' THEN \"value\" END AS v FROM log QUALIFY {LATEST}) "
    f"WHERE v IS NOT NULL OR (epoch_us(\"timestamp\") // 1000) >= {d.NOW_MS - 86_400_000}",
)
def compact_tombstones(spark, sf):
    return _shown(ret.compact(d.tombstone_log(spark, sf), d.NOW_MS))


@query(
    "compact_delete",
    f"WITH {s.SEGMENTS} SELECT {SHOWN} FROM (SELECT * FROM log QUALIFY {LATEST}) JOIN cleaned USING (topic, partition) "
    'WHERE "offset" >= log_start_after',
)
def compact_delete(spark, sf):
    return _shown(ret.clean(d.events_log(spark, sf), d.topic_config(spark, "compact,delete"), d.NOW_MS))
