"""Segments against a plain loop, and the retention rules on hand rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.operators import retention as ret
from tidelog.operators import segments as seg
from tidelog.plans import derive

DAY = 86_400_000
NOW = 1_700_000_000_000


def fold(size, ts, seg_bytes, seg_ms):
    """Segment start of each record, one record after the other."""
    out, start, held = [], None, 0
    for i, (z, t) in enumerate(zip(size, ts)):
        if start is None or held >= seg_bytes or t - ts[start] >= seg_ms:
            start, held = i, 0
        out.append(start)
        held += z
    return out


def tables(offset, size, ts, seg_bytes, seg_ms, leaf, fan):
    """The block steps of ``segment_table`` run by hand, without a session."""
    frame = pd.DataFrame({"offset": offset, "size": size, "ts": ts, "seg_bytes": seg_bytes, "seg_ms": seg_ms})
    frame["node"] = frame["offset"] // leaf
    levels = [pd.concat([seg._leaf(("t", 0, k), g) for k, g in frame.groupby("node")])]
    while levels[-1]["node"].max() >= fan:
        groups = levels[-1].groupby(levels[-1]["node"] // fan)
        levels.append(pd.concat([seg._combine(("t", 0, k), g) for k, g in groups]))
    top = levels[-1].assign(in_base=-1, in_size=seg_bytes, in_ts=-seg.NO_LIMIT)
    states = seg._hand_down(("t", 0, 0), top)
    for level in levels[-2::-1]:
        given_ = states.rename(columns={"node": "parent"})[["parent", "in_base", "in_size", "in_ts"]]
        joined = level.assign(parent=level["node"] // fan).merge(given_, on="parent")
        states = pd.concat([seg._hand_down(("t", 0, k), g) for k, g in joined.groupby("parent")])
    joined = frame.merge(states[["node", "in_base", "in_size", "in_ts"]], on="node")
    parts = pd.concat([seg._cut_block(("t", 0, k), g) for k, g in joined.groupby("node")])
    return parts.groupby("segment_base").agg(n=("n", "sum"), n_bytes=("n_bytes", "sum"), last=("to_offset", "max"))


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 30), st.integers(-5, 40), st.integers(1, 4)), min_size=1, max_size=120),
    st.integers(1, 120), st.one_of(st.integers(1, 300), st.just(seg.NO_LIMIT)),
    st.integers(1, 12), st.integers(2, 4),
)
def test_blocks_equal_fold(records, seg_bytes, seg_ms, leaf, fan):
    size = np.array([r[0] for r in records])
    ts = np.cumsum([r[1] for r in records])
    offset = np.cumsum([r[2] for r in records]) - records[0][2]
    want = [int(offset[i]) for i in fold(size.tolist(), ts.tolist(), seg_bytes, seg_ms)]
    got = tables(offset, size, ts, seg_bytes, seg_ms, leaf, fan)
    bases = sorted(set(want))
    assert list(got.index) == bases
    assert got["n"].tolist() == [want.count(b) for b in bases]


def topic(spark, rows):
    df = spark.createDataFrame(rows, "partition int, offset bigint, ms bigint, key string, size int")
    return df.select(
        F.lit("events").alias("topic"), "partition", "offset", F.timestamp_millis("ms").alias("timestamp"),
        F.col("key").cast("binary").alias("key"), F.expr("cast(repeat('x', size) as binary)").alias("value"),
    )


def config(spark, **settings_):
    base = {"retention_ms": None, "retention_bytes": None, "segment_bytes": None, "segment_ms": None, "cleanup_policy": "delete"}
    row = ("events", *{**base, **settings_}.values())
    return spark.createDataFrame(
        [row], "topic string, retention_ms bigint, retention_bytes bigint, segment_bytes bigint, segment_ms bigint, cleanup_policy string"
    )


def test_levels_on_spark(spark):
    log = derive.events_log(spark, "/root/testdata/sf0.001")
    settings_ = derive.topic_config(spark)
    flat = seg.segment_table(log, settings_, derive.NOW_MS)
    deep = seg.segment_table(log, settings_, derive.NOW_MS, leaf=8, fan=3)
    order = ["partition", "segment_base"]
    assert flat.count() > 50
    assert deep.orderBy(order).collect() == flat.orderBy(order).collect()


def test_slow_roll_without_age(spark):
    """5 MB an hour into 1 GiB segments, kept for one hour: about 200 hours, then gone at about 201."""
    hour = 3_600_000
    rows = [(0, i, i * hour, "k", 5) for i in range(210)]
    cfg = config(spark, segment_bytes=1024, retention_ms=hour)
    table = seg.segment_table(topic(spark, rows), cfg, 205 * hour).orderBy("segment_base").collect()
    assert [(r.segment_base, r.is_active) for r in table] == [(0, False), (205, True)]


def test_size_retention_cap(spark):
    rows = [(0, i, NOW, f"key-{i}", 180) for i in range(100)]
    cfg = config(spark, segment_bytes=512, retention_bytes=5120)
    log = topic(spark, rows)
    segs = ret.judged(seg.segment_table(log, cfg, NOW), cfg, NOW)
    closed = segs.where("keep_bytes and not is_active").agg(F.sum("n_bytes")).first()[0]
    assert 5120 - 540 < closed <= 5120
    kept = ret.retain_bytes(log, segs).agg(F.min("offset"), F.max("offset"), F.count("*")).first()
    assert kept[1] == 99 and kept[2] == 99 - kept[0] + 1


def test_time_retention_by_last_record(spark):
    at = lambda d, h, m=0: int(dt.datetime(2026, 6, d, h, m, tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [(0, 0, at(13, 8), "a", 9), (0, 1, at(13, 23, 59), "b", 9), (0, 2, at(14, 0), "c", 9),
            (0, 3, at(14, 23, 59), "d", 9), (0, 4, at(15, 9), "e", 9)]
    cfg = config(spark, segment_bytes=18, retention_ms=DAY)
    log = topic(spark, rows)
    segs = ret.judged(seg.segment_table(log, cfg, at(15, 10)), cfg, at(15, 10))
    assert sorted(r.offset for r in ret.retain(log, segs).collect()) == [2, 3, 4]
    assert ret.log_start_after(segs).first().log_start_after == 2
    commits = spark.createDataFrame([("g", "events", 0, 1), ("h", "events", 0, 2)], "group_id string, topic string, partition int, committed bigint")
    assert [(r.group_id, r.behind) for r in ret.stranded(segs, commits).collect()] == [("g", 1)]


def test_compaction_and_both_policies(spark):
    rows = [(0, 0, NOW - 8 * DAY, "user-1", 3), (0, 1, NOW - 8 * DAY, "user-2", 3), (0, 2, NOW - 3_600_000, "user-1", 3)]
    log = topic(spark, rows)
    assert sorted(r.offset for r in ret.compact(log).collect()) == [1, 2]
    for policy, left in (("compact", [1, 2]), ("compact,delete", [2]), ("delete", [2])):
        cfg = config(spark, segment_bytes=1, retention_ms=7 * DAY, cleanup_policy=policy)
        assert sorted(r.offset for r in ret.clean(log, cfg, NOW).collect()) == left


def test_tombstones(spark):
    rows = [(0, 0, NOW - 3 * DAY, "a", 3), (0, 1, NOW - 2 * DAY, "a", 0), (0, 2, NOW - DAY // 2, "b", 0)]
    log = topic(spark, rows).withColumn("value", F.when(F.octet_length("value") > 0, F.col("value")))
    assert sorted(r.offset for r in ret.compact(log).collect()) == [1, 2]
    assert [r.offset for r in ret.compact(log, NOW).collect()] == [2]


def test_archive_and_hot_make_the_log(spark):
    from tidelog.scratch import fresh_path
    from tidelog.sources.sinks import archive
    from tidelog.sources.topics import read_tiered, read_tiered_compacted

    log = derive.events_log(spark, "/root/testdata/sf0.001").select("topic", "partition", "offset", "timestamp", "key", "value")
    records = seg.segments(log, derive.topic_config(spark), derive.NOW_MS)
    path = fresh_path(spark, "archive")
    archive(records, path)
    cold = spark.read.parquet(path).select(log.columns)
    hot = log.where("offset >= 100")
    for tiered in (read_tiered(hot, cold), read_tiered_compacted(hot, cold)):
        closed_or_hot = records.where("not is_active or offset >= 100").select(log.columns)
        assert tiered.exceptAll(closed_or_hot).count() == 0
        assert tiered.count() == closed_or_hot.count()


def test_segments_of_records_without_a_join_on_the_segment(spark):
    """One segment may be a whole partition, so it must not be a shuffle key."""
    rows = [(p, i * 2, NOW + i * 60_000, f"k{i % 3}", 10 + i % 7) for p in (0, 1) for i in range(60)]
    log, cfg = topic(spark, rows), config(spark, segment_bytes=100)
    table = seg.segment_table(log, cfg, NOW + DAY)
    out = seg.segments(log, cfg, NOW + DAY, table)
    assert out.columns == [*log.columns, "segment_base", "segment_id", "is_active"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Join" in line and "segment_base" in line.split("Join")[1]]
    got = {(r.partition, r.offset): (r.segment_base, r.segment_id, r.is_active) for r in out.collect()}
    held = table.collect()
    for (p, offset), found in got.items():
        want = max((s for s in held if s.partition == p and s.segment_base <= offset), key=lambda s: s.segment_base)
        assert found == (want.segment_base, want.segment_id, want.is_active)
    assert len(got) == 120


def test_time_rule_drops_whole_segments(spark):
    rows = [(0, i, NOW - 10 * DAY + i * DAY // 4, "k", 50) for i in range(40)]
    log, cfg = topic(spark, rows), config(spark, segment_bytes=200, retention_ms=3 * DAY)
    table = seg.segment_table(log, cfg, NOW)
    judged = ret.judged(table, cfg, NOW)
    kept = ret.retain_time(seg.segments(log, cfg, NOW, table), judged).collect()
    bases = {r.segment_base for r in judged.where("keep_time").collect()}
    assert {r.segment_base for r in kept} == bases
    assert sorted(r.offset for r in kept) == [o for o in range(40) if max(b.segment_base for b in table.collect() if b.segment_base <= o) in bases]
