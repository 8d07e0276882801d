from datetime import datetime, timedelta

from tidelog.operators.reports import effective_retention
from tidelog.operators.retention import clean, judged, retain
from tidelog.operators.segments import segment_table
from tidelog.sources.topics import read_tiered

START = datetime(2024, 1, 1)
NOW = 1_704_067_200_000 + 3_600_000


def make_log(spark, topics, count=200):
    rows = [(t, 0, i, f"k{i}", b"x" * 10, START + timedelta(seconds=i)) for t in topics for i in range(count)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value binary, timestamp timestamp")


def make_config(spark, rows):
    return spark.createDataFrame(rows, "topic string, retention_ms long, retention_bytes long, segment_bytes long, segment_ms long, cleanup_policy string")


def test_unconfigured_topics_and_no_limits_keep_all(spark):
    log = make_log(spark, ["small", "plain", "endless"])
    config = make_config(spark, [("small", -1, 300, 100, None, "delete"), ("endless", -1, -1, 100, -1, "delete")])
    segs = judged(segment_table(log, config, NOW), config, NOW)
    for left in (retain(log, segs), clean(log, config, NOW)):
        counts = {r["topic"]: r["count"] for r in left.groupBy("topic").count().collect()}
        assert counts["plain"] == counts["endless"] == 200 and 0 < counts["small"] < 200
    lives = {r["topic"]: r["longest_life_ms"] for r in effective_retention(log, config).collect()}
    assert lives.keys() == {"small", "plain", "endless"} and lives["endless"] is None and lives["plain"] is not None


def test_archive_fills_holes(spark):
    whole = make_log(spark, ["a", "b"])
    hot = whole.where("offset >= 100 and (topic = 'b' or offset % 10 <> 3)")
    got = sorted((r["topic"], r["offset"]) for r in read_tiered(hot, whole).collect())
    assert got == [(t, i) for t in "ab" for i in range(200)]
