"""Scattered offset ranges: merged into intervals that reach the scan of a landed log."""

import pytest
from pyspark.sql import functions as F

from tidelog.scratch import fresh_path
from tidelog.sources import topics

RANGES = "topic string, partition int, from_offset bigint, to_offset bigint"


@pytest.fixture(scope="module")
def log(spark):
    place = fresh_path(spark, "ranges")
    rows = spark.range(40_000).select(
        F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("topic"), (F.col("id") / 2 % 4).cast("int").alias("partition"),
        F.floor(F.col("id") / 8).alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("binary").alias("key"), F.lit(None).cast("binary").alias("value"),
    )
    rows.repartition(1).write.partitionBy("topic", "partition").parquet(place)
    return topics.read_topic(spark, ["t0", "t1"], path=place)


def test_ranges_are_swept_into_intervals(spark):
    rows = [("t", 0, 5, 9), ("t", 0, 0, 6), ("t", 0, 9, 10), ("t", 0, 20, 30), ("t", 0, 22, 23), ("t", 1, 4, 4), ("t", 1, 7, 8), (None, 0, 1, 2)]
    got = topics.merged(spark.createDataFrame(rows, RANGES), "from_offset", "to_offset").collect()
    assert sorted((r.topic or "", r.partition, r.lo, r.hi) for r in got) == [("", 0, 1, 2), ("t", 0, 0, 10), ("t", 0, 20, 30), ("t", 1, 7, 8)]


def test_two_far_ranges_reach_the_scan(spark, log):
    ranges = spark.createDataFrame([("t0", 0, 10, 20), ("t1", 3, 4_900, 4_950)], RANGES)
    out = topics.read_range(log, ranges)
    got = {(r.topic, r.partition): (r.n, r.lo, r.hi) for r in out.groupBy("topic", "partition").agg(F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi")).collect()}
    assert got == {("t0", 0): (10, 10, 19), ("t1", 3): (50, 4_900, 4_949)}
    plan = out._jdf.queryExecution().toString()
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line)
    assert "PushedFilters" in plan and "Or(And(" in plan.replace("PushedFilters: [", "") and "topic" in scan
    # Only the two folders that are asked for are listed for reading.
    files = out.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(files) == 2


@pytest.mark.parametrize("count", [3, 200])
def test_many_ranges_are_whole(spark, log, count):
    rows = [("t0", i % 4, i * 20, i * 20 + 5) for i in range(count)] + [("t0", 0, 0, 3), ("t1", 2, 9, 9)]
    ranges = spark.createDataFrame(rows, RANGES)
    want = log.join(ranges, ["topic", "partition"]).where("offset >= from_offset and offset < to_offset").select("topic", "partition", "offset")
    got = topics.read_range(log, ranges).select("topic", "partition", "offset")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() > 0


def test_no_ranges(spark, log):
    assert topics.read_range(log, spark.createDataFrame([], RANGES)).count() == 0
