"""Streams over landed logs: sessions, start positions, lost offsets, lag."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

from tidelog.operators.ordering import liveness_gaps
from tidelog.scratch import fresh_path
from tidelog.sources import topics
from tidelog.streaming import consume, landed

COLUMNS = "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary"


def land(spark, place, offsets, partition=0):
    at = dt.datetime(2024, 1, 1)
    rows = [("t", partition, o, at, None, None) for o in offsets]
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").partitionBy("topic", "partition").parquet(f"{place}/log")


def log(spark, place):
    return topics.read_topic(spark, ["t"], path=f"{place}/log")


def keep(place):
    def write(batch, batch_id):
        batch.select("partition", "offset").write.mode("overwrite").parquet(f"{place}/out/batch_id={batch_id}")

    return write


def run(spark, place, sink, starts):
    stream = landed.read_from(spark, ["t"], f"{place}/log", starts)
    consume.start(stream, sink, f"{place}/position").awaitTermination()


def read(spark, place):
    return sorted((r.partition, r.offset) for r in spark.read.schema("partition int, offset bigint").parquet(f"{place}/out").collect())


def test_start_positions_are_settled_once(spark):
    place = fresh_path(spark, "starts")
    land(spark, place, range(5, 20))
    commits = spark.createDataFrame([("t", 0, 8)], "topic string, partition int, committed bigint")
    gone = spark.createDataFrame([("t", 0, 2)], "topic string, partition int, committed bigint")
    first = lambda name, *a: landed.start_positions(log(spark, place), f"{place}/{name}", *a).first().from_offset
    assert [first("a"), first("b", "latest"), first("c", "latest", commits), first("d", "earliest", gone)] == [5, 20, 8, 5]
    with pytest.raises(Exception, match="OFFSET_OUT_OF_RANGE"):
        first("e", "error", gone)
    assert first("f", "error", commits) == 8
    with pytest.raises(ValueError):
        first("g", "newest")
    land(spark, place, range(20, 30))
    assert first("b", "latest") == 20  # where it first started
    with pytest.raises(ValueError):
        topics.read_topic(spark, ["t"], path=f"{place}/log", reset="latest")


def test_a_partition_that_comes_later_is_read_whole(spark):
    place = fresh_path(spark, "late")
    land(spark, place, range(10))
    starts = landed.start_positions(log(spark, place), place, "latest")
    run(spark, place, keep(place), starts)
    land(spark, place, range(10, 12))
    land(spark, place, range(3), partition=1)
    run(spark, place, keep(place), starts)
    assert read(spark, place) == [(0, 10), (0, 11), (1, 0), (1, 1), (1, 2)]


@pytest.mark.parametrize("fail", [True, False])
def test_lost_offsets(spark, fail):
    place = fresh_path(spark, "loss")
    land(spark, place, range(10))
    starts = landed.start_positions(log(spark, place), place)
    guard = landed.guarded(keep(place), place, starts, fail)
    run(spark, place, guard, starts)
    land(spark, place, [*range(13, 16), *range(18, 20)])
    land(spark, place, [2, 3], partition=1)
    if fail:
        with pytest.raises(StreamingQueryException, match="DataLoss"):
            run(spark, place, guard, starts)
        assert read(spark, place) == [(0, o) for o in range(10)]
        # Going on later reads the batch again, and its ranges count once.
        run(spark, place, landed.guarded(keep(place), place, starts, False), starts)
    else:
        run(spark, place, guard, starts)
    got = sorted((r.partition, r.lost_from, r.lost_to) for r in landed.lost_ranges(spark, place).collect())
    assert got == [(0, 10, 13), (0, 16, 18), (1, 0, 2)]
    assert len(read(spark, place)) == 17


def test_a_repeated_batch_counts_once(spark):
    place = fresh_path(spark, "lag")
    land(spark, place, range(6))
    sink = landed.tracked(keep(place), place)
    batch = log(spark, place)
    landed.record_ends(batch, place)
    sink(batch.where("offset < 4"), 0)
    sink(batch.where("offset < 4"), 0)
    landed.record_ends(batch, place)
    sink(batch, 1)
    land(spark, place, range(6, 9))
    landed.record_ends(log(spark, place), place)
    got = [(r.snapshot, r.committed, r.log_end, r.lag) for r in landed.landed_lag(spark, place, "g").orderBy("snapshot").collect()]
    assert got == [(0, 0, 6, 6), (1, 4, 6, 2), (2, 6, 9, 3)]
    assert landed.lost_ranges(spark, place).count() == 0


def test_sessions_with_beats_at_the_timeout(spark):
    at = lambda ms: dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=ms)
    beats = [("a", at(0)), ("a", at(45_000)), ("a", at(90_001)), ("b", at(5)), ("a", at(300_000)), ("a", at(300_000)), (None, at(7)), (None, at(99_999))]
    df = spark.createDataFrame(beats, "member_id string, timestamp timestamp")
    got = landed.session_gaps(landed.sessions(df)).collect()
    want = liveness_gaps(df).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == 3


def budgets(spark, place, n, each=True, sink=None):
    mine = f"{place}/{n}-{each}"
    stream = landed.addresses(spark, ["t"], f"{place}/log")
    consume.start(stream, landed.budgeted(sink or keep(mine), f"{place}/log", mine, n, each), f"{mine}/position").awaitTermination()
    rows = spark.read.schema("partition int, offset bigint, batch_id int").parquet(f"{mine}/out").collect()
    found = {}
    for r in rows:
        found.setdefault(r.batch_id, []).append((r.partition, r.offset))
    return [sorted(found[k]) for k in sorted(found)]


def test_batches_hold_as_many_records_whatever_the_files(spark):
    place = fresh_path(spark, "budget")
    land(spark, place, [0, 4, 6, 9])  # holes, and files that overlap
    land(spark, place, [1, 2, 3, 7])
    land(spark, place, [0, 1], partition=1)
    every = [(0, o) for o in (0, 1, 2, 3, 4, 6, 7, 9)]
    other = [(1, 0), (1, 1)]
    assert budgets(spark, place, 3) == [every[:3] + other, every[3:6], every[6:]]
    assert budgets(spark, place, 3, False) == [every[:3], every[3:6], every[6:] + other[:1], other[1:]]
    assert budgets(spark, place, 100) == [every + other]
    assert budgets(spark, place, 1)[0] == [(0, 0), (1, 0)]
    land(spark, place, [10, 11])
    land(spark, place, [5])  # late
    assert budgets(spark, place, 3)[3:] == [[(0, 5), (0, 10), (0, 11)]]
    with pytest.raises(ValueError):
        landed.budgeted(keep(place), place, place, 0)


def test_a_budgeted_stream_that_is_cut_off_repeats_its_numbers(spark):
    place = fresh_path(spark, "cut-off")
    land(spark, place, range(10))
    seen = []

    def once(batch, number):
        seen.append((number, batch.count()))
        if len(seen) == 2:
            raise RuntimeError("lost")
        keep(f"{place}/4-True")(batch, number)

    with pytest.raises(StreamingQueryException):
        budgets(spark, place, 4, sink=once)
    assert budgets(spark, place, 4, sink=once) == [[(0, o) for o in range(k, min(k + 4, 10))] for k in (0, 4, 8)]
    assert seen == [(0, 4), (1, 4), (0, 4), (1, 4), (2, 2)]


def test_a_batch_reads_only_the_files_that_hold_its_offsets(spark):
    place = fresh_path(spark, "files")
    for k in range(4):
        land(spark, place, range(k * 5, k * 5 + 5))
    names = []

    def note(batch, number):
        names.append(len(batch.inputFiles()))
        keep(f"{place}/5-True")(batch, number)

    assert len(budgets(spark, place, 5, sink=note)) == 4
    assert names == [1, 1, 1, 1]
