"""Guarantees across restarts, batch against stream, state, and lag from progress reports."""

import pytest
from pyspark.sql import functions as F

from tidelog.operators import retention
from tidelog.plans import derive
from tidelog.plans.messages import WRITERS
from tidelog.schemas import TOPIC
from tidelog.scratch import fresh_path
from tidelog.sources import sinks, topics
from tidelog.streaming import consume, progress, state

SF = "/root/testdata/sf0.001"


class Crash(Exception):
    pass


@pytest.fixture(scope="module")
def landed(spark):
    place = fresh_path(spark, "landed")
    sinks.append(derive.order_topic(spark, SF).coalesce(2), place)
    return place


def run(spark, landed, sink, position):
    topic = topics.read_topic(spark, ["order.created"], path=landed, streaming=True, max_per_trigger=1)
    consume.start(consume.typed(topic, WRITERS), sink, position).awaitTermination()


def crash_once(sink, at, before):
    """The sink, failing once in batch ``at``, before or after its work."""
    left = [1]

    def write(batch, batch_id):
        if before and batch_id == at and left:
            left.pop()
            raise Crash
        sink(batch, batch_id)
        if batch_id == at and left:
            left.pop()
            raise Crash

    return write


def addresses(spark, path):
    return [(r.partition, r.offset) for r in spark.read.parquet(path).select("partition", "offset").collect()]


def read(spark, landed, make, before):
    place = fresh_path(spark, "run")
    sink = crash_once(make(place), 1, before)
    with pytest.raises(Exception, match="Crash"):
        run(spark, landed, sink, f"{place}/position")
    run(spark, landed, sink, f"{place}/position")
    return addresses(spark, f"{place}/out")


def test_guarantees_after_a_crash(spark, landed):
    want = sorted(addresses(spark, landed))
    at_least = read(spark, landed, lambda p: consume.at_least_once(f"{p}/out"), before=False)
    assert set(at_least) == set(want) and len(at_least) > len(want)
    exactly = read(spark, landed, lambda p: consume.exactly_once(f"{p}/out"), before=False)
    assert sorted(exactly) == want
    most = read(spark, landed, lambda p: consume.at_most_once(f"{p}/out", f"{p}/claims"), before=False)
    assert sorted(most) == want

    def lost(place):
        claimed = consume.at_most_once(f"{place}/out", f"{place}/claims")

        def write(batch, batch_id):
            if batch_id == 1:
                claimed(batch.limit(0), batch_id)  # claimed, then the work is lost
            else:
                claimed(batch, batch_id)

        return write

    once = read(spark, landed, lost, before=False)
    assert len(once) < len(want) and len(set(once)) == len(once)


def test_stream_equals_batch_and_replay_repeats(spark, landed):
    place = fresh_path(spark, "run")
    seen = []
    sink = consume.with_callback(consume.exactly_once(f"{place}/out"), lambda b, i: seen.append(b.count()))
    run(spark, landed, sink, f"{place}/position")
    whole = topics.read_topic(spark, ["order.created"], path=landed)
    batch = consume.typed(whole, WRITERS)
    streamed = spark.read.parquet(f"{place}/out").select(batch.columns)
    assert sum(seen) == whole.count() == streamed.count()
    assert streamed.exceptAll(batch).count() == 0
    for _ in range(2):
        consume.replay(whole, lambda t: consume.typed(t, WRITERS), f"{place}/table")
        assert spark.read.parquet(f"{place}/table").exceptAll(batch).count() == 0
    with pytest.raises(ValueError):
        consume.replay(topics.read_topic(spark, ["x"], path=landed, streaming=True), lambda t: t, place)


def test_state_over_several_runs_equals_compaction(spark):
    place = fresh_path(spark, "state")
    log = derive.tombstone_log(spark, SF).select(TOPIC.names)

    def step(low, high):
        sinks.append(log.where((F.col("offset") >= low) & (F.col("offset") < high)).coalesce(1), f"{place}/log")
        topic = topics.read_topic(spark, ["events"], path=f"{place}/log", streaming=True)
        consume.start(topic, state.write_changes(f"{place}/changes"), f"{place}/first").awaitTermination()
        changes = spark.readStream.schema(TOPIC).parquet(f"{place}/changes")
        state.current_state(changes).writeStream.outputMode("update").foreachBatch(
            lambda b, i: b.write.mode("append").parquet(f"{place}/out")
        ).option("checkpointLocation", f"{place}/second").trigger(availableNow=True).start().awaitTermination()

    for low, high in ((0, 100), (100, 250), (250, 10_000)):
        step(low, high)
        live = state.state_table(spark.read.parquet(f"{place}/out"))
        want = retention.compact(log.where(F.col("offset") < high)).where("value is not null").select(live.columns)
        assert live.exceptAll(want).count() == 0 and live.count() == want.count() > 0


def test_lag_from_reports(spark):
    report = (
        '{"id":"q","batchId":%d,"timestamp":"2024-01-01T00:00:00.000Z","sources":[{"description":"k","endOffset":'
        '"{\\"t\\":{\\"0\\":%d,\\"1\\":5}}","latestOffset":"{\\"t\\":{\\"0\\":23,\\"1\\":9}}"}]}'
    )
    texts = spark.createDataFrame([(report % (0, 3),), (report % (1, 20),)], "value string")
    lag = progress.progress_lag(texts)
    got = {(r.snapshot, r.partition): (r.committed, r.log_end, r.lag) for r in lag.collect()}
    assert got == {(0, 0): (3, 23, 20), (0, 1): (5, 9, 4), (1, 0): (20, 23, 3), (1, 1): (5, 9, 4)}
    from tidelog.operators.ordering import lag_trend

    assert {(r.snapshot, r.partition): r.change for r in lag_trend(lag).collect()}[(1, 0)] == -17


def test_listener_keeps_reports(spark, landed):
    import time

    place = fresh_path(spark, "reports")
    listener = progress.lag_listener(spark, f"{place}/reports")
    try:
        run(spark, landed, consume.exactly_once(f"{place}/out"), f"{place}/position")
        for _ in range(50):
            try:
                if spark.read.text(f"{place}/reports").count() > 0:
                    break
            except Exception:
                pass
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert progress.progress_lag(spark.read.text(f"{place}/reports")).columns[:3] == ["group_id", "snapshot", "topic"]


def test_late_record_does_not_undo_a_tombstone(spark):
    place = fresh_path(spark, "late")
    for offset, value in ((5, b"a"), (100, None), (50, b"b")):
        row = spark.createDataFrame([("t", 0, offset, b"k", value)], "topic string, partition int, offset long, key binary, value binary")
        row.selectExpr("topic", "partition", "offset", "timestamp'2024-01-01' timestamp", "key", "value").write.mode("append").parquet(f"{place}/changes")
        changes = spark.readStream.schema(TOPIC).parquet(f"{place}/changes")
        state.current_state(changes).writeStream.outputMode("update").foreachBatch(
            lambda b, i: b.write.mode("append").parquet(f"{place}/out")
        ).option("checkpointLocation", f"{place}/position").trigger(availableNow=True).start().awaitTermination()
    assert state.state_table(spark.read.parquet(f"{place}/out")).count() == 0
