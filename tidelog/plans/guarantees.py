"""Queries over streams that fail on purpose, damaged messages, replays and callbacks."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidelog.functions.scan import decode_topic
from tidelog.functions.wire import split_envelope
from tidelog.operators import filters, retention
from tidelog.operators.lookup import lookup
from tidelog.operators.positions import bounds
from tidelog.plans import derive as d
from tidelog.plans import sql as s
from tidelog.plans.catalog import ORACLES, query
from tidelog.plans.messages import WRITERS
from tidelog.plans.retention import _shown
from tidelog.schemas import TOPIC
from tidelog.scratch import cut, fresh_path
from tidelog.sources.sinks import append
from tidelog.sources.topics import read_topic
from tidelog.streaming import consume

ADDRESS = ["topic", "partition", "offset"]
EDGE = """edge AS (SELECT topic, partition, (max("offset") + 1) // 2 AS half FROM typed GROUP BY ALL),
halves AS (SELECT topic, partition, "offset", "offset" >= half AS late FROM typed JOIN edge USING (topic, partition))"""


class Crash(Exception):
    """What ends a stream on purpose."""


def _damaged(spark, sf):
    """Orders of which every tenth has lost its last byte."""
    short = F.expr("substring(value, 1, octet_length(value) - 1)")
    return d.order_topic(spark, sf).withColumn("value", F.when(F.col("offset") % 10 == 3, short).otherwise(F.col("value")))


@query(
    "error_split",
    f"WITH {s.ORDERS} SELECT CASE WHEN \"offset\" % 10 = 3 THEN 'dead' ELSE 'good' END AS part, topic, partition, \"offset\", "
    'CASE WHEN "offset" % 10 <> 3 THEN id END AS id FROM typed',
)
def error_split(spark, sf):
    """FLT-2: damaged messages leave the good ones alone."""
    split = split_envelope(_damaged(spark, sf)).drop("magic", "message_index")
    good, dead = filters.split_errors(cut(decode_topic(split, WRITERS)))
    lost = dead.select(F.lit("dead").alias("part"), *ADDRESS, F.lit(None).cast("string").alias("id"))
    return good.select(F.lit("good").alias("part"), *ADDRESS, "id").unionByName(lost)


def _in_halves(spark, sf, place, make, failing):
    """A stream over orders that land in two halves; ``failing`` ends its first try at the second half."""
    log = d.order_topic(spark, sf)
    halves = cut(lookup(log, bounds(log).select("topic", "partition", F.expr("log_end div 2").alias("half")), ["topic", "partition"]))

    def run(sink):
        stream = consume.typed(read_topic(spark, ["order.created"], path=f"{place}/log", streaming=True), WRITERS)
        consume.start(stream, sink, f"{place}/position").awaitTermination()

    sink = make(place)
    for half in ("offset < half", "offset >= half"):
        append(halves.where(half).drop("half"), f"{place}/log")
        if failing is not None and half == "offset >= half":
            try:
                run(failing(sink))
            except StreamingQueryException as error:
                if "Crash" not in str(error):
                    raise
        run(sink)
    return spark.read.parquet(f"{place}/out")


def _times(rows):
    return rows.groupBy(*ADDRESS).agg(F.count("*").alias("times"))


@query(
    "stream_at_least_once",
    f'WITH {s.ORDERS}, {EDGE} SELECT topic, partition, "offset", CASE WHEN late THEN 2 ELSE 1 END::BIGINT AS times FROM halves',
)
def stream_at_least_once(spark, sf):
    """STR-2: the stream ends after its work and before the position is stored; the batch comes again."""
    def failing(sink):
        def write(batch, batch_id):
            sink(batch, batch_id)
            raise Crash

        return write

    return _times(_in_halves(spark, sf, fresh_path(spark, "least"), lambda p: consume.at_least_once(f"{p}/out"), failing))


@query(
    "stream_at_most_once",
    f'WITH {s.ORDERS}, {EDGE} SELECT topic, partition, "offset", 1::BIGINT AS times FROM halves WHERE NOT late',
)
def stream_at_most_once(spark, sf):
    """STR-3: the batch is claimed and its work fails; it is not done a second time."""
    def failing(sink):
        def write(batch, batch_id):
            sink(batch.withColumn("outcome", F.raise_error(F.lit("Crash")).cast("string")), batch_id)

        return write

    return _times(_in_halves(spark, sf, fresh_path(spark, "most"), lambda p: consume.at_most_once(f"{p}/out", f"{p}/claims"), failing))


@query(
    "stream_restart",
    f'WITH {s.ORDERS}, {EDGE} SELECT topic, partition, "offset", CASE WHEN late THEN 1 ELSE 0 END::BIGINT AS batch FROM halves',
)
def stream_restart(spark, sf):
    """STR-5: a stream that stopped goes on at the stored position, with the next batch number."""
    out = _in_halves(spark, sf, fresh_path(spark, "restart"), lambda p: consume.exactly_once(f"{p}/out"), None)
    return out.select(*ADDRESS, F.col("batch_id").cast("bigint").alias("batch"))


@query("replay_table", ORACLES["stream_state"])
def replay_table(spark, sf):
    """STR-7: the table of live keys, rebuilt from the whole log after it was built from a part of it."""
    place = fresh_path(spark, "replay")
    log = cut(d.tombstone_log(spark, sf).select(*TOPIC.names))
    for part in ("offset % 3 = 0", "offset % 3 > 0"):
        append(log.where(part), f"{place}/log")
        topic = read_topic(spark, ["events"], path=f"{place}/log")
        consume.replay(topic, lambda t: retention.compact(t).where("value is not null"), f"{place}/table")
    return _shown(spark.read.schema(TOPIC).parquet(f"{place}/table"))


@query(
    "stream_callback",
    f"""WITH {s.ORDERS} SELECT topic, partition, "offset", "offset" % 10 <> 3 AS stored FROM typed""",
)
def stream_callback(spark, sf):
    """UDF-1: a report of each record from the callback that follows the sink."""
    place = fresh_path(spark, "callback")
    append(_damaged(spark, sf), f"{place}/log")

    def report(batch, batch_id):
        stored = F.col("decode_error").isNull().alias("stored")
        batch.select(*ADDRESS, stored).write.mode("overwrite").parquet(f"{place}/reports/batch_id={batch_id}")

    topic = read_topic(spark, ["order.created"], path=f"{place}/log", streaming=True)
    sink = consume.with_callback(consume.exactly_once(f"{place}/out"), report)
    consume.start(consume.typed(topic, WRITERS), sink, f"{place}/position").awaitTermination()
    return spark.read.parquet(f"{place}/reports").drop("batch_id")
