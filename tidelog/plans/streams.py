"""Queries that land a log, run a stream over it to its end, and read the result back."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidelog.operators.lookup import lookup
from tidelog.operators.ordering import lag_trend
from tidelog.operators.positions import bounds
from tidelog.plans import derive as d
from tidelog.plans import sql as s
from tidelog.plans.catalog import ORACLES, query
from tidelog.plans.messages import TYPED, WRITERS
from tidelog.plans.retention import LATEST, SHOWN, _shown
from tidelog.schemas import TOPIC
from tidelog.scratch import cut, fresh_path
from tidelog.sources.sinks import append
from tidelog.sources.topics import read_topic
from tidelog.streaming import consume, landed, state


def _finish(stream, sink, place):
    consume.start(stream, sink, f"{place}/position").awaitTermination()


@query(
    "stream_consume",
    f"WITH {s.ORDERS} SELECT {TYPED}, CASE WHEN schema_id = 1 THEN region ELSE '' END AS region, 'good' AS outcome FROM typed",
)
def stream_consume(spark, sf):
    place = fresh_path(spark, "consume")
    append(d.order_topic(spark, sf), f"{place}/log")
    topic = read_topic(spark, ["order.created"], path=f"{place}/log", streaming=True)
    _finish(consume.typed(topic, WRITERS), consume.exactly_once(f"{place}/out"), place)
    return spark.read.parquet(f"{place}/out").select(
        "topic", "partition", "offset", "schema_id", "id", "customer_id", "item", "amount", "status",
        F.unix_millis("created_at").alias("created_ms"), "region", "outcome",
    )


@query("stream_dedupe", f"WITH {s.PRODUCED} SELECT DISTINCT topic, partition, seq FROM produced")
def stream_dedupe(spark, sf):
    place = fresh_path(spark, "dedupe")
    sent = d.producer_log(spark, sf).select("producer_id", "topic", "partition", "offset", "seq", "timestamp")
    sent.write.parquet(f"{place}/log")
    stream = spark.readStream.schema(sent.schema).parquet(f"{place}/log")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{place}/out/batch_id={batch_id}")

    _finish(state.dedupe_retries(stream), write, place)
    return spark.read.parquet(f"{place}/out").select("topic", "partition", "seq")


@query(
    "stream_state",
    f"WITH {s.LOG} SELECT {SHOWN} FROM (SELECT * FROM log QUALIFY {LATEST}) WHERE event_type <> 'error'",
)
def stream_state(spark, sf):
    place = fresh_path(spark, "state")
    append(d.tombstone_log(spark, sf), f"{place}/log")
    topic = read_topic(spark, ["events"], path=f"{place}/log", streaming=True)
    _finish(topic, state.write_changes(f"{place}/changes"), f"{place}/first")
    changes = spark.readStream.schema(TOPIC).parquet(f"{place}/changes")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{place}/out/batch_id={batch_id}")

    return _live(changes, place)


def _live(changes, place):
    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{place}/out/batch_id={batch_id}")

    state.current_state(changes).writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", f"{place}/position"
    ).trigger(availableNow=True).start().awaitTermination()
    return _shown(state.state_table(changes.sparkSession.read.parquet(f"{place}/out").drop("batch_id")))


@query(
    "stream_state_late",
    f"WITH {s.LOG} SELECT {SHOWN} FROM (SELECT * FROM log QUALIFY {LATEST}) WHERE event_type <> 'error'",
)
def stream_state_late(spark, sf):
    """The second half of every partition arrives first, tombstones included; older records change nothing."""
    place = fresh_path(spark, "late")
    log = cut(_halved(d.tombstone_log(spark, sf)))
    for half in ("offset >= half", "offset < half"):
        append(log.where(half).drop("half"), f"{place}/log")
        topic = read_topic(spark, ["events"], path=f"{place}/log", streaming=True)
        _finish(topic, state.write_changes(f"{place}/changes"), f"{place}/first")
        out = _live(spark.readStream.schema(TOPIC).parquet(f"{place}/changes"), place)
    return out


def _halved(log):
    """The log with the middle of each partition."""
    ends = bounds(log).select("topic", "partition", F.expr("log_end div 2").alias("half"))
    return lookup(log.select(*TOPIC.names), ends, ["topic", "partition"])


def _collect(place):
    def write(batch, batch_id):
        batch.select("topic", "partition", "offset").write.mode("overwrite").parquet(f"{place}/out/batch_id={batch_id}")

    return write


def _read(spark, place):
    return spark.read.schema("topic string, partition int, offset bigint").parquet(f"{place}/out")


@query(
    "stream_resume",
    f"""WITH {s.LOG}, {s.BOUNDS}, edge AS (SELECT topic, partition, log_end // 2 AS half, log_end * 3 // 4 AS three FROM bounds)
SELECT g.group_id, topic, partition, "offset" FROM log JOIN edge USING (topic, partition), (VALUES ('all'), ('half'), ('new')) g(group_id)
WHERE "offset" >= CASE g.group_id WHEN 'all' THEN 0 WHEN 'half' THEN half ELSE three END""",
)
def stream_resume(spark, sf):
    """Three groups start when three quarters have landed, at the start, at a commit and at the end, stop, and go on."""
    place = fresh_path(spark, "resume")
    log = d.events_log(spark, sf).select(*TOPIC.names)
    ends = cut(bounds(log).select("topic", "partition", F.expr("log_end div 2").alias("committed"), F.expr("log_end * 3 div 4").alias("three")))
    parted = cut(lookup(log, ends, ["topic", "partition"]).drop("committed"))
    out = None
    for first in (True, False):
        append(parted.where("offset < three" if first else "offset >= three").drop("three"), f"{place}/log")
        for group, reset, commits in (("all", "earliest", None), ("half", "latest", ends), ("new", "latest", None)):
            mine = f"{place}/{group}"
            starts = landed.start_positions(read_topic(spark, ["events"], path=f"{place}/log"), mine, reset, commits)
            _finish(landed.read_from(spark, ["events"], f"{place}/log", starts), _collect(mine), mine)
            if not first:
                rows = _read(spark, mine).select(F.lit(group).alias("group_id"), "topic", "partition", "offset")
                out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "stream_first_n",
    f"""WITH {s.LOG}, {s.BOUNDS}, edge AS (SELECT topic, partition, log_end // 2 AS half, log_end FROM bounds),
part AS (
  SELECT topic, partition, "offset", "offset" >= half AS late, CASE WHEN "offset" < half THEN "offset" ELSE "offset" - half END AS nth,
         row_number() OVER (PARTITION BY "offset" >= half ORDER BY topic, partition, "offset") - 1 AS pos,
         (SELECT max(log_end) // 6 + 1 FROM edge) AS n
  FROM log JOIN edge USING (topic, partition)),
base AS (SELECT max(nth // n) + 1 AS each, max(pos // n) + 1 AS whole FROM part WHERE NOT late)
SELECT 'partition' AS budget, topic, partition, "offset", (nth // n + CASE WHEN late THEN each ELSE 0 END)::BIGINT AS batch FROM part, base
UNION ALL SELECT 'topic', topic, partition, "offset", (pos // n + CASE WHEN late THEN whole ELSE 0 END)::BIGINT FROM part, base""",
)
def stream_first_n(spark, sf):
    """Both halves of every partition are read in batches of as many records, of a partition or of the topic."""
    place = fresh_path(spark, "budget")
    log = d.events_log(spark, sf).select(*TOPIC.names)
    ends = cut(bounds(log).select("topic", "partition", F.expr("log_end div 2").alias("half"), "log_end"))
    n = ends.agg(F.expr("max(log_end) div 6 + 1")).first()[0]
    parted = cut(lookup(log, ends.drop("log_end"), ["topic", "partition"]))
    out, budgets = None, (("partition", True), ("topic", False))
    for half in ("offset < half", "offset >= half"):
        append(parted.where(half).drop("half"), f"{place}/log")
        for budget, each in budgets:
            mine = f"{place}/{budget}"
            stream = landed.addresses(spark, ["events"], f"{place}/log")
            _finish(stream, landed.budgeted(_collect(mine), f"{place}/log", mine, n, each), mine)
    for budget, _ in budgets:
        rows = spark.read.schema("topic string, partition int, offset bigint, batch_id bigint").parquet(f"{place}/{budget}/out")
        rows = rows.select(F.lit(budget).alias("budget"), "topic", "partition", "offset", F.col("batch_id").alias("batch"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "stream_loss",
    f"""WITH {s.LOG}, {s.BOUNDS}, edge AS (SELECT *, log_end // 4 AS one, log_end // 2 AS half FROM bounds)
SELECT 'go on' AS policy, false AS stopped, topic, partition, one AS lost_from, half AS lost_to, one + log_end - half AS n_read FROM edge WHERE half > one
UNION ALL SELECT 'stop', true, topic, partition, one, half, one FROM edge WHERE half > one""",
)
def stream_loss(spark, sf):
    """A quarter of every partition expires before the stream gets there: one stream goes on, one stops."""
    place = fresh_path(spark, "loss")
    log = d.events_log(spark, sf).select(*TOPIC.names)
    ends = bounds(log).select("topic", "partition", F.expr("log_end div 4").alias("one"), F.expr("log_end div 2").alias("half"))
    parted = cut(lookup(log, ends, ["topic", "partition"]))
    out, policies = None, (("go on", False), ("stop", True))
    for first in (True, False):
        append(parted.where("offset < one" if first else "offset >= half").drop("one", "half"), f"{place}/log")
        for policy, fail in policies:
            mine, stopped = f"{place}/{policy.replace(' ', '-')}", False
            starts = landed.start_positions(read_topic(spark, ["events"], path=f"{place}/log"), mine)
            stream = landed.read_from(spark, ["events"], f"{place}/log", starts)
            try:
                _finish(stream, landed.guarded(_collect(mine), mine, starts, fail), mine)
            except StreamingQueryException as error:
                if "DataLoss" not in str(error):
                    raise
                stopped = True
            if not first:
                read = _read(spark, mine).groupBy("topic", "partition").agg(F.count("*").alias("n_read"))
                lost = landed.lost_ranges(spark, mine).drop("batch_id")
                rows = lost.join(read, ["topic", "partition"], "left").select(
                    F.lit(policy).alias("policy"), F.lit(stopped).alias("stopped"), "topic", "partition", "lost_from", "lost_to",
                    F.coalesce("n_read", F.lit(0)).alias("n_read"),
                )
                out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "stream_lag",
    f"""WITH {s.LOG}, {s.BOUNDS}, slots AS (
  SELECT topic, partition, "offset" * 4 // log_end AS slot, count(*) AS n FROM log JOIN bounds USING (topic, partition) GROUP BY ALL),
lags AS (
  SELECT 'reader' AS group_id, topic, partition, slot AS snapshot,
         (sum(n) OVER w - n)::BIGINT AS committed, (sum(n) OVER w)::BIGINT AS log_end, n AS lag
  FROM slots WINDOW w AS (PARTITION BY topic, partition ORDER BY slot))
SELECT *, lag - lag(lag) OVER w AS change, coalesce(lag - lag(lag) OVER w > 0, false) AS growing FROM lags
WINDOW w AS (PARTITION BY topic, partition ORDER BY snapshot)""",
)
def stream_lag(spark, sf):
    """The log lands in quarters; the stream reads each after the ends were noted, and is one quarter behind."""
    place = fresh_path(spark, "lag")
    log = d.events_log(spark, sf).select(*TOPIC.names)
    ends = bounds(log).select("topic", "partition", "log_end")
    parted = cut(lookup(log, ends, ["topic", "partition"]).withColumn("slot", F.expr("offset * 4 div log_end")).drop("log_end"))
    for slot in range(4):
        append(parted.where(F.col("slot") == slot).drop("slot"), f"{place}/log")
        landed.record_ends(read_topic(spark, ["events"], path=f"{place}/log"), place)
        _finish(read_topic(spark, ["events"], path=f"{place}/log", streaming=True), landed.tracked(_collect(place), place), place)
    return lag_trend(landed.landed_lag(spark, place, "reader"))


@query("stream_liveness", ORACLES["liveness_gaps"])
def stream_liveness(spark, sf):
    """Heartbeats land in four parts of the month, some of them one part late, and a mark ends the log."""
    place = fresh_path(spark, "liveness")
    beats = d.table(spark, sf, "events").select(F.col("user_id").alias("member_id"), F.col("ts").cast("timestamp").alias("timestamp"), "event_id")
    edge = beats.agg(F.min(F.unix_micros("timestamp")).alias("lo"), F.max(F.unix_micros("timestamp")).alias("hi")).first()
    part = F.floor((F.unix_micros("timestamp") - edge.lo) * 3 / (edge.hi - edge.lo + 1)).cast("int")
    late = (F.col("event_id") % 7 == 3).cast("int")
    parted = cut(beats.withColumn("part", part + late).drop("event_id"))
    # Later than any watermark of the beats, so that all sessions are closed.
    month = (edge.hi - edge.lo) * 2
    mark = spark.range(1).select(F.lit(None).cast("bigint").alias("member_id"), F.timestamp_micros(F.lit(edge.hi + 2 * month)).alias("timestamp"))

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{place}/out/batch_id={batch_id}")

    for rows in [*(parted.where(F.col("part") == k).drop("part") for k in range(4)), mark]:
        rows.write.mode("append").parquet(f"{place}/log")
        stream = spark.readStream.schema("member_id bigint, timestamp timestamp").parquet(f"{place}/log")
        runs = landed.sessions(stream, 86_400_000, f"{month} microseconds")
        runs.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{place}/position").trigger(
            availableNow=True
        ).start().awaitTermination()
    closed = spark.read.parquet(f"{place}/out").where("member_id is not null")
    return landed.session_gaps(closed).select(
        "member_id", F.unix_millis("last_beat").alias("last_ms"), F.unix_millis("next_beat").alias("next_ms"), "gap_us"
    )
