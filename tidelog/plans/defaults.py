"""Queries over topics with limits, with limits of -1, and without settings of their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions import wire
from tidelog.operators import reports
from tidelog.operators import retention as ret
from tidelog.operators import segments as seg
from tidelog.plans import derive as d
from tidelog.plans import sql as s
from tidelog.plans.catalog import query
from tidelog.sources import topics

ADDRESS = ["topic", "partition", "offset"]
RANGE = 'l.topic = g.topic AND l.partition = g.partition AND l."offset" BETWEEN g.segment_base AND g.last_offset'


@query("retain_defaults", f'WITH {s.MIXED} SELECT l.topic, l.partition, l."offset" FROM log l JOIN judged g ON {RANGE} WHERE g.keep')
def retain_defaults(spark, sf):
    log, config = d.topic_per_type(spark, sf), d.mixed_config(spark)
    judged = ret.judged(seg.segment_table(log, config, d.NOW_MS), config, d.NOW_MS)
    return ret.retain(log, judged).select(*ADDRESS)


@query(
    "clean_defaults",
    f"""WITH {s.MIXED}, kept AS (SELECT l.* FROM log l JOIN judged g ON {RANGE} WHERE g.keep)
SELECT topic, partition, "offset" FROM kept WHERE topic <> 'events.click'
UNION ALL SELECT topic, partition, "offset" FROM (
  SELECT * FROM log WHERE topic = 'events.click'
  QUALIFY row_number() OVER (PARTITION BY partition, user_id ORDER BY "offset" DESC) = 1)
  JOIN (SELECT partition, min("offset") AS first_kept FROM kept WHERE topic = 'events.click' GROUP BY partition) USING (partition)
  WHERE "offset" >= first_kept""",
)
def clean_defaults(spark, sf):
    return ret.clean(d.topic_per_type(spark, sf), d.mixed_config(spark), d.NOW_MS).select(*ADDRESS)


@query(
    "effective_defaults",
    f"""WITH {s.MIXED}, f AS (
  SELECT topic, partition, sum(size)::BIGINT AS n_bytes, max(ms) - min(ms) AS span_ms FROM sized GROUP BY topic, partition),
rolls AS (SELECT *, ceil(least(seg_bytes * span_ms / n_bytes, seg_ms::DOUBLE))::BIGINT AS roll_ms FROM f JOIN limits USING (topic))
SELECT topic, partition, n_bytes, span_ms, roll_ms, roll_ms + ret_ms AS longest_life_ms FROM rolls""",
)
def effective_defaults(spark, sf):
    return reports.effective_retention(d.topic_per_type(spark, sf), d.mixed_config(spark))


@query("tiered_with_holes", f'WITH {s.LOG} SELECT topic, partition, "offset", event_id FROM log')
def tiered_with_holes(spark, sf):
    """Every tenth offset is missing from the live log, which the whole archive fills."""
    log = d.events_log(spark, sf)
    return topics.read_tiered(log.where("offset % 10 <> 3"), log).select(*ADDRESS, "event_id")


@query(
    "envelope_high_index",
    f'WITH {s.LOG} SELECT topic, partition, "offset", 7 AS schema_id, (event_id % 20000)::INTEGER AS message_index, "value" AS payload FROM log',
)
def envelope_high_index(spark, sf):
    """Message indexes up to 19,999, in one to three bytes."""
    log = d.events_log(spark, sf)
    raw = (F.col("event_id") % 20000 * 2).cast("bigint")

    def byte(at: int, more: bool):
        low = F.shiftright(raw, 7 * at).bitwiseAND(F.lit(127))
        return F.lpad(F.hex(low + 128 if more else low), 2, "0")

    one, two, three = byte(0, False), F.concat(byte(0, True), byte(1, False)), F.concat(byte(0, True), byte(1, True), byte(2, False))
    number = F.when(raw < 1 << 7, one).when(raw < 1 << 14, two).otherwise(three)
    index = F.when(raw == 0, "00").otherwise(F.concat(F.lit("02"), number))
    value = F.concat(F.unhex(F.concat(F.lit("0000000007"), index)), F.col("value"))
    return wire.split_envelope(log.withColumn("value", value)).select(
        *ADDRESS, "schema_id", "message_index", F.col("payload").cast("string").alias("payload")
    )
