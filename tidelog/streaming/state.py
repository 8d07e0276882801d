"""Stateful streams: dropping retries and keeping the latest value per key."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.lookup import settled
from tidelog.operators.retention import compact
from tidelog.schemas import struct

SEQUENCE = ["producer_id", "topic", "partition", "seq"]


def dedupe_retries(df: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """STR-6: one record per producer, partition and sequence.

    On a bounded table the earliest copy stays. Sequences are counted without payloads, and
    only those that occur twice are joined back, by broadcast if they are few. Records
    without a sequence are not compared. On a stream the first copy to arrive stays, and
    copies are recognised for as long as the watermark says.
    """
    if df.isStreaming:
        return df.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(SEQUENCE)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in SEQUENCE])
    repeated = (
        df.where(whole).groupBy(*SEQUENCE).agg(F.min("offset").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1").drop("_n")
    )
    only = F.col("_first").isNull() | (F.col("offset") == F.col("_first"))
    few = settled(repeated)
    if few is not None:
        return df.join(F.broadcast(few), SEQUENCE, "left").where(only).select(*df.columns)
    # Records without a sequence would all meet in one task of a shuffle.
    marked = df.where(whole).join(repeated, SEQUENCE, "left").where(only).select(*df.columns)
    return marked.unionByName(df.where(~whole))


def write_changes(path: str):
    """First half of STR-9: append each micro-batch reduced to one record per key.

    The reduction is map-side, so a key that fills a third of a batch reaches the stateful
    half as one row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        compact(batch).write.mode("append").parquet(path)

    return write


_CHANGE = struct(
    "topic string, partition int, key binary, offset bigint, timestamp timestamp, value binary, deleted boolean"
)
_HELD = "offset bigint, timestamp timestamp, value binary"


class _Latest(StatefulProcessor):
    """Holds the newest record of one key; of a tombstone only the offset."""

    def __init__(self, tombstone_ms: int | None) -> None:
        self._tombstone_ms = tombstone_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("held", _HELD)
        self._gone = handle.getValueState("gone", "offset bigint", self._tombstone_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = max(rows, key=lambda r: r["offset"])
        if any(s.exists() and s.get()[0] >= newest["offset"] for s in (self._held, self._gone)):
            return
        gone = newest["value"] is None
        if gone:
            self._held.clear()
            self._gone.update((newest["offset"],))
        else:
            self._gone.clear()
            self._held.update((newest["offset"], newest["timestamp"], newest["value"]))
        yield Row(
            topic=key[0], partition=key[1], key=key[2], offset=newest["offset"],
            timestamp=newest["timestamp"], value=newest["value"], deleted=gone,
        )

    def close(self) -> None:
        pass


def current_state(changes: DataFrame, delete_retention_ms: int | None = None) -> DataFrame:
    """STR-9: stream of changes to the latest value per key; ``deleted`` marks tombstones.

    ``changes`` reads what ``write_changes`` wrote. State is the newest record of each key, of
    a tombstone without a value, so that an older record that comes later does not bring the
    key back. It is an aggregate of the stream, so no row leaves the JVM; a batch gives the
    state of the keys it touched.

    With ``delete_retention_ms`` the offset of a tombstone is let go so long after it
    arrived, by a timer of a stateful processor for each key; Spark then goes on starting
    batches, so a query that is to end with its input (``availableNow``) must not have it.
    """
    if delete_retention_ms is None:
        newest = changes.groupBy("topic", "partition", "key").agg(F.max_by(F.struct("offset", "timestamp", "value"), "offset").alias("r"))
        return newest.select("topic", "partition", "key", "r.*", F.col("r.value").isNull().alias("deleted"))
    spark = changes.sparkSession
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return changes.groupBy("topic", "partition", "key").transformWithState(
        statefulProcessor=_Latest(delete_retention_ms), outputStructType=_CHANGE, outputMode="Update", timeMode="ProcessingTime"
    )


def state_table(changes: DataFrame) -> DataFrame:
    """The live table after all changes seen so far."""
    rest = [c for c in changes.columns if c not in ("topic", "partition", "key")]
    newest = changes.groupBy("topic", "partition", "key").agg(F.max_by(F.struct(*rest), "offset").alias("r"))
    return newest.select("topic", "partition", "key", "r.*").where(~F.col("deleted")).drop("deleted")
