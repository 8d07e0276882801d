"""Lag of running streams from their progress reports (STR-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

_OFFSETS = "map<string, map<string, bigint>>"
_REPORT = "id string, batchId bigint, timestamp timestamp, sources array<struct<endOffset string, latestOffset string>>"


class LagListener(StreamingQueryListener):
    """Appends every progress report, one JSON text per row, to a table of reports.

    A report is a few hundred bytes per micro-batch, whatever the batch holds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        row = [(event.progress.json,)]
        self._spark.createDataFrame(row, "value string").write.mode("append").text(self._path)

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass


def lag_listener(spark: SparkSession, path: str) -> LagListener:
    """Start keeping progress reports of all streams of this session below ``path``."""
    listener = LagListener(spark, path)
    spark.streams.addListener(listener)
    return listener


def progress_lag(reports: DataFrame, text: str = "value") -> DataFrame:
    """Processed offset, log end and lag per stream, batch and partition, from report texts.

    The shape fits ``lag_trend``: ``group_id`` is the stream, ``snapshot`` the batch.
    """
    r = reports.select(F.from_json(text, _REPORT).alias("r")).select(
        F.col("r.id").alias("group_id"), F.col("r.batchId").alias("snapshot"), F.explode("r.sources").alias("s")
    )
    done = r.select(
        "group_id", "snapshot", F.from_json("s.latestOffset", _OFFSETS).alias("ends"),
        F.explode(F.from_json("s.endOffset", _OFFSETS)).alias("topic", "at"),
    )
    one = done.select("group_id", "snapshot", "ends", "topic", F.explode("at").alias("p", "committed"))
    end = F.try_element_at(F.try_element_at(F.col("ends"), F.col("topic")), F.col("p"))
    return one.select(
        "group_id", "snapshot", "topic", F.col("p").cast("int").alias("partition"), "committed",
        end.alias("log_end"), (end - F.col("committed")).alias("lag"),
    )
