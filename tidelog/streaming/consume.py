"""Continuous typed reads with the usual delivery guarantees.

The position of a stream is its checkpoint, written after each micro-batch, so the
guarantee is decided by what the sink does when a batch is run a second time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions.scan import decode_topic
from tidelog.functions.wire import split_envelope
from tidelog.operators.filters import drop_null_values, with_outcome
from tidelog.schemas import Field

Sink = Callable[[DataFrame, int], None]


def typed(
    topic: DataFrame, writers: dict[int, list[Field]], columns: list[Field] | None = None
) -> DataFrame:
    """STR-1: null values skipped, envelopes split, payloads decoded, outcome marked.

    The same for a stream and a bounded table. Every step is row-wise: no shuffle.
    """
    split = split_envelope(drop_null_values(topic)).drop("magic", "message_index")
    return with_outcome(decode_topic(split, writers, columns))


def at_least_once(path: str) -> Sink:
    """STR-2: append, then the position is stored; a batch cut off in between comes again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("append").partitionBy("outcome").parquet(path)

    return write


def at_most_once(path: str, claims: str) -> Sink:
    """STR-3: claim the batch first; a batch claimed before is skipped, even if it was lost."""

    def write(batch: DataFrame, batch_id: int) -> None:
        claim = batch.sparkSession.range(1).selectExpr(f"{batch_id}L as batch_id")
        try:
            claim.write.mode("errorifexists").parquet(f"{claims}/batch_id={batch_id}")
        except AnalysisException as exists:
            if exists.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            return
        batch.write.mode("append").partitionBy("outcome").parquet(path)

    return write


def exactly_once(path: str) -> Sink:
    """STR-4: each batch owns a folder and replaces it when it is run again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/batch_id={batch_id}")

    return write


def with_callback(sink: Sink, callback: Callable[[DataFrame, int], None]) -> Sink:
    """UDF-1: a sink followed by a callback that gets the same batch, for delivery reports."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        callback(batch, batch_id)

    return write


def start(stream: DataFrame, sink: Sink, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start the stream; with ``once`` it reads all that is there and stops (SRC-2).

    Started again with the same checkpoint it goes on where it was (STR-5).
    """
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def replay(topic: DataFrame, fold: Callable[[DataFrame], DataFrame], path: str) -> None:
    """STR-7: rebuild a table from the whole log with the transformations a stream would use."""
    if topic.isStreaming:
        raise ValueError("replay reads the whole log as a bounded table")
    fold(topic).write.mode("overwrite").parquet(path)
