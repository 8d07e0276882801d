"""Row filters and splits over a topic table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidelog.operators.lookup import lookup


def drop_null_values(df: DataFrame, counted: Observation | None = None) -> DataFrame:
    """FLT-1: records with a value; the skipped ones are counted in the same pass."""
    if counted is not None:
        df = df.observe(counted, F.count_if(F.col("value").isNull()).alias("skipped"))
    return df.where(F.col("value").isNotNull())


def split_errors(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT-2: good rows, and rows whose decoding failed."""
    good = decoded.where(F.col("decode_error").isNull()).drop("decode_error")
    return good, decoded.where(F.col("decode_error").isNotNull())


def with_outcome(decoded: DataFrame) -> DataFrame:
    """FLT-2 for one-pass writes: ``partitionBy('outcome')`` separates good from dead."""
    return decoded.withColumn(
        "outcome", F.when(F.col("decode_error").isNull(), "good").otherwise("dead")
    )


def event_kind(error: str) -> Column:
    """FLT-3: data, end-of-partition or error, from the error code of a polled event."""
    code = F.col(error)
    return (
        F.when(code.isNull(), "data").when(code == "_PARTITION_EOF", "eof").otherwise("error")
    )


def check_size(df: DataFrame, config: DataFrame) -> DataFrame:
    """FLT-4: error ``MESSAGE_TOO_LARGE`` on records over their topic's limit, null elsewhere."""
    limits = config.select("topic", "message_max_bytes")
    too_large = F.octet_length("value") > F.col("message_max_bytes")
    return lookup(df, limits, ["topic"], "left").withColumn(
        "error", F.when(too_large, F.lit("MESSAGE_TOO_LARGE"))
    ).drop("message_max_bytes")


def topics_like(log: DataFrame, text: str, prefix: bool = False) -> DataFrame:
    """FLT-5: topics whose name contains or starts with a text."""
    topic = F.col("topic")
    return log.where(topic.startswith(text) if prefix else topic.contains(text)).select(
        "topic"
    ).distinct()
