"""Settings of every topic that occurs, whether it is configured or not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a broker applies to a topic without settings of its own; None never applies.
BROKER = {
    "retention_ms": 7 * 86_400_000, "retention_bytes": None, "segment_bytes": 1 << 30, "segment_ms": 7 * 86_400_000,
    "cleanup_policy": "delete",
}
UNLIMITED = -1


def settings(seen: DataFrame, config: DataFrame, columns: list[str], broker: dict = BROKER) -> DataFrame:
    """``topic`` and ``columns`` for each topic of ``seen``, one row per topic.

    A topic without a row gets the values of ``broker``. A limit of -1 is no limit, and so
    is a null in a row.
    """
    known = config.select("topic", *columns, F.lit(True).alias("_known"))
    kinds = dict(config.dtypes)

    def value(name: str):
        own = F.col(name) if kinds[name] == "string" else F.when(F.col(name) != UNLIMITED, F.col(name))
        return F.when(F.col("_known"), own).otherwise(F.lit(broker[name]).cast(kinds[name])).alias(name)

    return seen.select("topic").distinct().join(known, "topic", "left").select("topic", *map(value, columns))
