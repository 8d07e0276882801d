"""Which partition a record goes to, which member reads a partition, which topic a record belongs in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def key_hash(key: str) -> Column:
    """A 32-bit number from the key's MD5; the same key always gives the same number."""
    return F.expr(f"cast(conv(substr(md5(cast({key} as binary)), 1, 8), 16, 10) as bigint)")


def key_partition(key: str, partitions: int) -> Column:
    return F.pmod(key_hash(key), F.lit(partitions)).cast("int")


def assign_partition(
    df: DataFrame, key: str, partitions: int, record_id: str | None = None
) -> DataFrame:
    """PRT-1, PRT-2: partition by key hash; null keys are spread evenly by ``record_id``.

    Row-wise, so no shuffle and no global counter: spreading null keys by the same hash, of
    the record id, is even, and the same on every run.
    """
    chosen = key_partition(key, partitions)
    if record_id is not None:
        spread = key_partition(f"cast({record_id} as string)", partitions)
        chosen = F.when(F.col(key).isNull(), spread).otherwise(chosen)
    return df.withColumn("partition", chosen)


def remap(df: DataFrame, key: str, old: int, new: int) -> DataFrame:
    """PRT-3: keys and records that change partition when the count goes from old to new."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    moved = key_partition(key, old) != key_partition(key, new)
    return per_key.agg(
        F.count("*").alias("n_keys"),
        F.count_if(moved).alias("moved_keys"),
        F.sum("n").cast("bigint").alias("n_records"),
        F.coalesce(F.sum(F.when(moved, F.col("n"))), F.lit(0)).cast("bigint").alias("moved_records"),
    )


def assign_members(partitions: DataFrame, members: DataFrame) -> DataFrame:
    """PRT-4: each partition of a topic goes to exactly one member of a group, in turn.

    ``partitions(topic, partition)``, ``members(group_id, topic, member_id)``. Both are
    metadata tables; members beyond the partition count get no row.
    """
    p = partitions.select("topic", "partition").distinct().withColumn(
        "_rank", F.row_number().over(Window.partitionBy("topic").orderBy("partition")) - 1
    )
    group = Window.partitionBy("group_id", "topic")
    m = members.select(
        "group_id",
        "topic",
        "member_id",
        (F.row_number().over(group.orderBy("member_id")) - 1).alias("_slot"),
        F.count("*").over(group).alias("_size"),
    )
    sizes = m.select("group_id", "topic", "_size").distinct()
    slots = p.join(sizes, "topic").withColumn("_slot", F.pmod("_rank", "_size").cast("int"))
    return slots.join(m.drop("_size"), ["group_id", "topic", "_slot"]).select(
        "group_id", "topic", "partition", "member_id"
    )


def route(df: DataFrame, rules: list[tuple[Column, str]], dead_letter: str) -> DataFrame:
    """PRT-5: column ``target_topic`` from the first rule that holds, else the dead-letter topic."""
    chosen = reduce(lambda c, r: c.when(r[0], F.lit(r[1])), rules[1:], F.when(rules[0][0], F.lit(rules[0][1])))
    return df.withColumn("target_topic", chosen.otherwise(F.lit(dead_letter)))


def write_routed(df: DataFrame, path: str) -> None:
    """Write every target topic in one pass over the input."""
    df.write.mode("append").partitionBy("target_topic").parquet(path)
