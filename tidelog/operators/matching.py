"""Comparisons between logs, deliveries, schemas and topic lists, as joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.lookup import lookup

ADDRESS = ["topic", "partition", "offset"]


def with_schema(df: DataFrame, registry: DataFrame) -> DataFrame:
    """JN-1: writer schema of each record; unknown ids stay, with ``known = false``."""
    ids = registry.select("schema_id", "message").distinct().withColumn("_hit", F.lit(True))
    return lookup(df, ids, ["schema_id"], "left").withColumn(
        "known", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")


def compare_readers(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """JN-2: the same records under two reader schemas, one row per address.

    ``columns`` exist on both sides; ``outcome`` is same, differs, only_a or only_b.
    The join key is the record address, which is unique, so no key can be hot.
    """
    left = a.select(*ADDRESS, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("_a"))
    right = b.select(*ADDRESS, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("_b"))
    equal = F.lit(True)
    for c in columns:
        equal = equal & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    return left.join(right, ADDRESS, "full").withColumn(
        "outcome",
        F.when(F.col("_b").isNull(), "only_a")
        .when(F.col("_a").isNull(), "only_b")
        .when(equal, "same")
        .otherwise("differs"),
    ).drop("_a", "_b")


def lost_records(delivery: DataFrame, log: DataFrame, identity: list[str]) -> DataFrame:
    """JN-3: acknowledged records that are not in the log.

    ``identity`` names columns that identify one record on both sides.
    """
    acked = delivery.where(F.col("error").isNull() & F.col("acked_at").isNotNull())
    return acked.join(log.select(*identity), identity, "left_anti")


def _piece(text: str, length: str, i: int, pieces: int, shift: int = 0) -> str:
    """SQL for piece ``i`` of a text cut evenly into ``pieces`` for a total of ``length``."""
    size = f"cast(ceil({length} / {pieces}) as int)"
    start = f"greatest(1, {i} * {size} + 1 + ({shift}))"
    return f"substring({text}, {start}, greatest(0, least({size}, {length} - {i} * {size})))"


def ghost_topics(log: DataFrame, allowed: DataFrame, max_dist: int = 2) -> DataFrame:
    """JN-4: written topics that are not allowed, with the nearest allowed name, if near enough.

    The log is reduced to topic counts first. Two names within ``max_dist`` edits share at
    least one of ``max_dist + 1`` pieces unchanged, moved by at most ``max_dist`` places,
    so candidates come from an equality join on pieces and are then measured exactly.
    """
    written = log.groupBy("topic").agg(F.count("*").alias("n_records"))
    names = allowed.select(F.col("topic").alias("nearest")).distinct()
    ghosts = written.join(names, written["topic"] == names["nearest"], "left_anti")

    pieces = range(max_dist + 1)
    own = [f"struct({i} as i, {_piece('nearest', 'len', i, max_dist + 1)} as piece)" for i in pieces]
    keys = names.withColumn("len", F.char_length("nearest")).selectExpr(
        "nearest", "len", f"inline(array({', '.join(own)}))"
    )
    tried = [
        f"struct({i} as i, {_piece('topic', 'len', i, max_dist + 1, shift)} as piece)"
        for i in pieces
        for shift in range(-max_dist, max_dist + 1)
    ]
    lengths = f"explode(sequence(char_length(topic) - {max_dist}, char_length(topic) + {max_dist})) as len"
    probes = ghosts.selectExpr("topic", lengths).where("len > 0").selectExpr(
        "topic", "len", f"inline(array({', '.join(tried)}))"
    )
    close = (
        probes.join(keys, ["len", "i", "piece"])
        .select("topic", "nearest").distinct()
        .withColumn("distance", F.levenshtein("topic", "nearest"))
        .where(F.col("distance") <= max_dist)
        .groupBy("topic")
        .agg(F.min(F.struct("distance", "nearest")).alias("best"))
        .select("topic", "best.nearest", "best.distance")
    )
    return ghosts.join(close, "topic", "left")


def consume_by_member(log: DataFrame, assignment: DataFrame) -> DataFrame:
    """JN-5: records with the group member that reads their partition."""
    return lookup(log, assignment, ["topic", "partition"])


def silent_topics(allowed: DataFrame, log: DataFrame) -> DataFrame:
    """JN-6: allowed topics nobody has written to."""
    return allowed.select("topic").distinct().join(log.select("topic").distinct(), "topic", "left_anti")


def unfinished(assigned: DataFrame, done: DataFrame) -> DataFrame:
    """SET-1: assigned partitions that have not reported their end; empty when a drain is complete."""
    return assigned.select("topic", "partition").subtract(done.select("topic", "partition"))


def missing_addresses(a: DataFrame, b: DataFrame) -> DataFrame:
    """SET-2: addresses of run ``a`` that run ``b`` did not see."""
    return a.select(*ADDRESS).subtract(b.select(*ADDRESS))
