"""Joining a log with a metadata table (positions, assignments, settings, schemas)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Metadata of at most so many rows and bytes is broadcast; larger tables are shuffled.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
SALTS = 64
# A key with more than one in so many rows of the log is heavy; there are fewer than that.
SHARE = 1_000


def settled(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """The table evaluated once, if it has at most ``rows`` rows of bounded width; else None.

    No more than ``rows + 1`` rows are fetched. What is behind such a table may be a pass
    over a whole log, so it is not run a second time to fill the broadcast.
    """
    found = table.limit(rows + 1).toArrow()
    if found.num_rows > rows or found.nbytes > BROADCAST_BYTES:
        return None
    return table.sparkSession.createDataFrame(found, table.schema)


def lookup(
    log: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "inner",
    rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a log with a small table on columns that repeat heavily in the log.

    The table is broadcast when it is checked to be small. Otherwise both are shuffled, and
    the rows of a heavy key, such as a topic partition with a third of the log, are shared
    by many tasks: they take a salt from a hash of their other columns, which a task that
    runs again finds anew, and the few heavy rows of the table are repeated once per salt.
    Null keys, which find nothing, are spread alike. ``how`` is inner, left, left_semi or
    left_anti with the log on the left.
    """
    small = settled(table, rows)
    if small is not None:
        return log.join(F.broadcast(small), on, how)
    mark = F.lit(True).alias("_heavy")
    heavy = F.broadcast(_heavy(log, on)).select(*on, mark)
    spread = F.pmod(F.xxhash64(*_hashable(log)), F.lit(SALTS)).cast("int")
    alone = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    salt = F.when(F.col("_heavy") | alone, spread).otherwise(F.lit(0))
    salted = log.join(heavy, on, "left").withColumn("_salt", salt).drop("_heavy")
    last = F.when(F.col("_heavy"), F.lit(SALTS - 1)).otherwise(F.lit(0))
    copies = table.join(heavy, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_heavy")
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def _heavy(log: DataFrame, on: list[str]) -> DataFrame:
    """The keys with more than one in ``SHARE`` rows, fewer than ``SHARE`` of them."""
    keys = log.select(*on)
    least = keys.count() // SHARE
    found = keys.groupBy(*on).count().where(F.col("count") > least).select(*on).toArrow()
    return log.sparkSession.createDataFrame(found, keys.schema)


def _hashable(log: DataFrame) -> list[str]:
    """Columns that tell rows apart: the offset if there is one, else all that have a hash."""
    if "offset" in log.columns:
        return ["offset"]
    return [f.name for f in log.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
