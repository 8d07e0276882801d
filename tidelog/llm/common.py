"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word contracts: blank, and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
# A helper table up to this many bytes in Arrow is broadcast; a larger one is shuffled.
SMALL_BYTES = 32 << 20
SMALL_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attach(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a helper table that is broadcast only when its size is checked.

    At most ``SMALL_ROWS + 1`` rows are fetched. A longer or wider table is joined by a
    shuffle, where adaptive execution splits keys that hold many rows.
    """
    found = small.limit(SMALL_ROWS + 1).toArrow()
    if found.num_rows <= SMALL_ROWS and found.nbytes <= SMALL_BYTES:
        small = F.broadcast(small.sparkSession.createDataFrame(found, small.schema))
    return big.join(small, on, how)


def quantiles(df: DataFrame, column: str, parts: int) -> list:
    """Up to ``parts - 1`` values of an integral column that cut it in near-equal parts.

    One aggregate with a sketch of bounded size; nulls are left out. Sorted, no repeats.
    """
    if parts < 2:
        return []
    shares = ",".join(repr(i / parts) for i in range(1, parts))
    row = df.agg(F.expr(f"percentile_approx(`{column}`, array({shares}), {20 * parts})").alias("q")).first()
    return sorted(set(row["q"] or []))


def block_of(column: str, bounds: list[int]) -> Column:
    """Number of bounds that are not above the column, by binary search; 0 for null."""
    def search(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"if(`{column}` >= {int(bounds[mid])}L, {search(mid + 1, hi)}, {search(lo, mid)})"

    return F.expr(search(0, len(bounds))).cast("int")


def block_number(value: int | None, bounds: list[int]) -> int:
    """The same for one Python value."""
    return 0 if value is None else bisect.bisect_right(bounds, value)
