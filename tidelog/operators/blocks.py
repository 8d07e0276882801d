"""Ordered work on logs whose partitions are too large for one task.

A topic often has only a handful of partitions, so a plain window over
``(topic, partition)`` would put a third of the log into one task. Everything here cuts an
ordered group into blocks of bounded row count first, reduces each block to one summary
row by partial aggregation, runs the ordered step over the summaries, and joins the result
back. Only bounded blocks are ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.scratch import cut

# Rows of one block when the ordering column is unique within its group.
BLOCK = 1 << 20
# Ranges of any other order, at most, and sampled rows for each of them.
RANGES = 1 << 16
SAMPLED = 16


def block_id(order: str, width: int = BLOCK) -> Column:
    """Block number of a non-negative, unique, integral ordering column."""
    return F.expr(f"cast(`{order}` as bigint) div {int(width)}L")


def number_rows(
    df: DataFrame,
    groups: list[str],
    order: list[str],
    out: str = "offset",
    unique: str | None = None,
    width: int = BLOCK,
    ranges: int | None = None,
) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... in ``order``.

    ``unique`` names a non-negative integral column that alone fixes the order and has no
    repeats in a group; numbering is then lazy: block counts, a running sum over them, and
    a window inside each block. The numbers may be sparse. For any other order the rows are
    written to the shared folder once, unmoved, and cut into ``ranges`` of about equal size
    by sampled splitters; counting reads the order columns alone, and only columns that are
    asked for later take part in the one shuffle. Rows equal on ``order`` keep their input
    order and do not pile up in one task.
    """
    if unique is not None:
        return _number_blocks(df, groups, unique, out, width)
    return _number_ranges(df, groups, order, out, ranges)


def _starts(sizes: DataFrame, groups: list[str], part: str) -> DataFrame:
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return sizes.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))


def _number_blocks(df, groups, unique, out, width):
    # A struct compares equal with nulls inside, so a null group is a group like any other.
    marked = df.withColumn("_spot", F.struct(*groups, block_id(unique, width).alias("_blk")))
    sizes = marked.groupBy("_spot").agg(F.count("*").alias("_n")).select("_spot", "_spot.*", "_n")
    # Sparse numbers can leave as many blocks as rows, so the blocks are summed in blocks too.
    starts = before(sizes, groups, "_blk", {"_start": ("sum", "_n")}, width).select("_spot", "_start")
    inside = Window.partitionBy("_spot").orderBy(unique)
    return (
        # A left join, though every block is found: it adds no null checks on computed keys.
        marked.join(starts, "_spot", "left")
        .withColumn(out, F.row_number().over(inside) - 1 + F.col("_start"))
        .drop("_spot", "_start")
    )


def _number_ranges(df, groups, order, out, ranges):
    # Written once, where it is: all passes below must see the same rows in the same order.
    seen = cut(df.withColumn("_seen", F.monotonically_increasing_id()))
    by = [*groups, *order, "_seen"]
    marked = _ranged(seen, by, ranges).withColumn("_spot", F.struct(*groups, "_blk")).drop("_blk")
    sizes = marked.groupBy("_spot").agg(F.count("*").alias("_n")).select("_spot", "_spot.*", "_n")
    starts = _starts(sizes, groups, "_blk").select("_spot", "_start")
    inside = Window.partitionBy("_spot").orderBy(*order, "_seen")
    return (
        marked.join(starts, "_spot", "left")
        .withColumn(out, F.row_number().over(inside) - 1 + F.col("_start"))
        .drop("_spot", "_start", "_seen")
    )


def _ranged(df: DataFrame, by: list[str], ranges: int | None) -> DataFrame:
    """Add ``_blk``, the range of a row in the order ``by``: how many splitters are not above it.

    The splitters are a written table of one row, so every pass places a row alike. They
    come from a sample, which decides how even the ranges are and nothing else.
    """
    total = df.count()
    if ranges is None:
        ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BLOCK))
    ranges = min(ranges, RANGES)
    share = min(1.0, ranges * SAMPLED / max(total, 1))
    every = max(1, int(total * share) // ranges)
    sampled = df.select(F.struct(*by).alias("_row")).sample(share, seed=1)
    ordered = sampled.agg(F.sort_array(F.collect_list("_row")).alias("_all"))
    splitters = cut(ordered.select(F.filter("_all", lambda _, i: i % every == every - 1).alias("_at")))
    count = splitters.select(F.size("_at")).first()[0]
    if not count:
        return df.withColumn("_blk", F.lit(0))
    steps, row = F.array(*[F.lit(1 << k) for k in reversed(range(count.bit_length()))]), F.struct(*by)
    # Binary search: a step is taken if the splitter it leads to exists and is not above the row.
    taken = F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((at + step <= count) & (F.get("_splitters", at + step - 1) <= row), at + step).otherwise(at),
    )
    # The optimizer moves the subquery into the search, so no row carries the splitters.
    return df.withColumn("_splitters", splitters.scalar()).withColumn("_blk", taken).drop("_splitters")


def before(
    df: DataFrame,
    keys: list[str],
    order: str,
    wanted: dict[str, tuple[str, str]],
    width: int = BLOCK,
    inclusive: bool = False,
    top: int | None = None,
) -> DataFrame:
    """Add aggregates over all rows that come before a row in its group.

    ``wanted`` maps an output column to ``(kind, column)``; kinds are ``max``, ``min``,
    ``sum``, ``bit_or`` and ``last`` (the value in the row just before). ``order`` must be
    a non-negative integral column, unique in its group. With ``inclusive`` the row
    itself counts too (not for ``last``). ``top`` is the highest value of ``order``, if it
    is known: when it is below ``width`` every group is one block, and no carrying is needed.
    """
    if top is not None and top < width:
        return _within(df, keys, order, wanted, inclusive)
    # One struct holds the group and the block: structs compare equal with nulls inside, and
    # the join and the window below then share one shuffle.
    marked = df.withColumn("_at", F.struct(*keys, block_id(order, width).alias("_blk")))
    summary = marked.groupBy("_at").agg(
        *[_block_value(kind, col, order).alias(f"_b_{out}") for out, (kind, col) in wanted.items()]
    )
    blocks = Window.partitionBy(*[f"_at.{k}" for k in keys]).orderBy("_at._blk")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        "_at",
        *[
            (F.lag(f"_b_{out}").over(blocks) if kind == "last"
             else _over(kind, f"_b_{out}", earlier)).alias(f"_c_{out}")
            for out, (kind, _) in wanted.items()
        ],
    )
    inside = Window.partitionBy("_at").orderBy(order)
    frame = inside.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    joined = marked.join(carry, "_at", "left")
    for out, (kind, col) in wanted.items():
        if kind == "last":
            near = F.lag(F.struct(F.col(col).alias("v"))).over(inside)
            value = F.coalesce(near, F.col(f"_c_{out}"))["v"]
        else:
            value = _combine(kind, _over(kind, col, frame), F.col(f"_c_{out}"))
        joined = joined.withColumn(out, value)
    return joined.drop("_at", *[f"_c_{out}" for out in wanted])


def before_all(df: DataFrame, home: list[str], order: str, histories: list[tuple], width: int = BLOCK) -> DataFrame:
    """``before`` for several groupings of one table at once; every group lies within a ``home``.

    ``histories`` are ``(keys, wanted, only)``: groups by ``home`` and ``keys``, ``wanted`` as
    in ``before`` or with expressions, and a condition on the rows that count and get values.
    All rows of a block of ``home`` are moved together and once for all groupings, next to
    each other, so what they share packs well. Carried values come back as rows that stand
    just before their block, only where there is something to carry. ``df`` is read more than
    once: hand it in written.
    """
    histories = [(keys, {o: (kind, F.col(c) if isinstance(c, str) else c) for o, (kind, c) in wanted.items()}, only) for keys, wanted, only in histories]
    spot = [*home, "_blk"]
    rows = both = df.withColumn("_blk", block_id(order, width))
    kind_of = df.schema[order].dataType
    for i, (keys, wanted, only) in enumerate(histories):
        summary = rows.where(only).repartition(*spot).groupBy(*spot, *keys).agg(
            *[F.max_by(col, order).alias(f"_b_{out}") if kind == "last" else _block_value(kind, col, order).alias(f"_b_{out}")
              for out, (kind, col) in wanted.items()]
        )
        blocks = Window.partitionBy(*home, *keys).orderBy("_blk")
        earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
        carry = summary.repartition(*home).select(
            *spot, *keys, (F.col("_blk") * width - 1).cast(kind_of).alias(order), F.lit(i).alias("_of"),
            *[(F.lag(f"_b_{out}").over(blocks) if kind == "last" else _over(kind, f"_b_{out}", earlier)).alias(f"_c_{out}")
              for out, (kind, _) in wanted.items()],
            F.row_number().over(blocks).alias("_turn"),
        )
        both = both.unionByName(carry.where("_turn > 1").drop("_turn"), allowMissingColumns=True)
    own = F.col("_of").isNull()
    both = both.repartition(*spot)
    for i, (keys, wanted, only) in enumerate(histories):
        counts = F.coalesce(F.when(own, only).otherwise(F.col("_of") == i), F.lit(False))
        group = Window.partitionBy(*spot, *keys, counts).orderBy(order)
        frame = group.rowsBetween(Window.unboundedPreceding, -1)
        for out, (kind, col) in wanted.items():
            col = F.when(own, col).otherwise(F.col(f"_c_{out}"))
            value = F.lag(col).over(group) if kind == "last" else _over(kind, col, frame)
            if kind in ("sum", "bit_or"):
                value = F.coalesce(value, F.lit(0))
            both = both.withColumn(out, F.when(counts, value))
    return both.where(own).drop("_of", "_blk", *[f"_c_{out}" for _, wanted, _ in histories for out in wanted])


def _within(df, keys, order, wanted, inclusive):
    group = Window.partitionBy(*keys).orderBy(order)
    frame = group.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    for out, (kind, col) in wanted.items():
        df = df.withColumn(out, F.lag(col).over(group) if kind == "last" else _over(kind, col, frame))
    return df


def _block_value(kind: str, col: str, order: str) -> Column:
    if kind == "last":
        return F.max_by(F.struct(F.col(col).alias("v")), order)
    return {"max": F.max, "min": F.min, "sum": F.sum, "bit_or": F.bit_or}[kind](col)


def _over(kind: str, col: str, window) -> Column:
    return {"max": F.max, "min": F.min, "sum": F.sum, "bit_or": F.bit_or}[kind](col).over(window)


def _combine(kind: str, near: Column, carried: Column) -> Column:
    if kind == "max":
        return F.greatest(near, carried)
    if kind == "min":
        return F.least(near, carried)
    if kind == "sum":
        return F.coalesce(near, F.lit(0)) + F.coalesce(carried, F.lit(0))
    return F.coalesce(near, F.lit(0)).bitwiseOR(F.coalesce(carried, F.lit(0)))
