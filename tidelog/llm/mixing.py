"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import WORD, attach, table
from tidelog.scratch import cut

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
EPOCHS = 2
# Rows of a source, or of the queue, that one task puts in order.
BLOCK_ROWS = 2_000

SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(cast(doc_id AS VARCHAR), '')) AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 2 * source_size AS cap,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER before, 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM src
  WINDOW before AS (ORDER BY (2 * source_size) / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, w * max(level) OVER ()) AS target FROM filled),
queued AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
items AS (
  SELECT doc_id, source, h, size, p.epoch, (upto + p.epoch * source_size) / target AS finish
  FROM queued, (VALUES (0), (1)) p(epoch) WHERE size > 0),
served AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, h, doc_id NULLS FIRST, size, epoch ROWS UNBOUNDED PRECEDING)
            <= (SELECT 1.5 * sum(size) FROM sized) AS within
  FROM items),
taken AS (SELECT doc_id, source, h, size, sum(size)::BIGINT AS taken FROM served WHERE within GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN taken t
  ON q.doc_id IS NOT DISTINCT FROM t.doc_id AND q.source IS NOT DISTINCT FROM t.source AND q.h = t.h AND q.size = t.size
"""


def sized(docs: DataFrame) -> DataFrame:
    """One narrow row per document: number of words, and the key it is shuffled by."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    spread = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select("doc_id", F.struct(F.col("source")).alias("src"), words.alias("size"), spread.alias("h"))


def targets(sources: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """``(src, rows, source_size)`` with the words each source shall give.

    Water filling: sources in order of ``cap / weight``; the level at which the rest shares
    what capped sources leave is highest exactly at the last capped one. One row per source.
    """
    first = F.col("src.source").asc_nulls_last()
    turn = F.pmod(F.row_number().over(Window.orderBy(first)) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), turn + 1)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("w"), first).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(float(budget)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    shares = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    return (
        sources.withColumn("w", w).withColumn("cap", F.col("source_size") * epochs)
        .withColumn("level", left / shares)
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("w") * F.max("level").over(everything)))
        .drop("w", "cap", "level")
    )


def _key(epoch: int) -> Column:
    finish = (F.col("upto") + F.lit(epoch) * F.col("source_size")) / F.col("target")
    return F.struct(finish.alias("finish"), "src", "h", "doc_id", "size", F.lit(epoch).alias("epoch"))


def mix(
    docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Which documents a mixture takes, and how often.

    Every source is shuffled (by md5 of ``doc_id``) and repeated ``epochs`` times; a
    document's virtual finish time is the number of the source's words up to its end,
    divided by the source's target. All items are range-sorted by that time and taken from
    the front while their words fit in ``budget`` times all words. Running sums are made in
    blocks of a source and in range partitions, so neither a hot source nor the queue is
    ever ordered in one task.

    Gives ``doc_id, source, size, source_size, target, taken, times`` for every row. Null
    or empty texts have size 0 and are taken 0 times; a null source is a source of its own,
    last in order; repeated rows are separate items; no rows give no rows. Other columns
    are ignored.
    """
    rows = cut(sized(docs))
    stats = rows.groupBy("src").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    known = attach(rows, targets(stats, weights, budget, epochs), ["src"])
    slot = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    blocks = F.ceil(F.col("rows") / block_rows)
    marked = known.withColumn("block", F.floor(slot * blocks / F.lit(float(1 << 32))))
    sums = marked.groupBy("src", "block").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("src", "block", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("src", "block").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = cut(
        marked.join(starts, ["src", "block"])
        .withColumn("upto", F.col("start") + F.sum("size").over(inside))
        .drop("rows", "block", "start")
    )
    limit = queued.agg(F.sum("size").alias("n")).first()["n"] or 0
    last = _last_served(queued, budget * limit, epochs)
    times = F.lit(0)
    if last is not None:
        for epoch in range(epochs):
            key = _key(epoch)
            times = times + F.when((F.col("size") > 0) & (key <= last), 1).otherwise(0)
    return queued.withColumn("times", times).select(
        "doc_id", "src.source", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times"
    )


def _last_served(queued: DataFrame, budget: float, epochs: int) -> Column | None:
    """Key of the last item that the budget reaches, as a literal."""
    items = queued.filter("size > 0").select(F.explode(F.array(*[_key(e) for e in range(epochs)])).alias("k"))
    order = ["k.finish", "k.src", "k.h", "k.doc_id", "k.size", "k.epoch"]
    placed = cut(items.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    sums = placed.groupBy("part").agg(F.sum("k.size").alias("words"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    # Only the partition in which the budget ends has to be looked at row by row.
    edge = starts.filter(F.col("start") <= budget).orderBy(F.desc("start"), F.desc("part")).first()
    if edge is None:
        return None
    inside = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)  # rows of one range partition
    served = (
        placed.filter(F.col("part") == edge["part"])
        .withColumn("end", F.sum("k.size").over(inside) + edge["start"])
        .filter(F.col("end") <= budget)
    )
    row = served.agg(F.max("k").alias("k")).first()["k"]
    if row is None:
        before = placed.filter(F.col("part") < edge["part"]).agg(F.max("k").alias("k")).first()["k"]
        row = before
    if row is None:
        return None
    kind = placed.schema["k"].dataType
    return _literal(row, kind)


def _literal(row, kind) -> Column:
    """A struct of the key's type that holds the values of ``row``."""
    parts = []
    for field in kind.fields:
        value = row[field.name]
        if field.name == "src":
            value = F.struct(F.lit(value["source"]).cast("string").alias("source"))
        else:
            value = F.lit(value).cast(field.dataType)
        parts.append(value.alias(field.name))
    return F.struct(*parts)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
