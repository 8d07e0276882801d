"""Exact top-k search by inner product: ball trees per shard, branch and bound."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import table
from tidelog.scratch import cut

TOP = 5
SCALE = 256
SHARD_ROWS = 8_192
LEAF = 64


class BallTree:
    """Balls around halves of halves; ``ids`` and integer ``rows`` of one length."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        self.ids, self.rows = ids, rows
        points = rows.astype(np.float64)
        self.centers, self.radii, self.children, self.members = [], [], [], []
        todo = [(np.arange(len(ids)), -1)]
        while todo:
            at, parent = todo.pop()
            center = points[at].mean(axis=0)
            node = len(self.centers)
            self.centers.append(center)
            self.radii.append(float(np.sqrt(((points[at] - center) ** 2).sum(axis=1).max())))
            self.children.append([])
            self.members.append(at if len(at) <= leaf or self.radii[-1] == 0 else None)
            if parent >= 0:
                self.children[parent].append(node)
            if self.members[-1] is None:
                # Cut at the median along the line between two points that lie far apart.
                far = points[at[((points[at] - points[at[0]]) ** 2).sum(axis=1).argmax()]]
                other = points[at[((points[at] - far) ** 2).sum(axis=1).argmax()]]
                order = np.argsort(points[at] @ (other - far), kind="stable")
                todo += [(at[order[: len(at) // 2]], node), (at[order[len(at) // 2 :]], node)]
        self.centers, self.radii = np.array(self.centers), np.array(self.radii)

    def search(self, own: int, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """Up to ``k`` best ``(score, id)`` without ``own``; none that is below ``floor``."""
        point = query.astype(np.float64)
        length = float(np.sqrt(point @ point))
        # A little room for rounding, so that no ball is left out that holds a tie.
        bounds = self.centers @ point + length * self.radii
        bounds += 1e-9 * (np.abs(bounds) + length * (self.radii + 1)) + 1e-6
        open_ = [(-bounds[0], 0)]
        best: list[tuple[int, int]] = []  # of (score, -id), the worst first
        while open_:
            bound, node = heapq.heappop(open_)
            worst = best[0][0] if len(best) == k else floor
            if worst is not None and -bound < worst:
                break
            if (at := self.members[node]) is None:
                for child in self.children[node]:
                    heapq.heappush(open_, (-bounds[child], child))
                continue
            scores = self.rows[at] @ query
            some = np.flatnonzero(scores >= worst) if worst is not None else range(len(at))
            for i in some:
                item = int(scores[i]), -int(self.ids[at[i]])
                if -item[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(score, -number) for score, number in sorted(best, reverse=True)]


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, row``: components as ``floor(scale * x)``; unusable vectors are left out."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.filter("vec_id is not null").filter(F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("row")
    )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows with one shard and side."""
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("dims", "shard", "side"))))
        at = 0
        while at < len(keys):
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            yield keys[at], batch.slice(at, end - at)
            at = end


def _matrix(part: pa.RecordBatch, dims: int) -> np.ndarray:
    return part.column("row").flatten().to_numpy().reshape(-1, dims)


def _visit(k: int):
    def run(batches):
        key, held, tree = None, [], None
        for (dims, shard, side), part in _shards(batches):
            if (dims, shard) != key:
                key, held, tree = (dims, shard), [], None
            if side == 0:
                held.append(part)
                continue
            if not held:
                continue
            if tree is None:
                tree = BallTree(np.concatenate([p.column("vec_id").to_numpy() for p in held]), np.concatenate([_matrix(p, dims) for p in held]))
            out = []
            for number, floor, row in zip(part.column("vec_id").to_pylist(), part.column("floor").to_pylist(), _matrix(part, dims)):
                out += [(number, v, s) for s, v in tree.search(number, row, k, floor)]
            yield pa.RecordBatch.from_pydict({
                "query_id": pa.array([o[0] for o in out], pa.int64()), "vec_id": pa.array([o[1] for o in out], pa.int64()),
                "score": pa.array([o[2] for o in out], pa.int64()),
            })

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best inner products of every query.

    Both tables are ``vec_id, row``. Each query first searches one shard; its kth score
    then goes with it to all other shards, where balls are opened in order of their upper
    bound until no ball can reach it. Ties go to the smaller ``vec_id``; a query never
    finds its own id; vectors are compared with those of their own length. Fewer than
    ``k`` candidates are all returned; a repeated id is a candidate each time.
    """
    rows = cut(vectors.filter("size(row) > 0").withColumn("dims", F.size("row")))
    count = max(1, -(-rows.count() // shard_rows))
    home = F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    indexed = rows.select("dims", home.alias("shard"), F.lit(0).alias("side"), "vec_id", F.lit(None).cast("long").alias("floor"), "row")
    asked = cut(queries.filter("size(row) > 0").dropDuplicates(["vec_id"]).withColumn("dims", F.size("row")).withColumn("home", home))

    def ask(wanted: DataFrame) -> DataFrame:
        both = indexed.union(wanted.select("dims", "shard", F.lit(1).alias("side"), "vec_id", "floor", "row"))
        dealt = both.repartition("dims", "shard").sortWithinPartitions("dims", "shard", "side")
        return dealt.mapInArrow(_visit(k), "query_id long, vec_id long, score long")

    first = cut(ask(asked.withColumn("shard", F.col("home")).withColumn("floor", F.lit(None).cast("long"))))
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).select(
        F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("least")).alias("floor")
    )
    others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(count - 1)), lambda s: s != F.col("home")))
    rest = ask(asked.join(kth, "vec_id", "left").withColumn("shard", others)) if count > 1 else first.limit(0)
    return _best(first.union(rest), k).select("query_id", "rank", "vec_id", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(integers(table(spark, sf_dir, "embeddings")))
    return top_k(rows, rows.filter("vec_id % 50 = 0"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS r FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.r) + 1), lambda i: q.r[i] * c.r[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.r) = len(c.r) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 5
"""
