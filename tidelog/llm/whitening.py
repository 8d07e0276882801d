"""Embedding whitening: distributed covariance, own eigenvectors, broadcast projection."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import table
from tidelog.llm.eigen import EPS, leading
from tidelog.scratch import cut

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
# Entries beyond this size count as this size, so that integers stay exact.
LARGEST = 1 << 50


class Model(NamedTuple):
    """What whitens vectors of one length: ``axes`` are unit eigenvectors as columns."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float

    def deviations(self, rows: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact."""
        if self.n * max(int(np.abs(rows).max(initial=0)), 1) < 1 << 61:
            return rows * self.n - self.sums.astype(np.int64)
        return rows.astype(object) * self.n - self.sums

    def project(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(float) @ self.axes / np.sqrt(self.values)


def integers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows as ``row_`` and ``x``: entries as ``floor(64 * c) + 1000000``.

    Rows whose vector is null or holds null or non-finite entries are left out, and so are
    vectors without entries.
    """
    x = F.transform(F.col(f"`{column}`"), lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    bounded = F.transform(x, lambda v: F.floor(F.greatest(F.least(v * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("long") + SHIFT)
    return vectors.filter(F.coalesce(fine & (F.size(x) > 0), F.lit(False))).select(F.struct("*").alias("row_"), bounded.alias("x"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of one length of a batch: the batch, their places, and their matrix."""
    for batch in batches:
        column = batch.column("x")
        lengths = np.diff(column.offsets.to_numpy())
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            yield batch, at, column.take(pa.array(at)).flatten().to_numpy().reshape(-1, length)


def _sums(batches):
    """Rows and exact sums of a task, for each length."""
    held: dict[int, list] = {}
    for _, _, rows in _groups(batches):
        n, total = held.get(rows.shape[1], (0, 0))
        # Halves, as sums of many large entries leave 64 bits.
        high, low = (rows >> 32).sum(axis=0).astype(object), (rows & 0xFFFFFFFF).sum(axis=0).astype(object)
        held[rows.shape[1]] = [n + len(rows), total + high * (1 << 32) + low]
    for length, (n, total) in held.items():
        yield pa.RecordBatch.from_pydict({
            "dims": pa.array([length] * length, pa.int32()), "i": pa.array(range(length), pa.int32()),
            "n": pa.array([n] * length, pa.int64()), "high": pa.array([int(v) >> 32 for v in total], pa.int64()),
            "low": pa.array([int(v) & 0xFFFFFFFF for v in total], pa.int64()),
        })


def _products(made):
    """Rows of a task's sum of outer products of ``made(rows)``, for each length."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for _, _, rows in _groups(batches):
            values = made(rows)
            held[rows.shape[1]] = held.get(rows.shape[1], 0) + values.T @ values
        for length, product in held.items():
            yield pa.RecordBatch.from_pydict({
                "dims": pa.array([length] * len(product), pa.int32()), "i": pa.array(range(len(product)), pa.int32()),
                "part": pa.array(list(product), pa.list_(pa.float64())),
            })

    return run


def _added(batches):
    """Rows with the same number added up; they come sorted."""
    key, total = None, None
    for batch in batches:
        for dims, i, part in zip(batch.column("dims").to_pylist(), batch.column("i").to_pylist(), batch.column("part")):
            values = part.values.to_numpy()
            if (dims, i) == key:
                total = total + values
                continue
            if key is not None:
                yield _row(key, total)
            key, total = (dims, i), values
    if key is not None:
        yield _row(key, total)


def _row(key: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "dims": pa.array([key[0]], pa.int32()), "i": pa.array([key[1]], pa.int32()), "part": pa.array([total], pa.list_(pa.float64()))
    })


def _matrices(fit: DataFrame, made) -> dict[int, np.ndarray]:
    """Sum of outer products over all rows, for each length.

    A task sends one matrix, in rows; each row is added up on its own, so no task holds the
    matrices of many. What comes to the driver is one matrix for each length.
    """
    kinds = "dims int, i int, part array<double>"
    parts = fit.mapInArrow(_products(made), kinds).repartition("dims", "i").sortWithinPartitions("dims", "i")
    found: dict[int, dict[int, list]] = {}
    for row in parts.mapInArrow(_added, kinds).toArrow().to_pylist():
        found.setdefault(row["dims"], {})[row["i"]] = row["part"]
    return {length: np.array([rows[i] for i in range(len(rows))]) for length, rows in found.items()}


def train(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model for each vector length of ``fit (x)``, whose rows count once each.

    Only sums and one matrix a length come to the driver: both grow with the square of a
    vector's length and not with the rows. Components whose eigenvalue is nothing but
    rounding (below size times 2**-52 of the largest) are left out, as they can't be scaled.
    """
    totals: dict[int, tuple[int, dict]] = {}
    kinds = "dims int, i int, n long, high long, low long"
    summed = fit.mapInArrow(_sums, kinds).groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    for row in summed.toArrow().to_pylist():
        totals.setdefault(row["dims"], (row["n"], {}))[1][row["i"]] = (row["high"] << 32) + row["low"]
    none = np.zeros((0, 0)), np.zeros(0)
    plain = {d: Model(n, np.array([sums[i] for i in range(d)], object), *none, 0.0) for d, (n, sums) in totals.items()}
    centred = _matrices(fit, lambda rows: (plain[rows.shape[1]].deviations(rows) / plain[rows.shape[1]].n).astype(float))
    models = {}
    for length, model in plain.items():
        covariance = centred[length] / model.n
        values, axes = leading((covariance + covariance.T) / 2, components)
        usable = values > EPS * length * max(values[0], 0)
        models[length] = model._replace(axes=axes[:, usable], values=values[usable], trace=float(np.trace(covariance)))
    return models


def identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """Largest entry of the whitened covariance less the identity, for each length, measured on all rows."""

    def whitened(rows):
        # The mean of the whitened rows is none but rounding; it is measured and taken off.
        made = models[rows.shape[1]].project(models[rows.shape[1]].deviations(rows))
        return np.hstack([made, np.ones((len(made), 1))])

    errors = {}
    for length, total in _matrices(fit, whitened).items():
        total = total / models[length].n
        mean = total[-1, :-1]
        covariance = total[:-1, :-1] - np.outer(mean, mean)
        errors[length] = float(np.abs(covariance - np.eye(len(mean))).max(initial=0.0))
    return errors


def _exact(deviations: np.ndarray) -> list[int | None]:
    """Sums of squares; null where one does not fit 64 bits."""
    if deviations.dtype != object and float((deviations.astype(float) ** 2).sum(axis=1).max(initial=0.0)) < 2.0**62:
        return (deviations * deviations).sum(axis=1).tolist()
    sums = [sum(v * v for v in map(int, row)) for row in deviations]
    return [s if s < 1 << 63 else None for s in sums]


def whiten(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error, length``.

    One row for each usable vector and each of its leading components. The model is fitted
    on distinct vectors, so copies weigh nothing; vectors of different lengths have models of
    their own. A null or repeated ``vec_id`` is carried along; entries beyond 2**50 / 64 count
    as that; ``deviation`` is null where it leaves 64 bits. A single distinct vector has no
    component and so no rows, and no rows give no rows. Other columns are ignored.
    """
    rows = integers(vectors.select("vec_id", F.col(f"`{column}`").alias("embedding")))
    fit = cut(rows.select("x").distinct())
    models = train(fit, components)
    errors = identity_errors(fit, models)
    sent = vectors.sparkSession.sparkContext.broadcast((models, errors))

    def run(batches):
        models, errors = sent.value
        for batch, at, x in _groups(batches):
            model = models[x.shape[1]]
            deviations = model.deviations(x)
            width, ids = len(model.values), batch.column("vec_id").take(pa.array(at))
            each = pa.array(np.repeat(np.arange(len(at)), width))
            size = len(at) * width
            yield pa.RecordBatch.from_pydict({
                "vec_id": ids.take(each), "component": pa.array(np.tile(np.arange(1, width + 1), len(at)), pa.int32()),
                "n": pa.array(np.full(size, model.n), pa.int64()),
                "deviation": pa.array(_exact(deviations), pa.int64()).take(each),
                "whitened": pa.array(model.project(deviations).reshape(-1), pa.float64()),
                "explained": pa.array(np.tile(model.values / model.trace if width else model.values, len(at)), pa.float64()),
                "identity_error": pa.array(np.full(size, errors[x.shape[1]]), pa.float64()),
                "length": pa.array(np.full(size, x.shape[1]), pa.int32()),
            })

    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, length int"
    return rows.select(F.col("row_.vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, kinds)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).drop("length")
