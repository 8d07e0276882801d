"""Sending the package to the executors, which unpickle its functions by name."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give every executor of this application the package, once.

    The driver packs its own copy and Spark hands the file out, so neither a shared folder
    nor an installed package is needed. Executors that join later fetch it too.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidelog-"), "tidelog.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                packed.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with the package on the executors before it starts."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
