"""Run queries against their SQL twins: ``python tests/check.py [sf] [name ...]``."""

import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def engine(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(frame: pd.DataFrame):
    frame = frame[sorted(frame.columns)]
    clean = frame.astype(object).where(frame.notna(), None)
    return sorted((tuple(map(_plain, r)) for r in clean.itertuples(index=False)), key=repr)


def _plain(v):
    if hasattr(v, "item"):
        v = v.item()
    return int(v) if isinstance(v, float) and v.is_integer() else v


def compare(spark_rows: pd.DataFrame, duck_rows: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(spark_rows.columns) != sorted(duck_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(duck_rows.columns)}"
    a, b = rows(spark_rows), rows(duck_rows)
    if len(a) != len(b):
        return f"{len(a)} / {len(b)} rows"
    if a != b:
        bad = next((x, y) for x, y in zip(a, b) if x != y)
        return f"first difference {bad[0]} / {bad[1]}"
    return None


KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def types_differ(spark_frame, relation) -> str | None:
    """What differs between the column types of both engines, if anything."""
    a = dict(spark_frame.dtypes)
    b = {n: KINDS.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    return None if a == b else f"types {sorted(set(a.items()) ^ set(b.items()))}"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = engine(sf), e.oracle_sql()
    failed = 0
    for name, fn in e.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            frame = fn(spark, sf)
            got = frame.toPandas()
            took, began = time.time() - began, time.time()
            twin = con.sql(oracles[name])
            wrong = types_differ(frame, twin) or compare(got, twin.df())
            duck = time.time() - began
        except Exception as error:  # report and go on with the next query
            took, duck, wrong, got = time.time() - began, 0, f"{type(error).__name__}: {str(error)[:600]}", []
        failed += wrong is not None
        print(f"{'ok  ' if wrong is None else 'FAIL'} {name:24s} {len(got):7d} rows {took:6.2f} s  twin {duck:5.2f} s  {wrong or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
