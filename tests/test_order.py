"""Numbering and running values over blocks, against plain windows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.operators import ordering
from tidelog.operators.blocks import _ranged, before, number_rows
from tidelog.operators.lookup import lookup, settled
from tidelog.scratch import cut


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def log(spark):
    r = random.Random(7)
    data, used = [], set()
    for i in range(3000):
        part = r.choice([0, 0, 0, 1])
        data.append(("t", part, i * 3 + r.randint(0, 2), r.randint(0, 40), r.choice(["a", "b", None])))
    return spark.createDataFrame(data, "topic string, partition int, offset bigint, x bigint, key string").repartition(5)


@pytest.mark.parametrize("width", [7, 100, 1 << 20])
def test_numbering_by_block(log, width):
    w = Window.partitionBy("topic", "partition").orderBy("offset")
    want = log.withColumn("n", F.row_number().over(w) - 1)
    got = number_rows(log, ["topic", "partition"], ["offset"], "n", unique="offset", width=width)
    assert rows(got.select(want.columns).fillna("-")) == rows(want.fillna("-"))


def test_numbering_by_range_with_ties(log):
    got = number_rows(log, ["topic", "partition"], ["x"], "n").select("partition", "x", "n").collect()
    for part in (0, 1):
        mine = sorted((r.n, r.x) for r in got if r.partition == part)
        assert [n for n, _ in mine] == list(range(len(mine)))
        assert [x for _, x in mine] == sorted(x for _, x in mine)


@pytest.mark.parametrize("ranges", [None, 1, 40, 400])
def test_numbering_by_splitters(spark, ranges):
    """Nulls in groups and order, one value with half of all rows, several order columns."""
    df = spark.range(4000).selectExpr(
        "if(id % 3 = 0, 'a', if(id % 3 = 1, 'b', null)) g", "if(id % 2 = 0, 7, cast(hash(id) % 50 as int)) x",
        "if(id % 5 = 0, null, cast(hash(id) as string)) y", "timestamp_seconds(id % 100) t", "id",
    ).repartition(5)
    out = number_rows(df, ["g"], ["x", "t", "y"], "n", ranges=ranges)
    assert out.columns == [*df.columns, "n"]
    got = out.collect()
    assert sorted(r.id for r in got) == list(range(4000))
    for g in ("a", "b", None):
        mine = sorted((r.n, r.x, r.t, r.y is not None, r.y or "") for r in got if r.g == g)
        assert [r[0] for r in mine] == list(range(len(mine)))
        assert [r[1:] for r in mine] == sorted(r[1:] for r in mine)


def test_numbering_keeps_input_order_of_ties(spark):
    df = spark.range(0, 1000, 1, 4).selectExpr("'k' g", "1 x", "id")
    got = number_rows(df, ["g"], ["x"], "n", ranges=30).collect()
    assert [r.id for r in sorted(got, key=lambda r: r.n)] == list(range(1000))


def test_splitters_spread_a_hot_value(spark):
    """A value with two thirds of all rows takes as many ranges as it needs."""
    df = cut(spark.range(0, 20_000, 1, 4).selectExpr("'k' g", "if(id % 3 < 2, 5, cast(id % 100 as int)) x", "id _seen"))
    sizes = [r["count"] for r in _ranged(df, ["g", "x", "_seen"], 20).groupBy("_blk").count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) >= 20 and max(sizes) < 5 * 20_000 / 20


def test_numbering_by_splitters_moves_only_what_is_asked_for(spark):
    df = spark.range(1000).selectExpr("'k' g", "id % 10 x", "repeat('p', 500) payload")
    out = number_rows(df, ["g"], ["x"], "n", ranges=8)
    plan = out.select("x", "n")._jdf.queryExecution().executedPlan().toString()
    assert "payload" not in plan and "rangepartitioning" not in plan
    assert number_rows(df.where("x > 10"), ["g"], ["x"], "n").count() == 0


@pytest.mark.parametrize("width", [5, 64, 1 << 20])
@pytest.mark.parametrize("keys", [["topic", "partition"], ["topic", "partition", "key"]])
def test_running_values(log, width, keys):
    w = Window.partitionBy(*keys).orderBy("offset")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    want = (
        log.withColumn("hi", F.max("x").over(earlier)).withColumn("lo", F.min("x").over(earlier))
        .withColumn("total", F.coalesce(F.sum("x").over(earlier), F.lit(0)))
        .withColumn("bits", F.coalesce(F.bit_or("x").over(earlier), F.lit(0)))
        .withColumn("prev", F.lag("x").over(w))
    )
    wanted = {"hi": ("max", "x"), "lo": ("min", "x"), "total": ("sum", "x"), "bits": ("bit_or", "x"), "prev": ("last", "x")}
    got = before(log, keys, "offset", wanted, width).select(want.columns)
    order = ["partition", "offset"]
    assert got.orderBy(order).collect() == want.orderBy(order).collect()


def test_last_keeps_null_values(spark):
    df = spark.createDataFrame([("k", 0, "a"), ("k", 1, None), ("k", 12, "c")], "k string, o bigint, v string")
    got = before(df, ["k"], "o", {"prev": ("last", "v")}, 10).orderBy("o").collect()
    assert [r.prev for r in got] == [None, "a", None]


def test_lookup_salted_equals_broadcast(log, spark):
    table = spark.createDataFrame([("t", 0, "m0"), ("t", 2, "m2")], "topic string, partition int, member string")
    assert settled(table, 1) is None
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = lookup(log, table, ["topic", "partition"], how)
        b = lookup(log, table, ["topic", "partition"], how, rows=1)
        assert "monotonically" not in b._jdf.queryExecution().toString()
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


def test_reordered_fixture(spark):
    seqs = [*range(10), *range(20, 30), *range(10, 20)]
    df = spark.createDataFrame([("p", "t", 0, i, s) for i, s in enumerate(seqs)], "producer_id string, topic string, partition int, offset bigint, seq bigint")
    for width in (4, 1 << 20):
        got = ordering.reordered(df, width=width).collect()
        assert sorted(r.seq for r in got) == list(range(10, 20))


def test_offset_gaps(spark):
    df = spark.createDataFrame([("t", 0, o) for o in (0, 1, 2, 7, 8, 20)], "topic string, partition int, offset bigint")
    for width in (3, 1 << 20):
        got = sorted((r.gap_start, r.gap_end, r.missing) for r in ordering.offset_gaps(df, width).collect())
        assert got == [(3, 6, 4), (9, 19, 11)]


def test_liveness_boundary(spark):
    df = spark.createDataFrame([("m", t) for t in (0, 45, 90, 136)], "member_id string, s bigint")
    beats = df.select("member_id", F.timestamp_seconds("s").alias("timestamp"))
    got = ordering.liveness_gaps(beats).collect()
    assert [r.gap_us for r in got] == [46_000_000]


def test_numbering_of_sparse_numbers(spark):
    ids = [(i * 7919) ** 3 % (1 << 59) for i in range(500)]
    df = spark.createDataFrame([("t", 0, i) for i in ids], "topic string, partition int, id bigint")
    got = number_rows(df, ["topic", "partition"], ["id"], "n", unique="id").collect()
    assert {r.id: r.n for r in got} == {v: n for n, v in enumerate(sorted(ids))}


def test_retries_few_many_and_without_sequence(spark, monkeypatch):
    from tidelog.streaming import state

    rows = [("p", "t", 0, i % 40, i) for i in range(100)] + [(None, "t", 0, 1, 200), (None, "t", 0, 1, 201)]
    df = spark.createDataFrame(rows, "producer_id string, topic string, partition int, seq bigint, offset bigint")
    want = [*range(40), 200, 201]
    assert sorted(r.offset for r in state.dedupe_retries(df).collect()) == want
    monkeypatch.setattr(state, "settled", lambda table: None)
    assert sorted(r.offset for r in state.dedupe_retries(df).collect()) == want


def test_null_groups_are_numbered(spark):
    df = spark.createDataFrame([(g, n) for n, g in enumerate([None, "a", None, "b", None])], "g string, n long")
    want = {0: 0, 1: 0, 2: 1, 3: 0, 4: 2}
    for unique in ("n", None):
        rows = number_rows(df, ["g"], ["n"], "at", unique=unique, width=2).collect()
        assert {r.n: r.at for r in rows} == want


def test_salted_lookup_with_nulls_and_light_keys(spark, monkeypatch):
    from tidelog.operators import lookup as module

    monkeypatch.setattr(module, "SHARE", 3)
    log = spark.createDataFrame([("hot" if n < 30 else None if n < 40 else f"k{n}", n) for n in range(60)], "k string, n long")
    table = spark.createDataFrame([("hot", 1), ("k45", 2), (None, 3), ("k99", 4)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a, b = lookup(log, table, ["k"], how), lookup(log, table, ["k"], how, rows=1)
        assert a.columns == b.columns and sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_range_reaches_the_scan(spark):
    from tidelog.scratch import fresh_path
    from tidelog.sources.topics import drain, read_range

    rows = spark.range(4000).selectExpr("'t' topic", "cast(id % 4 as int) partition", "id div 4 offset", "id v")
    path = fresh_path(spark, "landed")
    rows.write.partitionBy("topic", "partition").parquet(path)
    log = spark.read.parquet(path)
    ranges = spark.createDataFrame([("t", 1, 10, 14)], "topic string, partition int, from_offset long, to_offset long")
    found = read_range(log, ranges)
    assert sorted((r.partition, r.offset) for r in found.collect()) == [(1, n) for n in range(10, 14)]
    plan = found._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(offset,10)" in plan and "LessThan(offset,14)" in plan and "partition#" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    ends = spark.createDataFrame([("t", 0, 3), ("t", 2, 1)], "topic string, partition int, log_end long")
    assert sorted((r.partition, r.offset) for r in drain(log, ends).collect()) == [(0, 0), (0, 1), (0, 2), (2, 0)]
    assert drain(log, ends.limit(0)).count() == 0
