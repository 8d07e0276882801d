"""Schema changes with known verdicts, long histories, and registration."""

import json
import os
import random
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from tidelog.operators import registry as reg
from tidelog.operators.blocks import before, before_all

REGISTRY = "subject string, version int, schema_id int, message string, descriptor binary"
FIELDS = "schema_id int, field_no int, name string, type string, reserved boolean"
BASE = [(1, "id", "string"), (2, "qty", "int32"), (3, "item", "string")]

# change -> (new fields, compatible, kind of the changed number in a field diff)
CASES = {
    "add": (BASE + [(4, "region", "string")], True),
    "delete": (BASE[:2], True),
    "rename": ([(1, "key", "string"), *BASE[1:]], True),
    "text to bytes": ([(1, "id", "bytes"), *BASE[1:]], True),
    "wider number": ([BASE[0], (2, "qty", "int64"), BASE[2]], True),
    "text to number": ([(1, "id", "int32"), *BASE[1:]], False),
    "renumber": ([*BASE[:2], (8, "item", "string")], False),
    "plain to sint": ([BASE[0], (2, "qty", "sint32"), BASE[2]], False),
}


def build(spark, histories):
    """Tables for ``{subject: [fields of version 1, of version 2, ...]}``."""
    registry, fields, schema_id = [], [], 0
    for subject, versions in histories.items():
        for number, declared in enumerate(versions, 1):
            schema_id += 1
            registry.append((subject, number, schema_id, "M", b"%d" % schema_id))
            fields += [(schema_id, f[0], f[1], f[2], len(f) > 3) for f in declared]
    return spark.createDataFrame(registry, REGISTRY), spark.createDataFrame(fields, FIELDS)


def verdicts(spark, histories, width=reg.WIDTH):
    out = reg.compat(*build(spark, histories), width=width).collect()
    return {(r.subject, r.version): r for r in out}


def test_single_changes(spark):
    v = verdicts(spark, {name: [BASE, new] for name, (new, _) in CASES.items()})
    for name, (_, ok) in CASES.items():
        r = v[(name, 2)]
        assert [r.backward, r.forward, r.full, r.transitive_backward, r.transitive_full] == [ok] * 5, name
        assert r.none and v[(name, 1)].transitive_full
    assert v[("rename", 2)].source_break and not v[("add", 2)].source_break


@pytest.mark.parametrize("width", [2, reg.WIDTH])
def test_only_transitive_modes_look_further_back(spark, width):
    v = verdicts(spark, {
        "reuse": [BASE, BASE[:2], [*BASE[:2], (3, "note", "string")]],
        "back again": [BASE, BASE[:2], BASE],
        "reserved": [BASE, [*BASE[:2], (3, "item", "string", True)], BASE],
        "long ago": [BASE, BASE[:2], BASE[:2], BASE[:2], [*BASE[:2], (3, "item", "sint32")]],
    }, width)
    r = v[("reuse", 3)]
    assert r.backward and not r.transitive_backward and r.number_reused
    assert v[("back again", 3)].transitive_full and not v[("back again", 3)].number_reused
    assert not v[("reserved", 3)].backward and v[("reserved", 3)].number_reused
    r = v[("long ago", 5)]
    assert r.full and not r.transitive_full


def test_long_history_in_blocks(spark):
    r = random.Random(11)
    history = []
    for _ in range(60):
        names = r.sample(["a", "b", "c", "d", "e"], 3)
        fields = [(n, name, r.choice(["string", "bytes", "int32", "sint32"])) for n, name in zip(r.sample(range(1, 6), 3), names)]
        history.append(fields if r.random() < 0.7 else [(*fields[0], True), *fields[1:]])
    assert verdicts(spark, {"s": history}, 4) == verdicts(spark, {"s": history})


@pytest.mark.parametrize("width", [2, 5])
def test_groupings_carried_together(spark, width):
    """Two groupings at once, each as ``before`` has it; a null group is one like any other."""
    r = random.Random(5)
    rows = [(home, i, a, r.choice("xyz"), r.random() < 0.8, r.randrange(9)) for home in ("s", None) for i in range(40) for a in r.sample(range(3), 2)]
    rows = [x for n, x in enumerate(rows) if not any(x[:2] == y[:2] and x[3] == y[3] for y in rows[:n])]
    df = spark.createDataFrame(rows, "h string, i int, a int, b string, ok boolean, v int")
    wanted = {"_last": ("last", "v"), "_sum": ("sum", "v"), "_low": ("min", "v"), "_bits": ("bit_or", "v")}
    by_b = {f"{out}_b": what for out, what in wanted.items()}
    both = before_all(df, ["h"], "i", [(["a"], wanted, F.lit(True)), (["b"], by_b, F.col("ok"))], width)
    told = lambda d, outs: sorted(map(str, d.select("h", "i", "a", "b", *outs).collect()))
    assert told(both, wanted) == told(before(df, ["h", "a"], "i", wanted, width), wanted)
    assert told(both.where("ok"), by_b) == told(before(df.where("ok"), ["h", "b"], "i", by_b, width), by_b)


@pytest.mark.parametrize("query, most", [("compat_blocks", 270), ("field_lifetimes", 130)])
def test_bytes_shuffled_by_blocks_of_two(tmp_path, query, most):
    """Bytes shuffled for each declared field of a registry (383 and 211 when rows moved once for every grouping)."""
    con = duckdb.connect()
    con.sql("CREATE TABLE o AS SELECT i AS o_orderkey, hash(i) % 2000 AS c, CASE hash(i, 1) % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'P' ELSE 'F' END AS o_orderstatus FROM range(20000) t(i)")
    con.sql(f"COPY (SELECT o_orderkey, c::BIGINT AS o_custkey, o_orderstatus FROM o) TO '{tmp_path}/orders.parquet'")
    con.sql(f"""COPY (SELECT o_orderkey AS l_orderkey, (n + 1)::INTEGER AS l_linenumber, CASE hash(o_orderkey, n) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS l_returnflag,
        CASE hash(o_orderkey, n, 2) % 2 WHEN 0 THEN 'F' ELSE 'O' END AS l_linestatus, (hash(o_orderkey, n, 3) % 9)::DOUBLE / 100 AS l_tax
        FROM o, range(7) t(n) WHERE n <= hash(o_orderkey, 4) % 7) TO '{tmp_path}/lineitem.parquet'""")
    con.sql(f"COPY (SELECT l_orderkey FROM '{tmp_path}/lineitem.parquet') TO '{tmp_path}/events.parquet'")
    bench = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "bench.py")
    env = os.environ | {"BENCH_SF_DIR": str(tmp_path), "BENCH_CPUS": "4"}
    done = subprocess.run([sys.executable, bench, query], env=env, capture_output=True, text=True, check=True, timeout=600)
    assert 0 < json.loads(done.stdout.splitlines()[-1])["shuffle_bytes_per_event"][query] < most


def test_field_diff_and_types(spark):
    old = spark.createDataFrame([("s", *f) for f in BASE], "subject string, field_no int, name string, type string")
    new = spark.createDataFrame(
        [("s", 1, "key", "string"), ("s", 2, "qty", "sint32"), ("s", 8, "item", "string"), ("s", 4, "region", "string")],
        "subject string, field_no int, name string, type string",
    )
    got = {r.field_no: r.change for r in reg.field_diff(old, new, ["subject"]).collect()}
    assert got == {1: "renamed", 2: "retyped", 3: "renumbered", 4: "added", 8: "renumbered"}
    pairs = [("string", "bytes"), ("int32", "int64"), ("string", "int32"), ("int32", "sint32"), ("bool", "bool")]
    changes = spark.createDataFrame(pairs, "old_type string, new_type string")
    got = {(r.old_type, r.new_type): r.backward and r.forward for r in reg.type_change(changes).collect()}
    assert got == dict(zip(pairs, [True, True, False, False, True]))


def test_reserved(spark):
    registry, fields = build(spark, {"s": [BASE, [*BASE[:2], (3, "item", "string", True)], [*BASE[:2], (3, "x", "string"), (9, "item", "string")]]})
    got = {(r.field_no, r.number_reserved, r.name_reserved) for r in reg.reserved_use(registry, fields).collect()}
    assert got == {(3, True, False), (9, False, True)}


def test_registration(spark):
    def new(*rows):
        return spark.createDataFrame(rows, "subject string, message string, descriptor binary")

    def state(r):
        return {(x.subject, x.version, x.schema_id, bytes(x.descriptor)) for x in r.collect()}

    empty = spark.createDataFrame([], REGISTRY)
    first = reg.register(empty, new(("order-value", "Order", b"v1"), ("pay-value", "Payment", b"p1")))
    assert state(first) == {("order-value", 1, 1, b"v1"), ("pay-value", 1, 2, b"p1")}
    again = reg.register(first, new(("order-value", "Order", b"v1"), ("order-value", "Order", b"v2"), ("copy-value", "Order", b"v1")))
    assert state(again) == state(first) | {("order-value", 2, 3, b"v2"), ("copy-value", 1, 1, b"v1")}
    assert {(r.subject, r.schema_id) for r in reg.latest(again).collect()} == {("order-value", 3), ("pay-value", 2), ("copy-value", 1)}
    assert {r.subject for r in reg.by_id(again, 1).collect()} == {"order-value", "copy-value"}
    dropped = reg.drop_version(again, "order-value", 1)
    assert reg.subjects(dropped).count() == 3 and reg.live(dropped).count() == 3
    # Neither an id nor a version number comes back; a known schema keeps its id.
    gone = reg.drop_version(dropped, "order-value", 2)
    assert {r.subject for r in reg.subjects(gone).collect()} == {"copy-value", "pay-value"}
    more = reg.register(gone, new(("order-value", "Order", b"v2"), ("order-value", "Order", b"v3")))
    assert state(reg.live(more)) - state(reg.live(gone)) == {("order-value", 3, 3, b"v2"), ("order-value", 4, 4, b"v3")}
    modes = spark.createDataFrame([("a", "FULL"), ("b", None)], "subject string, mode string")
    assert [r.mode for r in reg.modes(modes).orderBy("subject").collect()] == ["FULL", "BACKWARD"]
    assert [r.mode for r in reg.modes(modes, "NONE").orderBy("subject").collect()] == ["FULL", "NONE"]


def test_versions_that_were_dropped_are_not_neighbours(spark):
    first, second, third = BASE, [*BASE, (4, "x", "string")], [(1, "id", "string"), (2, "qty", "string"), (3, "item", "string")]
    registry, fields = build(spark, {"s": [first, second, third]})
    gone = reg.drop_version(registry, "s", 2)
    r = {x.version: x for x in reg.compat(gone, fields).collect()}
    assert set(r) == {1, 3} and not r[3].backward and not r[3].forward and not r[3].full
    # A version that was dropped does not count for the transitive modes either.
    bad = [BASE, [BASE[0], (2, "qty", "string"), BASE[2]], BASE]
    registry, fields = build(spark, {"s": bad})
    assert not {x.version: x for x in reg.compat(registry, fields).collect()}[3].backward
    assert {x.version: x for x in reg.compat(reg.drop_version(registry, "s", 2), fields).collect()}[3].transitive_full
    # Without it a number that it alone declared was never there.
    back = [BASE[:2], BASE, BASE[:2], [*BASE[:2], (3, "note", "string")]]
    registry, fields = build(spark, {"s": back})
    assert {x.version: x for x in reg.compat(registry, fields).collect()}[4].number_reused
    assert not {x.version: x for x in reg.compat(reg.drop_version(registry, "s", 2), fields, width=2).collect()}[4].number_reused


def test_one_sided_rules(spark):
    rules = spark.createDataFrame([("int32", "int64", True, False), ("bytes", "string", False, True), ("odd", "string", True, True)], reg.RULES)
    wide = [BASE[0], (2, "qty", "int64"), BASE[2]]
    registry, fields = build(spark, {"wider": [BASE, wide], "back": [wide, BASE], "text": [[(1, "id", "bytes")], [(1, "id", "string")]], "long": [BASE, wide, wide]})
    v = {(r.subject, r.version): r for r in reg.compat(registry, fields, rules=rules).collect()}
    told = lambda r: (r.backward, r.forward, r.full, r.transitive_backward, r.transitive_forward, r.transitive_full)
    assert told(v["wider", 2]) == (True, False, False, True, False, False)
    assert told(v["back", 2]) == (False, False, False, False, False, False)
    assert told(v["text", 2]) == (False, True, False, False, True, False)
    assert told(v["long", 3]) == (True, True, True, True, False, False)


@pytest.mark.parametrize("width", [2, reg.WIDTH])
def test_lifetimes_and_reuse(spark, width):
    a, b = [(1, "id", "string"), (2, "a", "int32")], [(1, "id", "string"), (2, "b", "int32")]
    gone = [(1, "id", "string")]
    histories = {"renamed": [a, b], "reused": [a, gone, b], "same": [a, gone, a], "held": [a, [*gone, (2, "a", "int32", True)], b], "often": [a, gone, b, gone, a]}
    registry, fields = build(spark, histories)
    runs = reg.lifetimes(registry, fields, width)
    got = {(r.subject, r.name, r.first_version, r.last_version, r.reused) for r in runs.where("field_no = 2").collect()}
    assert got == {
        ("renamed", "a", 1, 1, False), ("renamed", "b", 2, 2, False), ("reused", "a", 1, 1, False), ("reused", "b", 3, 3, True),
        ("same", "a", 1, 1, False), ("same", "a", 3, 3, False), ("held", "a", 1, 1, False), ("held", "b", 3, 3, True),
        ("often", "a", 1, 1, False), ("often", "b", 3, 3, True), ("often", "a", 5, 5, True),
    }
    pairs = spark.createDataFrame([(s, 1, len(h)) for s, h in histories.items()], "subject string, old_version int, new_version int")
    since = {(r.subject, r.field_no) for r in reg.reused_since(runs, pairs).collect()}
    assert since == {("reused", 2), ("held", 2), ("often", 2)}
    # Dropping the version between leaves a plain rename.
    assert {r.reused for r in reg.lifetimes(reg.drop_version(registry, "reused", 2), fields, width).where("subject = 'reused'").collect()} == {False}


@pytest.mark.parametrize("width", [2, 3, 16])
def test_lifetimes_in_blocks(spark, width):
    """Runs over many blocks, runs between the first and the last one of a block, and names from blocks before."""
    r = random.Random(7)
    histories = {}
    for subject, share in (("often", 0.5), ("seldom", 0.95), ("always", 1.0)):
        name, versions = "a", []
        for _ in range(70):
            name = r.choice("abc") if r.random() > share else name
            versions.append([(2, name, "int32")] * (r.random() < share) + [(1, "id", "string")] * (r.random() < 0.9))
        histories[subject] = versions
    histories["late"] = [[(2, "a", "int32")]] * 16 + [[(2, n, "int32")] if n else [] for n in [*"bb", None, *"bb", None, *"bb", None, "c"]]
    registry, fields = build(spark, histories)
    nobody = registry.where("subject = 'often'").withColumn("subject", F.lit(None).cast("string"))
    registry = registry.unionByName(nobody)
    whole, cut_up = (sorted(map(str, reg.lifetimes(registry, fields, w).select(*RUN).collect())) for w in (reg.WIDTH, width))
    assert whole == cut_up


RUN = ["subject", "field_no", "name", "first_version", "last_version", "first_rank", "last_rank", "reused"]


def test_field_diff_flags(spark):
    kinds = "subject string, field_no int, name string, type string"
    old = spark.createDataFrame([("s", 1, "a", "string"), ("s", 2, "b", "int32"), ("s", 3, "c", "int32")], kinds)
    new = spark.createDataFrame([("s", 1, "z", "int32"), ("s", 5, "b", "int32"), ("s", 6, "n", "bool")], kinds)
    reused = spark.createDataFrame([("s", 6), ("s", 3)], "subject string, field_no int")
    names = ("added", "removed", "renamed", "retyped", "renumbered", "reused")
    got = {r.field_no: {n for n in names if r[n]} for r in reg.field_diff(old, new, ["subject"], reused).collect()}
    assert got == {1: {"renamed", "retyped"}, 2: {"removed", "renumbered"}, 3: {"removed"}, 5: {"added", "renumbered"}, 6: {"added", "reused"}}
