"""Nested and repeated fields against a plain reader, and types from descriptor bytes."""

import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.functions.encode import encode_batch, encode_topic
from tidelog.functions.scan import decode_batch, decode_topic
from tidelog.plans import nested
from tidelog.schemas import Field, struct_of
from tidelog.sources import descriptors as ds

INNER = (Field(1, "a", "int32"), Field(2, "texts", "string", True), Field(3, "deep", "message", True, (Field(1, "x", "sint64"), Field(2, "y", "bool", True))))
OUTER = [
    Field(1, "id", "string"), Field(2, "many", "message", True, INNER), Field(3, "one", "message", False, INNER),
    Field(4, "numbers", "int32", True), Field(5, "reals", "double", True), Field(6, "flags", "bool", True), Field(16, "fixed", "fixed32", True),
    Field(17, "signed", "sfixed64"), Field(18, "times", "timestamp", True), Field(19, "big", "uint64", True),
]


def varint(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def block(no, body):
    return varint(no << 3 | 2) + varint(len(body)) + body


def plain(fields, row):
    """A message of one row, field by field."""
    out = b""
    for f in fields:
        v = row[f.name]
        many = v if f.repeated else [] if v is None else [v]
        one = {
            "string": lambda x: x.encode(), "message": lambda x: plain(f.inner, x), "double": lambda x: struct.pack("<d", x),
            "fixed32": lambda x: struct.pack("<I", x), "sfixed64": lambda x: struct.pack("<q", x), "int32": varint, "bool": varint,
            "uint64": varint, "sint64": lambda x: varint(x << 1 ^ x >> 63),
            "timestamp": lambda x: (varint(8) + varint(x) if x else b""),
        }[f.type]
        if f.type in ("string", "message", "timestamp"):
            out += b"".join(block(f.no, one(x)) for x in many if f.repeated or f.type != "string" or x)
        elif f.repeated:
            out += block(f.no, b"".join(map(one, many))) if many else b""
        elif v:
            wire = {"double": 1, "sfixed64": 1, "fixed32": 5}.get(f.type, 0)
            out += varint(f.no << 3 | wire) + one(v)
    return out


def made(r, depth=0):
    some = lambda make, top=4: [make() for _ in range(r.randint(0, top))]
    inner = lambda: {
        "a": r.choice([0, 1, -5, 2**31 - 1]), "texts": some(lambda: r.choice(["", "é", "word" * r.randint(0, 40)])),
        "deep": some(lambda: {"x": r.choice([0, -1, 2**62, -2**63]), "y": some(lambda: r.random() < 0.5)}),
    }
    return {
        "id": r.choice(["", "order"]), "many": some(inner), "one": r.choice([None, inner()]), "numbers": some(lambda: r.choice([0, 1, -1, 300])),
        "reals": some(lambda: r.choice([0.0, -2.5])), "flags": some(lambda: r.random() < 0.5), "fixed": some(lambda: r.choice([0, 2**32 - 1])),
        "signed": r.choice([0, -7]), "times": some(lambda: r.choice([0, 5, 1_700_000_000])), "big": some(lambda: r.choice([0, 2**64 - 1])),
    }


def shown(row):
    """A decoded row with times as seconds and decimals as numbers."""
    return {**row, "times": [int(t.timestamp()) for t in row["times"]], "big": [int(b) for b in row["big"]]}


def test_against_a_plain_coder(spark):
    r = random.Random(5)
    rows = [made(r) for _ in range(300)]
    want = [plain(OUTER, row) for row in rows]
    columns, error, mismatch = decode_batch(pa.array(want, pa.binary()), OUTER)
    assert set(error) == {None} and not mismatch.any()
    read = [shown(row) for row in pa.RecordBatch.from_arrays(columns, [f.name for f in OUTER]).to_pylist()]
    assert read == rows
    typed = {f.name: c for f, c in zip(OUTER, columns)}
    assert encode_batch(typed, OUTER, len(rows)).to_pylist() == want
    # Through Spark and back, lists of rows in slices of batches included.
    frame = spark.createDataFrame([(1, bytearray(b)) for b in want], "schema_id int, payload binary")
    out = decode_topic(frame, {1: OUTER}, OUTER).drop("schema_id", "wire_mismatch", "decode_error")
    assert out.schema == struct_of(OUTER)
    assert sorted(bytes(x.payload) for x in encode_topic(out, OUTER).collect()) == sorted(want)


def test_numbers_one_by_one_pieces_and_faults():
    fields = [Field(4, "numbers", "int32", True), Field(5, "reals", "double", True), Field(3, "one", "message", False, INNER)]
    rows = [
        varint(4 << 3) + varint(7) + block(4, varint(300) + varint(1)) + varint(4 << 3) + varint(9),  # mixed, in wire order
        block(3, varint(8) + varint(5)) + block(3, block(2, b"t")),  # one message sent in pieces
        block(4, b"\x80"), block(5, b"\x00" * 9), block(3, b"\x0a\xff"), varint(5 << 3) + varint(3), b"",
    ]
    columns, error, mismatch = decode_batch(pa.array(rows, pa.binary()), fields)
    got = pa.RecordBatch.from_arrays(columns, ["numbers", "reals", "one"]).to_pylist()
    assert got[0]["numbers"] == [7, 300, 1, 9] and got[0]["one"] is None
    assert got[1]["one"] == {"a": 5, "texts": ["t"], "deep": []}
    assert list(error) == [None, None, "broken message", "broken message", "broken message", None, None]
    assert mismatch.tolist() == [False] * 5 + [True, False]
    assert got[6] == {"numbers": [], "reals": [], "one": None}


def descriptor(name, fields, nested_types=(), ranges=(), names=()):
    body = block(1, name.encode())
    for no, field, label, kind, type_name in fields:
        body += block(2, block(1, field.encode()) + varint(24) + varint(no) + varint(32) + varint(label) + varint(40) + varint(kind) + (block(6, type_name.encode()) if type_name else b""))
    body += b"".join(block(3, n) for n in nested_types)
    body += b"".join(block(9, varint(8) + varint(a) + varint(16) + varint(b)) for a, b in ranges)
    return body + b"".join(block(10, n.encode()) for n in names)


TREE = descriptor(
    "Tree", [(1, "label", 1, 9, ""), (2, "children", 3, 11, ".shop.Tree"), (3, "leaf", 1, 11, ".shop.Tree.Leaf"), (4, "at", 1, 11, ds.TIMESTAMP), (5, "else_", 1, 11, ".not.There")],
    [descriptor("Leaf", [(1, "sizes", 3, 17, ""), (2, "up", 1, 11, ".shop.Tree"), (3, "kind", 1, 14, ".shop.Kind")])], [(7, 8), (1000, 536_870_912)], ["old"],
)


@pytest.fixture(scope="module")
def registry(spark):
    file = block(1, b"tree.proto") + block(2, b"shop") + block(4, TREE) + block(4, descriptor("Note", [(1000, "text", 1, 9, "")]))
    rows = [("trees-value", 1, 5, "Tree", bytearray(file)), ("copy-value", 1, 5, "Tree", bytearray(file)), ("bad-value", 1, 6, "Tree", bytearray(b"\xff"))]
    return spark.createDataFrame(rows, "subject string, version int, schema_id int, message string, descriptor binary")


def test_descriptors_with_nested_and_recursive_types(spark, registry):
    rows = ds.message_fields(registry)
    kept = {(r.message, r.field_no, r.name, r.type, r.repeated) for r in rows.where("not reserved").collect()}
    assert kept == {
        (".shop.Tree", 1, "label", "string", False), (".shop.Tree", 2, "children", "message", True), (".shop.Tree", 3, "leaf", "message", False),
        (".shop.Tree", 4, "at", "timestamp", False), (".shop.Tree", 5, "else_", "message", False), (".shop.Tree.Leaf", 1, "sizes", "sint32", True),
        (".shop.Tree.Leaf", 2, "up", "message", False), (".shop.Tree.Leaf", 3, "kind", "enum", False), (".shop.Note", 1000, "text", "string", False),
    }
    assert {(r.field_no, r.last_no, r.name) for r in rows.where("reserved").collect()} == {(7, 7, None), (1000, 536_870_911, None), (None, None, "old")}
    declared = ds.declared_fields(rows.where("message = '.shop.Tree'").unionByName(rows.where("message = '.shop.Note'").withColumn("message", F.lit(".shop.Tree"))))
    assert {(r.field_no, r.name) for r in declared.where("reserved").collect()} == {(1000, None), (0, "old")}
    mapping = spark.createDataFrame([("trees", ".shop.Tree"), ("copy", ".shop.Tree.Leaf"), ("bad", ".shop.Tree"), ("none", ".shop.Tree")], "topic string, message string")
    got = {r.topic: r.layout for r in ds.topic_types(registry, rows, mapping).collect()}
    leaf = "struct<sizes:array<int>,up:binary,kind:int>"
    assert got["trees"] == f"struct<label:string,children:array<binary>,leaf:{leaf},at:timestamp,else_:binary>"
    assert got["copy"] == "struct<sizes:array<int>,up:struct<label:string,children:array<binary>,leaf:binary,at:timestamp,else_:binary>,kind:int>"
    assert got["bad"] is None and "none" not in got


@pytest.mark.parametrize("limit", [1_000, 0])
def test_records_are_read_with_the_registry(spark, registry, limit):
    found = ds.message_fields(registry)
    writers = ds.writer_fields(found, spark.createDataFrame([(5, ".shop.Tree")], "schema_id int, message string"))
    columns = ds.reader_fields(writers, 5)
    assert [f.name for f in columns] == ["label", "children", "leaf", "at", "else_"] and columns[2].inner[0] == Field(1, "sizes", "sint32", True)
    body = block(1, b"root") + block(2, block(1, b"child")) + block(3, block(1, varint(3) + varint(4)) + varint(24) + varint(2))
    df = spark.createDataFrame([(5, bytearray(body)), (9, bytearray(body)), (None, None)], "schema_id int, payload binary")
    got = {r.schema_id: r for r in ds.decode_registry(df, writers, columns, rows=limit).collect()}
    assert got[5].label == "root" and bytes(got[5].children[0]) == block(1, b"child") and got[5].decode_error is None
    assert got[5].leaf.sizes == [-2, 2] and got[5].leaf.kind == 2 and bytes(got[5].leaf.up) == b""
    assert got[9].decode_error == got[None].decode_error == "unknown schema id" and got[9].children == []


def test_an_older_writer_with_other_names_inside(spark):
    writer = [Field(2, "many", "message", True, (Field(1, "old_name", "int32"),))]
    reader = [Field(2, "many", "message", True, (Field(1, "new_name", "int64"), Field(9, "added", "string", True)))]
    df = spark.createDataFrame([(1, bytearray(block(2, varint(8) + varint(5)) * 2))], "schema_id int, payload binary")
    row = decode_topic(df, {1: writer}, reader).first()
    assert [(m.new_name, m.added) for m in row.many] == [(5, [])] * 2


def test_orders_without_lines(spark):
    assert nested.baskets(spark, "/root/testdata/sf0.001").where("lines is null").count() >= 0
    empty = spark.createDataFrame([], struct_of(nested.BASKET))
    assert encode_topic(empty, nested.BASKET).count() == 0
