"""Message bytes: hand fixtures, broken input, and the protobuf package where there is one."""

import random
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.functions import records, wire
from tidelog.functions.encode import encode_batch, encode_topic
from tidelog.functions.scan import decode_batch, decode_topic, wire_fields
from tidelog.operators.filters import split_errors
from tidelog.operators.registry import schema_drift
from tidelog.schemas import ORDER_STATUS, ORDER_V1, ORDER_V2, WIRE, Field

ORDER_HEX = "0a036162631204632d34321a084b6579626f6172642148e17a14aebf62402801"
ROW = {"id": "abc", "customer_id": "c-42", "item": "Keyboard", "amount": 149.99, "status": 1}


def values(spark, *hexes):
    rows = [("t", 0, i, h) for i, h in enumerate(hexes)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, h string")
    return df.withColumn("value", F.unhex("h")).drop("h")


def typed_row(spark):
    return spark.createDataFrame(
        [(*ROW.values(), None, "")],
        "id string, customer_id string, item string, amount double, status int, created_at timestamp, region string",
    )


def test_order_bytes(spark):
    df = typed_row(spark)
    coded = encode_topic(df, ORDER_V1)
    assert bytes(coded.first().payload).hex() == ORDER_HEX
    assert df.select(wire.encoded_size(ORDER_V1)).first()[0] == 32


def test_envelope(spark):
    built = typed_row(spark).select(wire.build_envelope(F.lit(1), F.unhex(F.lit(ORDER_HEX))).alias("value"))
    assert bytes(built.first().value).hex() == "000000000100" + ORDER_HEX
    split = wire.split_envelope(built).first()
    assert (split.magic, split.schema_id, split.message_index, bytes(split.payload).hex()) == (0, 1, 0, ORDER_HEX)
    nested = wire.split_envelope(values(spark, "0000000007" + "0202" + "0a0161")).first()
    assert (nested.schema_id, nested.message_index, bytes(nested.payload).hex()) == (7, 1, "0a0161")


def test_classes(spark):
    df = values(spark, "000000000100" + ORDER_HEX, ORDER_HEX, "7b7d", None, "00", "")
    assert [r[0] for r in df.orderBy("offset").select(wire.classify_value()).collect()] == [
        "enveloped", "raw", "foreign", "null", "foreign", "foreign"]


def test_decode_with_dead_letters(spark):
    good = "000000000100" + ORDER_HEX
    wrong_type = "000000000100" + "1805"  # item as a number
    df = values(spark, good, good[:-30], wrong_type, "000000006300" + ORDER_HEX, "000000000100" + "0a02fffe")
    split = wire.split_envelope(df)
    decoded = decode_topic(split, {1: ORDER_V1, 2: ORDER_V2})
    fine, dead = split_errors(decoded)
    assert fine.count() + dead.count() == 5
    by = {r.offset: r for r in decoded.collect()}
    assert {k: getattr(by[0], k) for k in ROW} == ROW and by[0].created_at is None and by[0].region == ""
    assert by[1].decode_error == "broken message"
    assert by[2].decode_error is None and by[2].wire_mismatch and by[2].item == ""
    assert by[3].decode_error == "unknown schema id"
    assert by[4].decode_error == "invalid text"


def test_decode_only_some_columns(spark):
    split = wire.split_envelope(values(spark, "000000000100" + ORDER_HEX))
    out = decode_topic(split, {1: ORDER_V1}, [ORDER_V1[3]])
    assert out.first().amount == 149.99 and "item" not in out.columns


def test_wire_rows_and_drift(spark):
    df = values(spark, ORDER_HEX, "0a", "").withColumn("schema_id", F.lit(1))
    rows = wire_fields(df, ["schema_id", "offset"], "value")
    got = [(r.field_no, r.wire_type, r.length) for r in rows.where("offset = 0").orderBy("field_index").collect()]
    assert got == [(1, 2, 3), (2, 2, 4), (3, 2, 8), (4, 1, 8), (5, 0, 1)]
    assert [(r.offset, r.decode_error) for r in rows.where("decode_error is not null").collect()] == [(1, "broken message")]
    fields = spark.createDataFrame(
        [(1, 1, "id", "string", False), (1, 4, "amount", "int64", False), (1, 9, "note", "string", False)],
        "schema_id int, field_no int, name string, type string, reserved boolean",
    )
    drift = {r.field_no: r.verdict for r in schema_drift(rows, fields).collect()}
    assert drift == {1: "as_declared", 2: "unknown", 3: "unknown", 4: "mismatch", 5: "unknown", 9: "never_seen"}


def test_varint_lengths_and_misread(spark):
    df = spark.createDataFrame([(v,) for v in (1, 127, 128, 300, -1, 2**63 - 1)], "v bigint")
    assert [r[0] for r in df.select(wire.varint_length(F.col("v"))).collect()] == [1, 1, 2, 2, 10, 9]
    df = spark.createDataFrame([(100,), (-1,)], "v bigint")
    assert [tuple(r) for r in df.select(*wire.zigzag_misread(F.col("v"))).collect()] == [(50, 200), (-2147483648, 1)]


def test_set_fields_json_and_line(spark):
    one = typed_row(spark).withColumns({"customer_id": F.lit(""), "item": F.lit(""), "partition": F.lit(0), "offset": F.lit(4)})
    assert one.select(records.set_fields(ORDER_V1)).first()[0] == ["id", "amount", "status"]
    json = one.select(records.json_record(ORDER_V1, {"status": ORDER_STATUS})).first()[0]
    assert json == '{"id":"abc","amount":149.99,"status":"ORDER_STATUS_CREATED"}'
    assert one.select(wire.encoded_size(ORDER_V1)).first()[0] == 16
    full = typed_row(spark).select(records.json_record(ORDER_V1, {"status": ORDER_STATUS})).first()[0]
    assert len(full) > 3 * 32
    line = typed_row(spark).withColumns({"partition": F.lit(0), "offset": F.lit(4)}).select(records.order_line(ORDER_STATUS)).first()[0]
    assert line == "partition=0 offset=4 | id=abc... customer=c-42 item='Keyboard' amount=$149.99 status=ORDER_STATUS_CREATED"


def test_renumbered_field_is_blank_for_the_other_side(spark):
    old = [Field(3, "item", "string")]
    new = [Field(8, "item", "string")]
    df = spark.createDataFrame([("Keyboard",)], "item string")
    seen = {
        (w, r): records.project_reader(df, have, want, []).first().item
        for w, have in (("old", old), ("new", new)) for r, want in (("old", old), ("new", new))
    }
    assert seen == {("old", "old"): "Keyboard", ("old", "new"): "", ("new", "old"): "", ("new", "new"): "Keyboard"}


def test_last_value_wins_and_batches_with_many_rows():
    column = pa.array([bytes.fromhex("0a0161" + "0a0162"), b"", None], pa.binary())
    out, error, _ = decode_batch(column, [Field(1, "id", "string")])
    assert out[0].to_pylist() == ["b", "", ""] and set(error) == {None}


def test_against_protobuf():
    pb2 = pytest.importorskip("google.protobuf.descriptor_pb2")
    from google.protobuf import descriptor_pool, message_factory

    kinds = [k for k in WIRE if k not in ("timestamp", "message")]
    fields = [Field(i * 7 + 1, f"f{i}", k) for i, k in enumerate(kinds)]
    file = pb2.FileDescriptorProto(name="m.proto", syntax="proto3")
    message = file.message_type.add(name="M")
    for f in fields:
        kind = "TYPE_" + {"enum": "int32"}.get(f.type, f.type).upper()
        message.field.add(name=f.name, number=f.no, label=1, type=getattr(pb2.FieldDescriptorProto, kind))
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    make = message_factory.GetMessageClass(pool.FindMessageTypeByName("M"))
    r = random.Random(3)
    any_of = {
        "double": lambda: r.uniform(-1e9, 1e9), "float": lambda: float(np.float32(r.uniform(-9, 9))),
        "int32": lambda: r.randint(-2**31, 2**31 - 1), "sint32": lambda: r.randint(-2**31, 2**31 - 1),
        "int64": lambda: r.randint(-2**63, 2**63 - 1), "sint64": lambda: r.randint(-2**63, 2**63 - 1),
        "uint32": lambda: r.randint(0, 2**32 - 1), "uint64": lambda: r.randint(0, 2**64 - 1),
        "fixed32": lambda: r.randint(0, 2**32 - 1), "fixed64": lambda: r.randint(0, 2**64 - 1),
        "sfixed32": lambda: r.randint(-2**31, 2**31 - 1), "sfixed64": lambda: r.randint(-2**63, 2**63 - 1),
        "enum": lambda: r.randint(0, 9), "bool": lambda: r.random() < 0.5,
        "string": lambda: "é" * r.randint(0, 99), "bytes": lambda: r.randbytes(r.randint(0, 300)),
    }
    arrow = {
        "double": pa.float64(), "float": pa.float32(), "int64": pa.int64(), "sint64": pa.int64(), "uint32": pa.int64(),
        "fixed32": pa.int64(), "fixed64": pa.decimal128(20, 0), "sfixed64": pa.int64(), "uint64": pa.decimal128(20, 0), "bool": pa.bool_(), "string": pa.string(), "bytes": pa.binary(),
    }
    rows = [{f.name: any_of[f.type]() for f in fields} for _ in range(200)]
    want = [make(**row).SerializeToString(deterministic=True) for row in rows]
    columns = {
        f.name: pa.array([Decimal(x[f.name]) if f.type in ("uint64", "fixed64") else x[f.name] for x in rows], arrow.get(f.type, pa.int32()))
        for f in fields
    }
    assert encode_batch(columns, fields, len(rows)).to_pylist() == want
    out, error, mismatch = decode_batch(pa.array(want, pa.binary()), fields)
    assert set(error) == {None} and not mismatch.any()
    for f, got in zip(fields, out):
        assert [int(v) if f.type in ("uint64", "fixed64") else v for v in got.to_pylist()] == [x[f.name] for x in rows]


def test_envelope_with_high_message_index(spark):
    from tidelog.functions.wire import split_envelope

    lead = b"\x00\x00\x00\x00\x05"
    rows = [(lead + index + b"\x0a\x01a", n) for n, index in ((0, b"\x00"), (63, b"\x02\x7e"), (64, b"\x02\x80\x01"), (10_000, b"\x02\xa0\x9c\x01"))]
    got = split_envelope(spark.createDataFrame(rows, "value binary, n int")).collect()
    assert all(r["message_index"] == r["n"] and bytes(r["payload"]) == b"\x0a\x01a" and r["schema_id"] == 5 for r in got)


def test_envelope_with_nested_index_of_several_bytes(spark):
    got = wire.split_envelope(values(spark, "0000000007" + "04" + "8001" + "02" + "0a0161")).first()
    assert (got.schema_id, got.message_index, bytes(got.payload).hex()) == (7, 64, "0a0161")
    assert wire.split_envelope(values(spark, "0000000007" + "06" + "80")).first().payload is None


def test_size_of_negative_zero_and_high_numbers(spark):
    fields = [Field(300_000, "a", "int32"), Field(1, "b", "double"), Field(2, "c", "float"), Field(3, "d", "uint64")]
    df = spark.createDataFrame(
        [(1, 0.0, 0.0, Decimal(0)), (0, -0.0, 1.0, Decimal(2**64 - 1)), (0, 0.0, -0.0, None), (0, float("nan"), 0.0, Decimal(2**63))],
        "a int, b double, c float, d decimal(20,0)",
    )
    sized = df.withColumn("n", wire.encoded_size(fields[:3]))
    coded = encode_topic(sized.drop("d"), fields[:3]).select("n", F.octet_length("payload").alias("m")).collect()
    assert [(r.n, r.m) for r in coded] == [(5, 5), (14, 14), (5, 5), (9, 9)]
    big = encode_topic(df.select("d"), fields[3:]).select(F.hex("payload").alias("x")).collect()
    assert [r.x for r in big] == ["", "18" + "FF" * 9 + "01", "", "18" + "80" * 9 + "01"]
