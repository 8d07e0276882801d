"""Table shapes and message definitions used across the package."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(),
    "int": T.IntegerType(), "bigint": T.LongType(), "decimal(20,0)": T.DecimalType(20, 0),
    "float": T.FloatType(), "double": T.DoubleType(), "timestamp": T.TimestampType(),
    "array<bigint>": T.ArrayType(T.LongType()),
}


def struct(columns: str) -> T.StructType:
    """``"a int, b string"`` as a schema, without needing a running session."""
    pairs = [c.split(" ") for c in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TOPIC = struct(
    "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary"
)
COMMITS = struct("group_id string, topic string, partition int, committed bigint")
SUBSCRIPTIONS = struct("group_id string, topic string")
REGISTRY = struct(
    "subject string, version int, schema_id int, message string, descriptor binary"
)
FIELDS = struct(
    "schema_id int, field_no int, name string, type string, reserved boolean"
)
DELIVERY = struct(
    "producer_id string, topic string, partition int, seq bigint, key binary, offset bigint, "
    "sent_at timestamp, acked_at timestamp, error string, linger_ms int"
)
TOPIC_CONFIG = struct(
    "topic string, partitions int, replication int, retention_ms bigint, retention_bytes bigint, "
    "segment_bytes bigint, segment_ms bigint, cleanup_policy string, message_max_bytes bigint"
)


class Field(NamedTuple):
    """One message field: wire number, name, Protobuf type (enums are ``enum``).

    A field of type ``message`` holds the fields of ``inner``; a ``repeated`` one is a list.
    """

    no: int
    name: str
    type: str
    repeated: bool = False
    inner: tuple[Field, ...] = ()


# Message layouts and enum numbers must equal the published schemas.
ORDER_V1 = [
    Field(1, "id", "string"),
    Field(2, "customer_id", "string"),
    Field(3, "item", "string"),
    Field(4, "amount", "double"),
    Field(5, "status", "enum"),
    Field(6, "created_at", "timestamp"),
    Field(7, "region", "string"),
]
ORDER_V2 = ORDER_V1[:6]
PAYMENT_V1 = [
    Field(1, "payment_id", "string"),
    Field(2, "order_id", "string"),
    Field(3, "customer_id", "string"),
    Field(4, "amount", "double"),
    Field(5, "currency", "string"),
    Field(6, "status", "enum"),
    Field(7, "processor", "string"),
    Field(8, "created_at", "timestamp"),
]
ORDER_STATUS = {
    0: "ORDER_STATUS_UNSPECIFIED",
    1: "ORDER_STATUS_CREATED",
    2: "ORDER_STATUS_PAID",
    3: "ORDER_STATUS_FULFILLED",
    4: "ORDER_STATUS_CANCELLED",
}
PAYMENT_STATUS = {
    0: "PAYMENT_STATUS_UNSPECIFIED",
    1: "PAYMENT_STATUS_PENDING",
    2: "PAYMENT_STATUS_AUTHORIZED",
    3: "PAYMENT_STATUS_CAPTURED",
    4: "PAYMENT_STATUS_FAILED",
    5: "PAYMENT_STATUS_REFUNDED",
}

# Protobuf scalar type -> (wire type, Spark type).
WIRE = {
    "double": (1, "double"),
    "float": (5, "float"),
    "int32": (0, "int"),
    "int64": (0, "bigint"),
    "uint32": (0, "bigint"),
    "uint64": (0, "decimal(20,0)"),
    "sint32": (0, "int"),
    "sint64": (0, "bigint"),
    "fixed32": (5, "bigint"),
    "fixed64": (1, "decimal(20,0)"),
    "sfixed32": (5, "int"),
    "sfixed64": (1, "bigint"),
    "bool": (0, "boolean"),
    "enum": (0, "int"),
    "string": (2, "string"),
    "bytes": (2, "binary"),
    "timestamp": (2, "timestamp"),
    "message": (2, "binary"),
}


def spark_type(f: Field) -> T.DataType:
    """The column type of a field."""
    kind = struct_of(f.inner) if f.type == "message" else _TYPES[WIRE[f.type][1]]
    return T.ArrayType(kind) if f.repeated else kind


def struct_of(fields: list[Field] | tuple[Field, ...]) -> T.StructType:
    """The typed table a message decodes to."""
    return T.StructType([T.StructField(f.name, spark_type(f)) for f in fields])
