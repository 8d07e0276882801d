"""Message types from the descriptor bytes that a registry keeps.

A descriptor is itself a message, so the scanner that reads records reads descriptors too.
All versions of a registry are scanned together into one row per declared field; nested types
are the rows of the next pass, and names of types are resolved by joins, one per level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scan import _by_schema, _decoder, decode_messages, decode_topic
from tidelog.operators.lookup import BROADCAST_ROWS, lookup, settled
from tidelog.operators.registry import latest
from tidelog.schemas import WIRE, Field
from tidelog.scratch import cut

# Field numbers of file, message and field descriptors, and the numbers of types.
FIELD = (
    Field(1, "name", "string"), Field(3, "number", "int32"), Field(4, "label", "enum"), Field(5, "type", "enum"),
    Field(6, "type_name", "string"),
)
RANGE = (Field(1, "first", "int32"), Field(2, "past", "int32"))
MESSAGE = [
    Field(1, "name", "string"), Field(2, "field", "message", True, FIELD), Field(3, "nested_type", "bytes", True),
    Field(9, "reserved_range", "message", True, RANGE), Field(10, "reserved_name", "string", True),
]
FILE = [Field(2, "package", "string"), Field(4, "message_type", "bytes", True)]
TYPE_NUMBERS = {
    1: "double", 2: "float", 3: "int64", 4: "uint64", 5: "int32", 6: "fixed64", 7: "fixed32", 8: "bool", 9: "string",
    11: "message", 12: "bytes", 13: "uint32", 14: "enum", 15: "sfixed32", 16: "sfixed64", 17: "sint32", 18: "sint64",
}
REPEATED = 3
TIMESTAMP = ".google.protobuf.Timestamp"


def _lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def message_fields(registry: DataFrame) -> DataFrame:
    """Every field that the descriptors of ``registry (schema_id, descriptor)`` declare.

    ``schema_id, message, field_no, last_no, name, type, type_name, repeated, reserved``.
    ``message`` is the full name with a leading dot. Reserved numbers are rows from
    ``field_no`` to ``last_no`` without a name, reserved names rows without a number; for
    declared fields both numbers are the same. Bytes that are no descriptor declare nothing.
    """
    one = registry.groupBy("schema_id").agg(F.first("descriptor").alias("descriptor"))
    files = decode_messages(one, FILE, "descriptor", ["schema_id"]).where("decode_error is null")
    scope = F.when(F.col("package") != "", F.concat(F.lit("."), "package")).otherwise("")
    level = files.select("schema_id", scope.alias("scope"), F.explode("message_type").alias("body"))
    found = None
    while True:
        read = decode_messages(level, MESSAGE, "body", ["schema_id", "scope"]).where("decode_error is null")
        read = cut(read.withColumn("message", F.concat("scope", F.lit("."), "name")))
        rows = _rows(read)
        found = rows if found is None else found.unionByName(rows)
        level = read.select("schema_id", F.col("message").alias("scope"), F.explode("nested_type").alias("body"))
        if level.isEmpty():
            return found


def _rows(read: DataFrame) -> DataFrame:
    key = ["schema_id", "message"]
    none = F.lit(None).cast("string")
    f = F.col("f")
    kind = F.when(f["type_name"] == TIMESTAMP, "timestamp").otherwise(F.coalesce(_lookup(TYPE_NUMBERS, f["type"]), F.lit("unknown")))
    declared = read.select(*key, F.explode("field").alias("f")).select(
        *key, f["number"].alias("field_no"), f["number"].alias("last_no"), f["name"].alias("name"), kind.alias("type"),
        f["type_name"].alias("type_name"), (f["label"] == REPEATED).alias("repeated"), F.lit(False).alias("reserved"),
    )
    gone = [none.alias("type"), none.alias("type_name"), F.lit(False).alias("repeated"), F.lit(True).alias("reserved")]
    numbers = read.select(*key, F.explode("reserved_range").alias("r")).select(
        *key, F.col("r.first").alias("field_no"), (F.col("r.past") - 1).alias("last_no"), none.alias("name"), *gone
    )
    number = F.lit(None).cast("int")
    names = read.select(*key, F.explode("reserved_name").alias("name")).select(
        *key, number.alias("field_no"), number.alias("last_no"), "name", *gone
    )
    return declared.unionByName(numbers).unionByName(names)


def declared_fields(rows: DataFrame) -> DataFrame:
    """``FIELDS`` rows of SCH-4 to SCH-9 from ``message_fields`` of one message per schema.

    A reserved range may hold half a billion numbers. Only those that some schema of the
    message uses can ever matter, so ranges are met with these; a reserved name without a
    number gets number 0, which no field has.
    """
    plain = rows.where(~F.col("reserved")).select("schema_id", "field_no", "name", "type", "reserved")
    used = rows.where(~F.col("reserved")).select("message", F.col("field_no").alias("no")).distinct()
    ranges = rows.where(F.col("reserved") & F.col("field_no").isNotNull()).select("schema_id", "message", "field_no", "last_no")
    numbers = ranges.join(used, "message").where(F.col("no").between(F.col("field_no"), F.col("last_no"))).select(
        "schema_id", F.col("no").alias("field_no"), F.lit(None).cast("string").alias("name")
    )
    names = rows.where(F.col("reserved") & F.col("field_no").isNull()).select("schema_id", F.lit(0).alias("field_no"), "name")
    gone = numbers.unionByName(names).select("schema_id", "field_no", "name", F.lit(None).cast("string").alias("type"), F.lit(True).alias("reserved"))
    return plain.unionByName(gone)


def _levels(rows: DataFrame, roots: DataFrame) -> list[DataFrame]:
    """Fields below each root message, one table per level of nesting.

    ``schema_id, root, path, name, type, type_name, repeated, trail``. A message type that is
    among its own ancestors, or that the descriptors do not hold, is not opened: its bytes
    are given as they are.
    """
    fields = cut(rows.where(~F.col("reserved")).select("schema_id", "message", "field_no", "name", "type", "type_name", "repeated"))
    level = roots.select("schema_id", F.col("message").alias("root"), "message").join(fields, ["schema_id", "message"]).select(
        "schema_id", "root", F.array("field_no").alias("path"), "name", "type", "type_name", "repeated", F.array("message").alias("trail")
    )
    known = fields.select("schema_id", F.col("message").alias("type_name"), F.lit(True).alias("held")).distinct()
    levels = []
    while True:
        opened = F.coalesce("held", F.lit(False)) & ~F.array_contains("trail", F.col("type_name"))
        kind = F.when((F.col("type") == "message") & ~opened, "bytes").otherwise(F.col("type"))
        level = cut(level.join(known, ["schema_id", "type_name"], "left").withColumn("type", kind).drop("held"))
        levels.append(level)
        below = level.where("type = 'message'").select("schema_id", "root", F.col("path").alias("above"), F.col("type_name").alias("message"), "trail")
        level = below.join(fields, ["schema_id", "message"]).select(
            "schema_id", "root", F.concat("above", F.array("field_no")).alias("path"), "name", "type", "type_name", "repeated",
            F.concat("trail", F.array("message")).alias("trail"),
        )
        if level.isEmpty():
            return levels


def writer_fields(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``schema_id, path, name, type, repeated``: what the payloads of each schema hold.

    ``rows`` are ``message_fields`` and ``roots (schema_id, message)`` names the message of
    each schema; ``path`` is the field numbers from the top.
    """
    levels = _levels(rows, roots)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select("schema_id", "path", "name", "type", "repeated")


def topic_types(registry: DataFrame, rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """SRC-7: ``topic, message, schema_id, layout`` of each ``mapping (topic, message)``.

    The newest live schema of the topic's subject decides. Layouts are put together from the
    innermost level outwards, one aggregate per level.
    """
    newest = latest(registry).select("subject", "schema_id")
    placed = mapping.withColumn("subject", F.concat("topic", F.lit("-value"))).join(newest, "subject").drop("subject")
    key = ["schema_id", "root"]
    inner = None
    for level in reversed(_levels(rows, placed.select("schema_id", "message").distinct())):
        kind = F.coalesce(_lookup({t: spark for t, (_, spark) in WIRE.items()}, F.col("type")), F.lit("binary"))
        if inner is not None:
            level = level.join(inner, [*key, "path"], "left")
            kind = F.coalesce("below", kind)
        text = F.concat("name", F.lit(":"), F.when(F.col("repeated"), F.concat(F.lit("array<"), kind, F.lit(">"))).otherwise(kind))
        each = level.select(*key, F.slice("path", 1, F.size("path") - 1).alias("path"), F.struct(F.element_at("path", -1).alias("no"), text.alias("text")).alias("f"))
        joined = F.array_join(F.transform(F.array_sort(F.collect_list("f")), lambda f: f["text"]), ",")
        inner = each.groupBy(*key, "path").agg(F.concat(F.lit("struct<"), joined, F.lit(">")).alias("below"))
    shapes = inner.select("schema_id", F.col("root").alias("message"), F.col("below").alias("layout"))
    return placed.join(shapes, ["schema_id", "message"], "left").select("topic", "message", "schema_id", "layout")


def tree(rows: list) -> list[Field]:
    """Fields, with nested ones inside, from the ``path, name, type, repeated`` of one schema."""
    below: dict[tuple, list] = {}
    for row in rows:
        below.setdefault(tuple(row["path"][:-1]), []).append(row)

    def fields(at: tuple) -> list[Field]:
        return [
            Field(r["path"][-1], r["name"], r["type"], r["repeated"], tuple(fields(tuple(r["path"]))) if r["type"] == "message" else ())
            for r in sorted(below.get(at, []), key=lambda r: r["path"][-1])
        ]

    return fields(())


def reader_fields(writers: DataFrame, schema_id: int) -> list[Field]:
    """The fields of one schema, for a reader that was built with it."""
    return tree(writers.where(F.col("schema_id") == schema_id).collect())


def decode_registry(
    df: DataFrame, writers: DataFrame, columns: list[Field], payload: str = "payload", rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """PRJ-4: as ``decode_topic``, each payload read with the schema that the registry has for its id.

    ``writers`` is ``writer_fields``. A registry of at most ``rows`` fields goes to the tasks
    whole. Of a larger one, each record brings its own writer from a join, so no task holds
    more schemas than its records name.
    """
    small = settled(writers, rows)
    if small is not None:
        held: dict[int, list] = {}
        for row in small.collect():
            held.setdefault(row["schema_id"], []).append(row)
        return decode_topic(df, {schema_id: tree(found) for schema_id, found in held.items()}, columns, payload)
    packed = writers.groupBy("schema_id").agg(F.collect_list(F.struct("path", "name", "type", "repeated")).alias("writer_"))
    met = lookup(df.drop(*(["value"] if payload != "value" else [])), packed, ["schema_id"], "left", rows=0)
    shape, one = _decoder(met, columns, payload, ("writer_",))

    def run(batches):
        for batch in batches:
            for _, part in _by_schema(batch):
                yield one(part, tree(part.column("writer_")[0].as_py() or []))

    return met.mapInArrow(run, shape)
