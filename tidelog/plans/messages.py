"""Queries over message bytes and typed messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions import records, wire
from tidelog.functions.scan import wire_fields as read_wire_fields
from tidelog.operators import matching, registry, reports, routing
from tidelog.plans import derive as d
from tidelog.plans import sql as s
from tidelog.plans.catalog import query
from tidelog.plans.logs import ASSIGNED
from tidelog.schemas import ORDER_STATUS, ORDER_V1, ORDER_V2, Field
from tidelog.sources import sinks
from tidelog.streaming.consume import typed

ADDRESS = ["topic", "partition", "offset"]
WRITERS = {1: ORDER_V1, 2: ORDER_V2}

# A reader whose schema moved the item from number 3 to number 8.
RENUMBERED = [f._replace(no=8) if f.name == "item" else f for f in ORDER_V1]

SCHEMA_AT = f"CASE WHEN \"timestamp\" < TIMESTAMP '{d.DEPLOY}' THEN 1 ELSE 2 END"


# Envelopes.


@query(
    "envelope_split",
    f"WITH {s.LOG} SELECT topic, partition, \"offset\", 0 AS magic, {SCHEMA_AT} AS schema_id, 0 AS message_index, \"value\" AS payload FROM log",
)
def envelope_split(spark, sf):
    return wire.split_envelope(d.enveloped_log(spark, sf)).select(
        *ADDRESS, "magic", "schema_id", "message_index", F.col("payload").cast("string").alias("payload")
    )


@query(
    "envelope_build",
    f"WITH {s.LOG} SELECT topic, partition, \"offset\", '000000000' || {SCHEMA_AT} || '00' || hex(encode(\"value\")) AS bytes FROM log",
)
def envelope_build(spark, sf):
    return d.enveloped_log(spark, sf).select(*ADDRESS, F.hex("value").alias("bytes"))


@query(
    "value_class",
    f"WITH {s.ORDERS} SELECT 'enveloped' AS kind, count(*) AS n FROM typed UNION ALL SELECT 'raw', count(*) FROM typed "
    "UNION ALL SELECT CASE WHEN event_type = 'error' THEN 'null' ELSE 'foreign' END, count(*) FROM events GROUP BY 1",
)
def value_class(spark, sf):
    """Enveloped and bare messages next to JSON texts and nulls."""
    topic = d.order_topic(spark, sf)
    bare = wire.split_envelope(topic).select(F.col("payload").alias("value"))
    values = topic.select("value").unionByName(bare).unionByName(d.tombstone_log(spark, sf).select("value"))
    return values.groupBy(wire.classify_value().alias("kind")).agg(F.count("*").alias("n"))


# Codec.

TYPED = 'topic, partition, "offset", schema_id, id, customer_id, item, amount, status, (epoch_us(created_at) // 1000) AS created_ms'


@query(
    "decode_topic",
    f"WITH {s.ORDERS} SELECT {TYPED}, CASE WHEN schema_id = 1 THEN region ELSE '' END AS region, 'good' AS outcome FROM typed",
)
def decode_topic(spark, sf):
    """Orders encoded by two writer schemas and read back."""
    out = typed(d.order_topic(spark, sf), WRITERS)
    return out.select(
        *ADDRESS, "schema_id", "id", "customer_id", "item", "amount", "status",
        F.unix_millis("created_at").alias("created_ms"), "region", "outcome",
    )


def _varint_hex(n: str) -> str:
    byte = "lpad(hex({}), 2, '0')"
    five = " || ".join(byte.format(f"(({n}) >> {7 * i}) & 127 | 128") for i in range(4))
    return f"({five} || {byte.format(f'(({n}) >> 28) & 127')})"


def _text_hex(tag: str, col: str) -> str:
    return f"CASE WHEN {col} <> '' THEN '{tag}' || lpad(hex(octet_length(encode({col}))), 2, '0') || hex(encode({col})) ELSE '' END"


DOUBLE_BITS = "".join(
    (" || " if i else "") + f"substr(hex(amount::BIT::BLOB), {15 - 2 * i}, 2)" for i in range(8)
)
PAYLOAD_HEX = " || ".join([
    _text_hex("0A", "id"), _text_hex("12", "customer_id"), _text_hex("1A", "item"),
    f"CASE WHEN amount <> 0 THEN '21' || {DOUBLE_BITS} ELSE '' END",
    "CASE WHEN status <> 0 THEN '280' || status ELSE '' END",
    f"'320608' || {_varint_hex('(epoch_us(created_at) // 1000) // 1000')}",
    "CASE WHEN schema_id = 1 THEN " + _text_hex("3A", "region") + " ELSE '' END",
])


@query(
    "encode_topic",
    f"WITH {s.ORDERS} SELECT topic, partition, \"offset\", '000000000' || schema_id || '00' || {PAYLOAD_HEX} AS bytes FROM typed",
)
def encode_topic(spark, sf):
    return d.order_topic(spark, sf).select(*ADDRESS, F.hex("value").alias("bytes"))


def _len(n: str) -> str:
    return f"CASE WHEN {n} < 128 THEN 1 WHEN {n} < 16384 THEN 2 ELSE 3 END"


def _text_size(col: str) -> str:
    n = f"octet_length(encode({col}))"
    return f"CASE WHEN {col} <> '' THEN 1 + {_len(n)} + {n} ELSE 0 END"


SIZE = " + ".join([
    *[_text_size(c) for c in ("id", "customer_id", "item", "region")],
    "CASE WHEN amount <> 0 THEN 9 ELSE 0 END", "CASE WHEN status <> 0 THEN 2 ELSE 0 END", "8",
])


@query("encoded_size", f"WITH {s.ORDERS} SELECT id, ({SIZE})::INTEGER AS size FROM typed")
def encoded_size(spark, sf):
    return d.typed_orders(spark, sf).select("id", wire.encoded_size(ORDER_V1).cast("int").alias("size"))


WIRE_ROWS = f"""{s.ORDERS}, parts AS (
  SELECT "offset", partition, schema_id, unnest([
    {{'no': 1, 'wire': 2, 'len': octet_length(encode(id)), 'on': id <> ''}},
    {{'no': 2, 'wire': 2, 'len': octet_length(encode(customer_id)), 'on': customer_id <> ''}},
    {{'no': 3, 'wire': 2, 'len': octet_length(encode(item)), 'on': item <> ''}},
    {{'no': 4, 'wire': 1, 'len': 8, 'on': amount <> 0}},
    {{'no': 5, 'wire': 0, 'len': 1, 'on': status <> 0}},
    {{'no': 6, 'wire': 2, 'len': 6, 'on': true}},
    {{'no': 7, 'wire': 2, 'len': octet_length(encode(region)), 'on': region <> '' AND schema_id = 1}}]) AS p
  FROM typed)"""


@query(
    "wire_fields",
    f"WITH {WIRE_ROWS} SELECT partition, \"offset\", (row_number() OVER (PARTITION BY partition, \"offset\" ORDER BY p.no) - 1)::INTEGER AS field_index, "
    "p.no::INTEGER AS field_no, p.wire::INTEGER AS wire_type, p.len::INTEGER AS length FROM parts WHERE p.on",
)
def wire_fields(spark, sf):
    split = wire.split_envelope(d.order_topic(spark, sf))
    return read_wire_fields(split, ["partition", "offset"]).drop("decode_error")


def _field_table(spark):
    rows = [(1, f.no, f.name, f.type, False) for f in ORDER_V1]
    # Version 2 as somebody declared it: item as a number, and a note nobody writes.
    rows += [(2, f.no, f.name, "int32" if f.name == "item" else f.type, False) for f in ORDER_V2 if f.name != "status"]
    rows += [(2, 9, "note", "string", False), (2, 7, "region", "string", True)]
    return spark.createDataFrame(rows, "schema_id int, field_no int, name string, type string, reserved boolean")


DECLARED = """d AS (SELECT * FROM (VALUES
  (1, 1, 'id', 2), (1, 2, 'customer_id', 2), (1, 3, 'item', 2), (1, 4, 'amount', 1), (1, 5, 'status', 0),
  (1, 6, 'created_at', 2), (1, 7, 'region', 2), (2, 1, 'id', 2), (2, 2, 'customer_id', 2), (2, 3, 'item', 0),
  (2, 4, 'amount', 1), (2, 6, 'created_at', 2), (2, 9, 'note', 2)) v(schema_id, field_no, name, declared_wire))"""


@query(
    "schema_drift",
    f"WITH {WIRE_ROWS}, w AS (SELECT schema_id, p.no AS field_no, p.wire AS wire_type, count(*) AS n FROM parts WHERE p.on GROUP BY ALL), {DECLARED} "
    "SELECT coalesce(d.schema_id, w.schema_id)::INTEGER AS schema_id, coalesce(d.field_no, w.field_no)::INTEGER AS field_no, name, "
    "declared_wire::INTEGER AS declared_wire, wire_type::INTEGER AS wire_type, coalesce(n, 0) AS n_seen, "
    "CASE WHEN declared_wire IS NULL THEN 'unknown' WHEN wire_type IS NULL THEN 'never_seen' "
    "WHEN wire_type <> declared_wire THEN 'mismatch' ELSE 'as_declared' END AS verdict "
    "FROM d FULL JOIN w ON d.schema_id = w.schema_id AND d.field_no = w.field_no",
)
def schema_drift(spark, sf):
    split = wire.split_envelope(d.order_topic(spark, sf))
    return registry.schema_drift(read_wire_fields(split, ["schema_id"]), _field_table(spark))


@query(
    "zigzag_misread",
    "WITH n AS (SELECT c_custkey, round(c_acctbal)::BIGINT AS n FROM customer), "
    "z AS (SELECT *, n & 4294967295 AS u, xor(n << 1, n >> 63) & 4294967295 AS zz FROM (SELECT c_custkey, n FROM n WHERE n >= 0) "
    "UNION ALL SELECT c_custkey, n, n & 4294967295, (-2 * n - 1) & 4294967295 FROM n WHERE n < 0) "
    "SELECT c_custkey, n, xor(u >> 1, -(u & 1)) AS plain_as_sint, CASE WHEN zz >= 2147483648 THEN zz - 4294967296 ELSE zz END AS sint_as_plain FROM z",
)
def zigzag_misread(spark, sf):
    n = F.round("c_acctbal").cast("bigint")
    as_sint, as_plain = wire.zigzag_misread(n)
    return d.table(spark, sf, "customer").select(
        "c_custkey", n.alias("n"), as_sint.alias("plain_as_sint"), as_plain.alias("sint_as_plain")
    )


# Typed records.


@query(
    "reader_projection",
    f"WITH {s.ORDERS} SELECT id AS order_no, customer_id, '' AS item, amount, '' AS note, 0::BIGINT AS weight FROM typed",
)
def reader_projection(spark, sf):
    """A reader that renamed the id, moved the item, and added two fields."""
    reader = [
        Field(1, "order_no", "string"), Field(2, "customer_id", "string"), Field(8, "item", "string"),
        Field(4, "amount", "double"), Field(9, "note", "string"), Field(10, "weight", "int64"),
    ]
    return records.project_reader(d.typed_orders(spark, sf), ORDER_V1, reader, [])


@query(
    "zero_fill",
    f"WITH {s.ORDERS} SELECT id, CASE WHEN status = 3 THEN '' ELSE item END AS filled, "
    "CASE WHEN status = 3 THEN NULL ELSE item END AS emptied, CASE WHEN status = 3 THEN 0.0::DOUBLE ELSE amount END AS amount FROM typed",
)
def zero_fill(spark, sf):
    some = [f for f in ORDER_V1 if f.name in ("item", "amount")]
    gone = d.typed_orders(spark, sf).withColumns(
        {f.name: F.when(F.col("status") != 3, F.col(f.name)) for f in some}
    ).select("id", "item", "amount")
    filled = records.fill_zero(gone, some)
    emptied = records.zero_to_null(filled.withColumn("filled", F.col("item")), [some[0]])
    return emptied.select("id", "filled", F.col("item").alias("emptied"), "amount")


@query(
    "enum_name",
    f"SELECT l_orderkey, l_linenumber AS status, {s.STATUS_NAME.replace('status', 'l_linenumber')} AS name, "
    "CASE WHEN l_linenumber <= 4 THEN l_linenumber END AS number FROM lineitem",
)
def enum_name(spark, sf):
    """Line numbers read as a status: those above four have no name."""
    lines = d.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("status"))
    named = lines.withColumn("name", records.enum_name(F.col("status"), ORDER_STATUS))
    return named.withColumn("number", records.enum_number(F.col("name"), ORDER_STATUS))


@query(
    "order_line",
    f"WITH {s.ORDERS} SELECT 'partition=' || partition || ' offset=' || \"offset\" || ' | id=' || substr(id, 1, 8) || '... customer=' || "
    "customer_id || ' item=''' || item || ''' amount=$' || printf('%.2f', amount) || ' status=' || "
    f"{s.STATUS_NAME} || CASE WHEN region <> '' THEN ' region=' || region ELSE '' END AS line FROM typed",
)
def order_line(spark, sf):
    return d.typed_orders(spark, sf).select(records.order_line(ORDER_STATUS).alias("line"))


@query(
    "timestamp_parts",
    "SELECT event_id, epoch_us(ts) // 1000000 AS seconds, (epoch_us(ts) % 1000000 * 1000)::INTEGER AS nanos, "
    "epoch_us(ts) AS again_us, (epoch_us(ts) // 1000) * 1000 AS millis_us FROM events",
)
def timestamp_parts(spark, sf):
    seconds, nanos = records.time_to_parts(F.col("timestamp"))
    again = records.parts_to_time(seconds, nanos)
    millis = records.millis_to_time(F.unix_millis("timestamp"))
    return d.raw_events(spark, sf).select(
        "event_id", seconds.alias("seconds"), nanos.alias("nanos"),
        F.unix_micros(again).alias("again_us"), F.unix_micros(millis).alias("millis_us"),
    )


@query(
    "set_fields",
    f"WITH {s.ORDERS} SELECT id, 'id,customer_id,' || CASE WHEN status <> 3 THEN 'item,' ELSE '' END || "
    "'amount,status,created_at' || CASE WHEN region <> '' THEN ',region' ELSE '' END AS names, status <> 3 AS has_item FROM typed",
)
def set_fields(spark, sf):
    orders = d.typed_orders(spark, sf).withColumn("item", F.when(F.col("status") == 3, "").otherwise(F.col("item")))
    return orders.select(
        "id", F.array_join(records.set_fields(ORDER_V1), ",").alias("names"),
        records.has_field(ORDER_V1, "item").alias("has_item"),
    )


JSON = (
    "'{\"id\":\"' || id || '\",\"customerId\":\"' || customer_id || '\",\"item\":\"' || item || '\",\"amount\":' || amount || "
    f"',\"status\":\"' || {s.STATUS_NAME} || '\",\"createdAt\":\"' || strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') || "
    "'\",\"region\":\"' || region || '\"}'"
)


@query("json_record", f"WITH {s.ORDERS} SELECT id, {JSON} AS json FROM typed")
def json_record(spark, sf):
    return d.typed_orders(spark, sf).select("id", records.json_record(ORDER_V1, {"status": ORDER_STATUS}).alias("json"))


@query("subject_name", f"WITH {s.TYPES} SELECT DISTINCT topic, topic || '-value' AS subject FROM log")
def subject_name(spark, sf):
    topics = d.topic_per_type(spark, sf).select("topic").distinct()
    return topics.withColumn("subject", records.subject(F.col("topic")))


# Writer and reader schemas.


@query(
    "schema_lookup",
    f"WITH {s.LOG} SELECT topic, partition, \"offset\", {SCHEMA_AT} AS schema_id, "
    f"CASE WHEN {SCHEMA_AT} = 1 THEN 'order.v1.Order' END AS message, {SCHEMA_AT} = 1 AS known FROM log",
)
def schema_lookup(spark, sf):
    known = spark.createDataFrame([(1, "order.v1.Order")], "schema_id int, message string")
    split = wire.split_envelope(d.enveloped_log(spark, sf))
    return matching.with_schema(split, known).select(*ADDRESS, "schema_id", "message", "known")


@query(
    "compare_readers",
    f"WITH {s.ORDERS} SELECT topic, partition, \"offset\", item AS a_item, CASE WHEN status <> 3 THEN '' END AS b_item, "
    "CASE WHEN status = 3 THEN 'only_a' ELSE 'differs' END AS outcome FROM typed",
)
def compare_readers(spark, sf):
    """One reader knows the item under its number, the other under a new one and stopped at finished orders."""
    orders = d.typed_orders(spark, sf)
    a = records.project_reader(orders, ORDER_V1, ORDER_V1, ADDRESS)
    b = records.project_reader(orders.where("status <> 3"), ORDER_V1, RENUMBERED, ADDRESS)
    return matching.compare_readers(a, b, ["id", "item", "region"]).select(*ADDRESS, "a_item", "b_item", "outcome")


@query(
    "schema_mix",
    f"WITH {s.LOG} SELECT topic, (epoch_us(date_trunc('day', \"timestamp\")) // 1000) AS bucket_ms, {SCHEMA_AT} AS schema_id, count(*) AS n_records FROM log GROUP BY ALL",
)
def schema_mix(spark, sf):
    split = wire.split_envelope(d.enveloped_log(spark, sf))
    return reports.schema_mix(split).select("topic", F.unix_millis("bucket").alias("bucket_ms"), "schema_id", "n_records")


@query(
    "blank_rate",
    f"WITH {s.ORDERS}, c AS (SELECT schema_id, count(*) AS n_records, count(*) FILTER (item = '') AS item, "
    "count(*) FILTER (region = '' OR schema_id = 2) AS region, count(*) FILTER (status = 0) AS status FROM typed GROUP BY schema_id) "
    "SELECT schema_id, n_records, field, n_blank, n_blank / n_records AS blank_rate FROM (UNPIVOT c ON item, region, status INTO NAME field VALUE n_blank)",
)
def blank_rate(spark, sf):
    return reports.blank_rate(typed(d.order_topic(spark, sf), WRITERS), {"item": "", "region": "", "status": 0})


@query(
    "size_ratio",
    f"WITH {s.ORDERS}, t AS (SELECT sum(octet_length(encode({JSON})))::BIGINT AS json_bytes, sum({SIZE})::BIGINT AS encoded_bytes FROM typed) "
    "SELECT *, json_bytes / encoded_bytes AS ratio FROM t",
)
def size_ratio(spark, sf):
    json = records.json_record(ORDER_V1, {"status": ORDER_STATUS})
    return reports.size_ratio(d.typed_orders(spark, sf), json, wire.encoded_size(ORDER_V1))


@query(
    "schemas_needed",
    f"WITH {s.LOG}, {ASSIGNED} SELECT topic, member_id AS reader, string_agg(DISTINCT ({SCHEMA_AT})::VARCHAR, ',' ORDER BY ({SCHEMA_AT})::VARCHAR) AS schema_ids "
    "FROM log JOIN assigned USING (topic, partition) GROUP BY ALL",
)
def schemas_needed(spark, sf):
    split = wire.split_envelope(d.enveloped_log(spark, sf))
    read = matching.consume_by_member(split, routing.assign_members(split, d.members(spark)))
    needed = registry.schemas_needed(read.withColumnRenamed("member_id", "reader"))
    return needed.withColumn("schema_ids", F.array_join(F.col("schema_ids").cast("array<string>"), ","))


@query(
    "report_lines",
    f"WITH {s.ORDERS}, n AS (SELECT count(*) AS c FROM typed) "
    "SELECT 1 AS section, -1 AS partition, 0::BIGINT AS \"offset\", '[reader] order v1' AS line "
    f"UNION ALL SELECT 1, -1, 1, '{sinks.REPORT_HEADER}' UNION ALL SELECT 1, -1, 2, repeat('-', 100) "
    "UNION ALL SELECT 2, partition, \"offset\", 'p=' || partition || '         | ' || rpad(\"offset\"::VARCHAR, 6, ' ') || ' | ' || "
    f"rpad(customer_id, 16, ' ') || '| ' || rpad(item, 26, ' ') || '| ' || rpad({s.STATUS_NAME}, 24, ' ') || '| ' || "
    "CASE WHEN region = '' THEN '(empty)' ELSE region END FROM typed "
    "UNION ALL SELECT 3, -1, 0, repeat('-', 100) UNION ALL SELECT 3, -1, 1, '[reader] ' || c || ' messages read.' FROM n",
)
def report_lines(spark, sf):
    region = F.when(F.col("region") == "", "(empty)").otherwise(F.col("region"))
    return sinks.report_lines(
        d.typed_orders(spark, sf), ORDER_STATUS, ["[reader] order v1"], ["[reader] {count} messages read."], region
    )
