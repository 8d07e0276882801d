"""Queries over nested messages, and over types that are read from descriptor bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions import wire
from tidelog.functions.encode import encode_topic
from tidelog.functions.scan import decode_topic
from tidelog.operators.filters import with_outcome
from tidelog.plans import derive as d
from tidelog.plans import sql as s
from tidelog.plans.catalog import ORACLES, query
from tidelog.plans.messages import ADDRESS
from tidelog.schemas import ORDER_V1, ORDER_V2, Field
from tidelog.sources import descriptors as ds

LINE = (
    Field(1, "number", "int32"), Field(2, "part", "int64"), Field(3, "price", "double"), Field(4, "flags", "string", True),
    Field(5, "shipped", "timestamp"),
)
BUYER = (Field(1, "name", "string"), Field(2, "balance", "double"))
BASKET = [
    Field(1, "id", "string"), Field(2, "lines", "message", True, LINE), Field(3, "suppliers", "int64", True),
    Field(4, "buyer", "message", False, BUYER), Field(5, "taxes", "double", True),
]


def baskets(spark, sf):
    """Orders as messages with their lines and their buyer inside."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    lines = d.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("all"))
    o = d.table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    c = d.table(spark, sf, "customer").select("c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("buyer"))
    each = lambda make: F.transform("all", make)
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("id"),
        each(lambda x: F.struct(
            x["l_linenumber"].alias("number"), x["l_partkey"].alias("part"), x["l_extendedprice"].alias("price"),
            F.array(x["l_returnflag"], x["l_linestatus"]).alias("flags"), x["l_shipdate"].cast("timestamp").alias("shipped"),
        )).alias("lines"),
        each(lambda x: x["l_suppkey"]).alias("suppliers"), "buyer", each(lambda x: x["l_tax"]).alias("taxes"),
    )


@query(
    "decode_nested",
    "SELECT o_orderkey::VARCHAR AS id, l_linenumber AS number, l_partkey AS part, l_suppkey AS supplier, l_extendedprice AS price, l_tax AS tax, "
    "l_returnflag || ',' || l_linestatus AS flags, (epoch_us(l_shipdate) // 1000) AS shipped_ms, c_name AS buyer, c_acctbal AS balance "
    "FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey",
)
def decode_nested(spark, sf):
    """Orders with lists of lines, written and read back; one row per line, or one for an order without any."""
    coded = encode_topic(baskets(spark, sf), BASKET).withColumn("schema_id", F.lit(1))
    read = decode_topic(coded, {1: BASKET}, BASKET).where("decode_error is null and not wire_mismatch")
    line = F.col("line")
    return read.select("id", "suppliers", "taxes", "buyer", F.posexplode_outer("lines").alias("at", "line")).select(
        "id", line["number"].alias("number"), line["part"].alias("part"), F.get("suppliers", F.col("at")).alias("supplier"),
        line["price"].alias("price"), F.get("taxes", F.col("at")).alias("tax"), F.array_join(line["flags"], ",").alias("flags"),
        F.unix_millis(line["shipped"]).alias("shipped_ms"), F.col("buyer.name").alias("buyer"), F.col("buyer.balance").alias("balance"),
    )


def described(fields, name: str = "Order", package: str = "shop"):
    """``schema_id, descriptor``: descriptor bytes of one message per schema from ``FIELDS`` rows."""
    kind = F.lit(None).cast("int")
    for number, word in ds.TYPE_NUMBERS.items():
        kind = F.when(F.col("type") == word, number).otherwise(kind)
    nested = F.when(F.col("type") == "timestamp", 11).otherwise(kind)
    type_name = F.when(F.col("type") == "timestamp", ds.TIMESTAMP).otherwise("")
    field = F.struct(
        F.col("name"), F.col("field_no").alias("number"), F.lit(1).alias("label"), nested.alias("type"), type_name.alias("type_name")
    )
    gap = F.struct(F.col("field_no").alias("first"), (F.col("field_no") + 1).alias("past"))
    texts = F.array().cast("array<string>")
    messages = fields.groupBy("schema_id").agg(
        F.array_sort(F.collect_list(F.when(~F.col("reserved"), field))).alias("field"),
        F.array_sort(F.collect_list(F.when(F.col("reserved"), gap))).alias("reserved_range"),
    ).withColumns({"name": F.lit(name), "nested_type": texts.cast("array<binary>"), "reserved_name": texts})
    files = encode_topic(messages, ds.MESSAGE, "body").select(
        "schema_id", F.lit(package).alias("package"), F.array("body").alias("message_type")
    )
    return encode_topic(files, ds.FILE, "descriptor")


@query(
    "descriptor_fields",
    f"WITH {s.REGISTRY} SELECT schema_id, '.shop.Order' AS message, field_no, CASE WHEN reserved THEN NULL ELSE name END AS name, "
    "CASE WHEN reserved THEN NULL ELSE type END AS type, reserved FROM fields",
)
def descriptor_fields(spark, sf):
    """The declared fields of every schema, written as descriptors and scanned from their bytes."""
    rows = ds.message_fields(described(d.fields(spark, sf)))
    return rows.select("schema_id", "message", "field_no", "name", "type", "reserved")


@query(
    "topic_types",
    f"""WITH {s.REGISTRY}, newest AS (SELECT subject, arg_max(schema_id, version) AS schema_id FROM registry GROUP BY subject),
shown AS (
  SELECT schema_id, 'struct<' || string_agg(name || ':' || CASE type WHEN 'bytes' THEN 'binary' WHEN 'int64' THEN 'bigint' WHEN 'string' THEN 'string' ELSE 'int' END,
    ',' ORDER BY field_no) || '>' AS layout FROM fields WHERE NOT reserved GROUP BY schema_id)
SELECT substr(subject, 1, length(subject) - 6) AS topic, '.shop.Order' AS message, schema_id, layout FROM newest LEFT JOIN shown USING (schema_id)""",
)
def topic_types(spark, sf):
    """The layout of the newest schema of every customer's topic."""
    registry = d.registry(spark, sf)
    mapping = registry.select(F.regexp_replace("subject", "-value$", "").alias("topic"), F.lit(".shop.Order").alias("message")).distinct()
    return ds.topic_types(registry, ds.message_fields(described(d.fields(spark, sf))), mapping)


def _order_writers(spark):
    """Both order schemas as a registry keeps them: bytes, from which the fields are read again."""
    rows = [(i, f.no, f.name, f.type, False) for i, fields in ((1, ORDER_V1), (2, ORDER_V2)) for f in fields]
    declared = spark.createDataFrame(rows, "schema_id int, field_no int, name string, type string, reserved boolean")
    found = ds.message_fields(described(declared))
    return ds.writer_fields(found, found.select("schema_id", "message").distinct())


def _decoded(spark, sf, rows):
    writers = _order_writers(spark)
    split = wire.split_envelope(d.order_topic(spark, sf)).drop("magic", "message_index")
    out = with_outcome(ds.decode_registry(split, writers, ds.reader_fields(writers, 1), rows=rows))
    return out.select(
        *ADDRESS, "schema_id", "id", "customer_id", "item", "amount", "status",
        F.unix_millis("created_at").alias("created_ms"), "region", "outcome",
    )


@query("decode_registry", ORACLES["decode_topic"])
def decode_registry(spark, sf):
    return _decoded(spark, sf, 1_000)


@query("decode_registry_joined", ORACLES["decode_topic"])
def decode_registry_joined(spark, sf):
    """As where the registry is too large for a task: each record brings its writer."""
    return _decoded(spark, sf, 0)
