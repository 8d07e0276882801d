"""Queries over a registry with many subjects and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import registry as reg
from tidelog.plans import derive as d
from tidelog.plans import sql as s
from tidelog.plans.catalog import query
from tidelog.scratch import cut


@query(
    "schema_latest",
    f"WITH {s.REGISTRY} SELECT subject, max(version) AS version, arg_max(schema_id, version) AS schema_id FROM registry GROUP BY subject",
)
def schema_latest(spark, sf):
    return reg.latest(d.registry(spark, sf)).select("subject", "version", "schema_id")


@query("schema_subjects", f"WITH {s.REGISTRY} SELECT DISTINCT subject FROM registry")
def schema_subjects(spark, sf):
    return reg.subjects(d.registry(spark, sf))


@query(
    "compat_mode",
    f"WITH {s.REGISTRY} SELECT subject, coalesce(CASE max(status) WHEN 'O' THEN 'FULL' WHEN 'P' THEN 'NONE' END, 'BACKWARD') AS mode FROM registry GROUP BY subject",
)
def compat_mode(spark, sf):
    status = F.max("status")
    mode = F.when(status == "O", "FULL").when(status == "P", "NONE")
    return reg.modes(d.registry(spark, sf).groupBy("subject").agg(mode.alias("mode")))


def _ends(spark, sf):
    """Live fields of the first and of the newest version of every subject, and which versions those are."""
    r = d.registry(spark, sf).select("subject", "version", "schema_id")
    edge = r.groupBy("subject").agg(
        F.min_by("schema_id", "version").alias("first"), F.max_by("schema_id", "version").alias("newest"),
        F.min("version").alias("old_version"), F.max("version").alias("new_version"),
    )
    live = d.fields(spark, sf).where(~F.col("reserved")).drop("reserved")
    old = edge.join(live, edge["first"] == live["schema_id"]).select("subject", "field_no", "name", "type")
    new = edge.join(live, edge["newest"] == live["schema_id"]).select("subject", "field_no", "name", "type")
    return old, new, edge.select("subject", "old_version", "new_version")


ENDS = f"""{s.REGISTRY}, edge AS (
  SELECT subject, arg_min(schema_id, version) AS first, arg_max(schema_id, version) AS newest, max(version) AS newest_version
  FROM registry GROUP BY subject),
live AS (SELECT * FROM fields WHERE NOT reserved),
old AS (SELECT subject, field_no, name, type FROM edge JOIN live ON first = schema_id),
new AS (SELECT subject, field_no, name, type FROM edge JOIN live ON newest = schema_id)"""

# A number of the newest version that was not declared in some version after the first, and had
# another name before that pause.
BACK = """kept AS (SELECT d.subject, d.version, d.field_no, d.name FROM declared d WHERE NOT d.reserved),
now AS (SELECT k.* FROM kept k JOIN edge e ON k.subject = e.subject AND k.version = e.newest_version),
run AS (
  SELECT n.*, coalesce((SELECT max(r.version) FROM registry r WHERE r.subject = n.subject AND r.version < n.version
    AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.subject = r.subject AND k.version = r.version AND k.field_no = n.field_no
      AND k.name = n.name)), 0) AS broken FROM now n),
back AS (
  SELECT subject, field_no FROM run n WHERE broken > 0
    AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.subject = n.subject AND k.version = n.broken AND k.field_no = n.field_no)
    AND EXISTS (SELECT 1 FROM kept k WHERE k.subject = n.subject AND k.version < n.broken AND k.field_no = n.field_no AND k.name <> n.name))"""


@query(
    "field_diff",
    f"""WITH {ENDS}, {BACK}, both_ AS (
  SELECT coalesce(o.subject, n.subject) AS subject, coalesce(o.field_no, n.field_no) AS field_no,
         o.name AS old_name, n.name AS new_name, o.type AS old_type, n.type AS new_type
  FROM old o FULL JOIN new n ON o.subject = n.subject AND o.field_no = n.field_no),
moved AS (
  SELECT *, (SELECT field_no FROM old o WHERE o.subject = b.subject AND o.name = b.new_name) AS moved_from,
         (SELECT field_no FROM new n WHERE n.subject = b.subject AND n.name = b.old_name) AS moved_to FROM both_ b)
SELECT *, CASE WHEN coalesce(moved_from <> field_no, false) OR coalesce(moved_to <> field_no, false) THEN 'renumbered'
  WHEN old_name IS NULL THEN 'added' WHEN new_name IS NULL THEN 'removed'
  WHEN old_type <> new_type THEN 'retyped' WHEN old_name <> new_name THEN 'renamed' ELSE 'same' END AS change,
  (subject, field_no) IN (SELECT (subject, field_no) FROM back) AS reused,
  coalesce(moved_from <> field_no, false) OR coalesce(moved_to <> field_no, false) AS renumbered,
  old_name IS NULL AS added, new_name IS NULL AS removed,
  coalesce(old_type <> new_type, false) AS retyped, coalesce(old_name <> new_name, false) AS renamed FROM moved""",
)
def field_diff(spark, sf):
    old, new, pairs = _ends(spark, sf)
    runs = reg.lifetimes(d.registry(spark, sf), d.fields(spark, sf))
    return reg.field_diff(old, new, ["subject"], reg.reused_since(runs, pairs))


@query(
    "field_lifetimes",
    f"""WITH {s.REGISTRY}, g AS (
  SELECT *, version - row_number() OVER (PARTITION BY subject, field_no, name ORDER BY version) AS run FROM declared WHERE NOT reserved),
r AS (
  SELECT subject, field_no, name, min(version) AS first_version, max(version) AS last_version FROM g GROUP BY subject, field_no, name, run)
SELECT *, first_version > 1 AND NOT EXISTS (
    SELECT 1 FROM declared k WHERE NOT k.reserved AND k.subject = r.subject AND k.field_no = r.field_no AND k.version = r.first_version - 1)
  AND EXISTS (
    SELECT 1 FROM declared k WHERE NOT k.reserved AND k.subject = r.subject AND k.field_no = r.field_no AND k.version < r.first_version
      AND k.name <> r.name) AS reused FROM r""",
)
def field_lifetimes(spark, sf):
    """Runs of versions in which a number has one name, in blocks of two versions."""
    return reg.lifetimes(d.registry(spark, sf), d.fields(spark, sf), width=2).drop("first_rank", "last_rank")


SAFE = "(o.type IN ('string', 'bytes') AND n.type IN ('string', 'bytes') OR o.type IN ('int32', 'int64') AND n.type IN ('int32', 'int64') OR o.type = n.type)"


@query(
    "type_change",
    f"WITH {ENDS} SELECT o.type AS old_type, n.type AS new_type, count(*) AS n, {SAFE} AS backward, {SAFE} AS forward "
    "FROM old o JOIN new n ON o.subject = n.subject AND o.field_no = n.field_no GROUP BY o.type, n.type",
)
def type_change(spark, sf):
    old, new, _ = _ends(spark, sf)
    pairs = old.select("subject", "field_no", F.col("type").alias("old_type")).join(
        new.select("subject", "field_no", F.col("type").alias("new_type")), ["subject", "field_no"]
    )
    return reg.type_change(pairs.groupBy("old_type", "new_type").agg(F.count("*").alias("n")))


# The twin compares pairs of versions directly, which the library must not do.
_PAIR = "n.subject = o.subject AND o.version < n.version"


MOVED = "n.name = o.name AND NOT o.reserved AND n.field_no <> o.field_no"
RESERVED = "n.field_no = o.field_no AND o.reserved"
RENAMED = "n.field_no = o.field_no AND NOT o.reserved AND n.name <> o.name"


def _verdicts(backward: str, forward: str, registry: str = "registry", declared: str = "declared") -> str:
    """The verdicts by pairs of versions, for two rules of safe changes from ``o.type`` to ``n.type``."""
    return f"""ordered AS (
  SELECT subject, version, schema_id, lag(version) OVER (PARTITION BY subject ORDER BY version) AS before FROM {registry}),
told AS (SELECT d.*, r.before FROM {declared} d JOIN ordered r ON d.subject = r.subject AND d.version = r.version),
pairs AS (
  SELECT n.subject, n.version, o.version = n.before AS near,
         n.field_no = o.field_no AND NOT o.reserved AND NOT {backward} AS retyped,
         n.field_no = o.field_no AND NOT o.reserved AND NOT {forward} AS back_retyped,
         {MOVED} AS moved, {RESERVED} AS reserved_no, {RENAMED} AS renamed,
         n.field_no = o.field_no AND NOT o.reserved AND n.name <> o.name AND p.version IS NULL AS back
  FROM told n JOIN told o ON {_PAIR} AND (n.field_no = o.field_no OR n.name = o.name)
  LEFT JOIN told p ON p.subject = n.subject AND p.field_no = n.field_no AND p.version = n.before AND NOT p.reserved
  WHERE NOT n.reserved),
v AS (
  SELECT subject, version, bool_or(near AND (retyped OR moved OR reserved_no)) AS b_prev,
         bool_or(near AND (back_retyped OR moved OR reserved_no)) AS f_prev,
         bool_or(retyped OR moved OR reserved_no OR back) AS b_any,
         bool_or(back_retyped OR moved OR reserved_no OR back) AS f_any,
         bool_or(reserved_no OR back) AS number_reused, bool_or(near AND renamed) AS source_break
  FROM pairs GROUP BY subject, version)
SELECT subject, version, schema_id, NOT coalesce(b_prev, false) AS backward, NOT coalesce(f_prev, false) AS forward,
  NOT coalesce(b_prev OR f_prev, false) AS "full", NOT coalesce(b_any, false) AS transitive_backward,
  NOT coalesce(f_any, false) AS transitive_forward, NOT coalesce(b_any OR f_any, false) AS transitive_full, true AS "none",
  coalesce(number_reused, false) AS number_reused, coalesce(source_break, false) AS source_break
FROM ordered LEFT JOIN v USING (subject, version)"""


@query("compat_matrix", f"WITH {s.REGISTRY}, {_verdicts(SAFE, SAFE)}")
def compat_matrix(spark, sf):
    return reg.compat(d.registry(spark, sf), d.fields(spark, sf))


WIDER = "(o.type = n.type OR o.type = 'int32' AND n.type = 'int64' OR o.type = 'string' AND n.type = 'bytes')"
NARROWER = "(o.type = n.type OR o.type = 'int64' AND n.type = 'int32' OR o.type = 'bytes' AND n.type = 'string' OR o.type = 'string' AND n.type = 'bytes')"


@query("compat_one_sided", f"WITH {s.REGISTRY}, {_verdicts(WIDER, NARROWER)}")
def compat_one_sided(spark, sf):
    """A strict registry: a wider type is for new readers only, a narrower one for old readers only."""
    rules = [("int32", "int64", True, False), ("int64", "int32", False, True), ("string", "bytes", True, True), ("bytes", "string", False, True)]
    return reg.compat(d.registry(spark, sf), d.fields(spark, sf), rules=spark.createDataFrame(rules, reg.RULES))


@query(
    "compat_dropped",
    f"WITH {s.REGISTRY}, kept AS (SELECT * FROM registry WHERE status <> 'O'), left_ AS (SELECT d.* FROM declared d JOIN kept k USING (subject, version)), "
    + _verdicts(SAFE, SAFE, "kept", "left_"),
)
def compat_dropped(spark, sf):
    """The versions of open orders were dropped, so that those before and after them are neighbours."""
    r = d.registry(spark, sf)
    return reg.compat(reg.drop_versions(r, r.where("status = 'O'")), d.fields(spark, sf))


@query(
    "reserved_use",
    f"""WITH {s.REGISTRY} SELECT subject, version, field_no, name, number_reserved, name_reserved FROM (
  SELECT n.subject, n.version, n.field_no, n.name,
         EXISTS (SELECT 1 FROM declared o WHERE o.subject = n.subject AND o.version < n.version AND o.reserved AND o.field_no = n.field_no) AS number_reserved,
         EXISTS (SELECT 1 FROM declared o WHERE o.subject = n.subject AND o.version < n.version AND o.reserved AND o.name = n.name) AS name_reserved
  FROM declared n WHERE NOT n.reserved) WHERE number_reserved OR name_reserved""",
)
def reserved_use(spark, sf):
    return reg.reserved_use(d.registry(spark, sf), d.fields(spark, sf))


@query(
    "schema_drop",
    """WITH s AS (SELECT DISTINCT 'customer-' || o_custkey || '-value' AS subject, o_orderpriority AS shape,
    o_orderdate < TIMESTAMP '1998-01-01' AS early FROM orders),
ids AS (SELECT shape, row_number() OVER (ORDER BY min(subject), sha256(shape)) AS id FROM s WHERE early GROUP BY shape),
kept AS (SELECT subject, shape, lead(id) OVER (PARTITION BY subject ORDER BY id) IS NULL AS dropped FROM s JOIN ids USING (shape) WHERE early),
a AS (SELECT subject, count(*) AS n, count(*) FILTER (NOT dropped) AS live FROM kept GROUP BY subject),
b AS (SELECT subject, count(*) AS n FROM s WHERE NOT early AND (subject, shape) NOT IN (SELECT (subject, shape) FROM kept WHERE NOT dropped) GROUP BY subject)
SELECT subject, (coalesce(a.live, 0) + coalesce(b.n, 0))::INTEGER AS versions, (coalesce(a.n, 0) + coalesce(b.n, 0))::INTEGER AS top
FROM a FULL JOIN b USING (subject) WHERE coalesce(a.live, 0) + coalesce(b.n, 0) > 0""",
)
def schema_drop(spark, sf):
    """The newest version of each subject is dropped before later schemas are registered."""
    early, late, empty = _shapes(spark, sf)
    first = cut(reg.register(empty, early))
    newest = first.groupBy("subject").agg(F.max("version").alias("version"))
    both = reg.register(reg.drop_versions(first, newest), late)
    return reg.live(both).groupBy("subject").agg(F.count("*").cast("int").alias("versions")).join(
        both.groupBy("subject").agg(F.max("version").alias("top")), "subject"
    )


@query(
    "register_versions",
    """WITH s AS (SELECT 'customer-' || o_custkey || '-value' AS subject, o_orderpriority AS shape, min(o_orderkey) AS k FROM orders GROUP BY ALL)
SELECT subject, count(*)::INTEGER AS versions, count(DISTINCT shape)::INTEGER AS shapes FROM s GROUP BY subject""",
)
def register_versions(spark, sf):
    """Schemas seen from 1998 on are registered after those of before; five shapes exist in all."""
    early, late, empty = _shapes(spark, sf)
    both = reg.register(reg.register(empty, early), late)
    return both.groupBy("subject").agg(
        F.count("*").cast("int").alias("versions"), F.countDistinct("schema_id").cast("int").alias("shapes")
    )


def _shapes(spark, sf):
    """Schemas of orders from before 1998, of later ones, and an empty registry."""
    orders = d.table(spark, sf, "orders").select(
        F.concat(F.lit("customer-"), F.col("o_custkey").cast("string"), F.lit("-value")).alias("subject"),
        F.lit("Order").alias("message"), F.col("o_orderpriority").cast("binary").alias("descriptor"), "o_orderdate",
    )
    early = F.col("o_orderdate") < F.lit(d.NEWER).cast("timestamp_ntz")
    empty = spark.createDataFrame([], "subject string, version int, schema_id int, message string, descriptor binary")
    return orders.where(early).drop("o_orderdate"), orders.where(~early).drop("o_orderdate"), empty
