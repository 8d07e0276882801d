"""Schema versions as tables: registration, differences, compatibility, drift.

``REGISTRY`` rows name the versions of a subject; ``FIELDS`` rows declare the fields of a
schema id, with ``reserved`` rows for numbers and names that must not come back. Verdicts
compare each version with its history by ordered aggregates per field number and per field
name. No two versions are ever paired, so a subject with a long history stays linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.operators.blocks import before, before_all, block_id, number_rows
from tidelog.scratch import cut

# Versions of one subject that are ordered in one task; longer histories are cut into blocks.
WIDTH = 1 << 16

# Type changes that keep the meaning of old bytes (from, to).
SAFE_CHANGES = [("string", "bytes"), ("bytes", "string"), ("int32", "int64"), ("int64", "int32")]
TYPES = [
    "double", "float", "int32", "int64", "uint32", "uint64", "sint32", "sint64", "fixed32", "fixed64",
    "sfixed32", "sfixed64", "bool", "enum", "string", "bytes", "message", "timestamp",
]
RULES = "old_type string, new_type string, backward boolean, forward boolean"
MODES = [
    "BACKWARD", "FORWARD", "FULL", "TRANSITIVE_BACKWARD", "TRANSITIVE_FORWARD", "TRANSITIVE_FULL", "NONE",
]


def type_rules(spark: SparkSession) -> DataFrame:
    """SCH-5: the changes that are safe. A one-sided rule sets one direction only: ``backward``
    says that new readers understand old bytes, ``forward`` that old readers understand new ones."""
    return spark.createDataFrame([(a, b, True, True) for a, b in SAFE_CHANGES], RULES)


def type_change(changes: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """SCH-5: whether each change from ``old_type`` to ``new_type`` is safe; unknown ones are not."""
    rules = type_rules(changes.sparkSession) if rules is None else rules
    same = F.col("old_type") == F.col("new_type")
    joined = changes.join(rules, ["old_type", "new_type"], "left")
    return joined.withColumn("backward", same | F.coalesce("backward", F.lit(False))).withColumn(
        "forward", same | F.coalesce("forward", F.lit(False))
    )


def live(registry: DataFrame) -> DataFrame:
    """The versions that were not dropped, without the flag."""
    if "dropped" not in registry.columns:
        return registry
    return registry.where(~F.coalesce("dropped", F.lit(False))).drop("dropped")


def register(registry: DataFrame, new: DataFrame) -> DataFrame:
    """SCH-1: the registry with new schemas added.

    ``new(subject, message, descriptor)``. A schema its subject already has is not added
    again; one known elsewhere, dropped or not, keeps its id; others get the next ids, in
    subject order. Ids and version numbers of dropped versions are not given out again.
    """
    mark = F.sha2(F.col("descriptor"), 256)
    known = registry.withColumn("_mark", mark)
    fresh = (
        new.withColumn("_mark", mark).dropDuplicates(["subject", "_mark"])
        .join(live(known).select("subject", "_mark"), ["subject", "_mark"], "left_anti")
    )
    ids = known.groupBy("_mark").agg(F.min("schema_id").alias("_id"))
    unseen = fresh.select("_mark").distinct().join(ids, "_mark", "left_anti")
    top = registry.agg(F.max("schema_id")).first()[0] or 0
    first = fresh.groupBy("_mark").agg(F.min("subject").alias("_by"))
    numbered = number_rows(
        unseen.join(first, "_mark").withColumn("_all", F.lit(1)), ["_all"], ["_by", "_mark"], "_next"
    )
    added = numbered.select("_mark", (F.col("_next") + top + 1).alias("_id"))
    versions = registry.groupBy("subject").agg(F.max("version").alias("_version"))
    placed = number_rows(fresh.join(ids.unionByName(added), "_mark"), ["subject"], ["_id"], "_turn", unique="_id")
    rows = (
        placed.join(versions, "subject", "left")
        .select(
            "subject",
            (F.coalesce("_version", F.lit(0)) + F.col("_turn") + 1).cast("int").alias("version"),
            F.col("_id").cast("int").alias("schema_id"), "message", "descriptor",
        )
    )
    return registry.unionByName(rows, allowMissingColumns=True)


def subjects(registry: DataFrame) -> DataFrame:
    """SCH-2: all subjects."""
    return live(registry).select("subject").distinct()


def latest(registry: DataFrame) -> DataFrame:
    """SCH-2: newest version of every subject."""
    registry = live(registry)
    rest = [c for c in registry.columns if c != "subject"]
    return registry.groupBy("subject").agg(F.max_by(F.struct(*rest), "version").alias("r")).select(
        "subject", "r.*"
    )


def by_id(registry: DataFrame, schema_id: int) -> DataFrame:
    """SCH-2: where a schema id is used; bytes on a log may still need a dropped one."""
    return registry.where(F.col("schema_id") == schema_id)


def drop_version(registry: DataFrame, subject: str, version: int) -> DataFrame:
    """SCH-3: the registry with one version marked as dropped."""
    which = registry.sparkSession.createDataFrame([(subject, version)], "subject string, version int")
    return drop_versions(registry, which)


def drop_versions(registry: DataFrame, which: DataFrame) -> DataFrame:
    """SCH-3: versions ``which(subject, version)`` marked as ``dropped``.

    The rows stay, so that ``register`` gives out neither their ids nor their numbers again.
    """
    already = F.coalesce("dropped", F.lit(False)) if "dropped" in registry.columns else F.lit(False)
    hit = which.select("subject", "version", F.lit(True).alias("_hit")).distinct()
    marked = registry.join(hit, ["subject", "version"], "left")
    return marked.withColumn("dropped", already | F.coalesce("_hit", F.lit(False))).drop("_hit")


def modes(config: DataFrame, global_mode: str | None = None) -> DataFrame:
    """SCH-7: compatibility mode of each subject; ``config(subject, mode)``, mode may be null."""
    return config.select("subject", F.coalesce("mode", F.lit(global_mode), F.lit("BACKWARD")).alias("mode"))


def ranked(registry: DataFrame, width: int = WIDTH) -> DataFrame:
    """``subject, version, schema_id, rank`` of the live versions, ranked from 0 without holes.

    Numbers of dropped versions do not come back, so the version before another one is the
    live version with the rank before, whatever its number.
    """
    kept = live(registry).select("subject", "version", "schema_id")
    return number_rows(kept, ["subject"], ["version"], "rank", unique="version", width=width)


def lifetimes(registry: DataFrame, fields: DataFrame, width: int = WIDTH) -> DataFrame:
    """SCH-4: the runs of live versions in which a number carries one name.

    ``subject, field_no, name, first_version, last_version, first_rank, last_rank, reused``.
    A run ends where the next live version does not declare the number or declares it with
    another name. ``reused``: the run begins after a pause of the number that had another
    name before, so bytes of then would be read as something else.
    """
    versions = cut(ranked(registry, width))
    rows = versions.join(fields.where(~F.col("reserved")), "schema_id").select("subject", "field_no", "name", "version", "rank")
    if (top := _highest(versions)) >= width:
        return _runs_across(cut(_runs_inside(rows, width)))
    history = {"_prev": ("last", F.struct("rank", "name")), "_low": ("min", "name"), "_high": ("max", "name")}
    seen = before(rows, ["subject", "field_no"], "rank", history, width, top=top)
    paused, starts, other = _breaks()
    marked = seen.withColumn("_starts", starts.cast("int")).withColumn("_reused", paused & other)
    runs = before(marked, ["subject", "field_no"], "rank", {"_run": ("sum", "_starts")}, width, inclusive=True, top=top)
    return runs.groupBy("subject", "field_no", "_run").agg(
        F.min_by("name", "rank").alias("name"), F.min("version").alias("first_version"), F.max("version").alias("last_version"),
        F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"), F.bool_or("_reused").alias("reused"),
    ).drop("_run")


def _breaks() -> tuple[Column, Column, Column]:
    """From ``_prev``, ``_low`` and ``_high``: a pause lies before the row, a run starts with it, the number had another name."""
    no = F.lit(False)
    paused = F.coalesce(F.col("_prev.rank") < F.col("rank") - 1, no)
    starts = F.col("_prev").isNull() | paused | F.coalesce(F.col("_prev.name") != F.col("name"), no)
    return paused, starts, F.coalesce((F.col("_low") != F.col("name")) | (F.col("_high") != F.col("name")), no)


def _runs_inside(rows: DataFrame, width: int) -> DataFrame:
    """The runs of each block of ``width`` versions, ``_first`` and ``_last`` of their number in it or between.

    ``_reused`` is what the block itself shows; ``_open`` runs begin after a pause, and whether
    the number had another name is up to earlier blocks. The last run of a number carries the
    least and the greatest name of all its runs in the block, the first whether one between
    them is open (``_asks``). The rows of a block are moved together, once.
    """
    spot = ["subject", "_blk"]
    inside = Window.partitionBy(*spot, "field_no").orderBy("rank")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_blk", block_id("rank", width)).repartition(*spot)
    seen = placed.withColumns({
        "_prev": F.lag(F.struct("rank", "name")).over(inside), "_low": F.min("name").over(earlier), "_high": F.max("name").over(earlier),
    })
    paused, starts, other = _breaks()
    begun = F.when(starts, F.struct("name", (paused & other).alias("reused"), (paused & ~other).alias("open")))
    marked = seen.withColumn("_begun", begun).withColumn(
        "_run", F.count("_begun").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    runs = marked.groupBy(*spot, "field_no", "_run").agg(
        F.max("_begun").alias("_begun"), F.max_by("name", "rank").alias("_end"), F.min("name").alias("_least"), F.max("name").alias("_most"),
        F.min("version").alias("first_version"), F.max("version").alias("last_version"),
        F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
    )
    block = Window.partitionBy(*spot, "field_no")
    first, last = F.col("_run") == 1, F.col("_run") == F.max("_run").over(block)
    return runs.withColumns({"_first": first, "_last": last}).select(
        *spot, "field_no", "_begun.name", "_end", "first_version", "last_version", "first_rank", "last_rank", "_first", "_last",
        F.col("_begun.reused").alias("_reused"), F.col("_begun.open").alias("_open"),
        F.when(F.col("_last"), F.min("_least").over(block)).alias("_least"), F.when(F.col("_last"), F.max("_most").over(block)).alias("_most"),
        (F.col("_first") & F.max(F.col("_begun.open") & ~F.col("_last")).over(block)).alias("_asks"),
    )


def _runs_across(runs: DataFrame) -> DataFrame:
    """Runs of blocks made whole: only the first and last ones of a number in a block meet those of other blocks."""
    no = F.lit(False)
    ordered, back = (Window.partitionBy("subject", "field_no").orderBy(o) for o in (F.asc("first_rank"), F.desc("first_rank")))
    earlier, later = ordered.rowsBetween(Window.unboundedPreceding, -1), back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = runs.where(F.col("_first") | F.col("_last")).repartition("subject").withColumn("rank", F.col("first_rank")).withColumns({
        "_prev": F.lag(F.struct(F.col("last_rank").alias("rank"), F.col("_end").alias("name"))).over(ordered),
        "_low": F.min("_least").over(earlier), "_high": F.max("_most").over(earlier),
    })
    paused, starts, other = _breaks()
    edges = edges.withColumn("_joined", F.col("_first") & ~starts)
    ends = ~F.coalesce(F.lag("_joined").over(back), no)
    edges = edges.withColumn("_ends", ends).withColumns({
        "last_version": F.min(F.when(F.col("_ends"), F.col("last_version"))).over(later),
        "last_rank": F.min(F.when(F.col("_ends"), F.col("last_rank"))).over(later),
        "reused": F.col("_reused") | (F.when(F.col("_first"), paused).otherwise(F.col("_open")) & other),
    })
    run = ["subject", "field_no", "name", "first_version", "last_version", "first_rank", "last_rank"]
    edges = cut(edges.where(~F.col("_joined") | F.col("_asks")).select("_blk", *run, "reused", "_joined", "_asks", "_low", "_high"))
    # Open runs between the first and the last one ask for the names of earlier blocks.
    between = runs.where(~F.col("_first") & ~F.col("_last")).withColumn("_at", F.struct("subject", "field_no", "_blk"))
    asked = edges.where("_asks").select(F.struct("subject", "field_no", "_blk").alias("_at"), "_low", "_high")
    still = between.where("_open").join(asked, "_at", "left").select(*run, other.alias("reused"))
    known = between.where(~F.col("_open")).select(*run, F.col("_reused").alias("reused"))
    return edges.where(~F.col("_joined")).select(*run, "reused").unionByName(known).unionByName(still)


def field_diff(old: DataFrame, new: DataFrame, keys: list[str], reused: DataFrame | None = None) -> DataFrame:
    """SCH-4: what happened to each field between two versions.

    ``old`` and ``new`` carry ``keys`` (such as the subject), ``field_no``, ``name`` and
    ``type``. A number that now belongs to a name the old version had elsewhere, or whose
    name has moved elsewhere, is ``renumbered``; a number that both versions have is
    ``renamed`` and ``retyped`` each by itself. ``reused`` names the numbers (``keys``,
    ``field_no``) that came back with another name since the old version, as ``reused_since``
    finds them. ``change`` is the first flag that is set.
    """
    at = [*keys, "field_no"]
    a = old.select(*at, F.col("name").alias("old_name"), F.col("type").alias("old_type"))
    b = new.select(*at, F.col("name").alias("new_name"), F.col("type").alias("new_type"))
    came = old.select(*keys, F.col("name").alias("new_name"), F.col("field_no").alias("moved_from"))
    went = new.select(*keys, F.col("name").alias("old_name"), F.col("field_no").alias("moved_to"))
    both = a.join(b, at, "full").join(came, [*keys, "new_name"], "left").join(went, [*keys, "old_name"], "left")
    if reused is None:
        both = both.withColumn("_back", F.lit(None).cast("boolean"))
    else:
        both = both.join(reused.select(*at, F.lit(True).alias("_back")).distinct(), at, "left")
    moved = (F.col("moved_from") != F.col("field_no")) | (F.col("moved_to") != F.col("field_no"))
    flags = {
        "reused": F.col("_back") & F.col("new_name").isNotNull(),
        "renumbered": moved,
        "added": F.col("old_name").isNull(),
        "removed": F.col("new_name").isNull(),
        "retyped": F.col("old_type") != F.col("new_type"),
        "renamed": F.col("old_name") != F.col("new_name"),
    }
    flags = {name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()}
    change = F.lit("same")
    for name in ("renamed", "retyped", "removed", "added", "renumbered"):
        change = F.when(flags[name], name).otherwise(change)
    return both.select(
        *at, "old_name", "new_name", "old_type", "new_type", "moved_from", "moved_to", change.alias("change"),
        *[flag.alias(name) for name, flag in flags.items()],
    )


def reused_since(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``subject, field_no`` of the numbers that came back with another name after ``old_version``.

    ``runs`` are ``lifetimes``; ``pairs(subject, old_version, new_version)``. The run that
    holds in the new version must have begun after the old one.
    """
    held = runs.where("reused").join(pairs, "subject")
    now = (F.col("first_version") > F.col("old_version")) & F.col("new_version").between(F.col("first_version"), F.col("last_version"))
    return held.where(now).select("subject", "field_no")


def _declared(registry: DataFrame, fields: DataFrame, width: int = WIDTH) -> DataFrame:
    return ranked(registry, width).join(fields, "schema_id")


def _bit(kind: str) -> Column:
    pairs = [F.lit(x) for i, t in enumerate(TYPES) for x in (t, 1 << i)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(kind)), F.lit(0)).cast("bigint")


def _safe_masks(rules: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """For each new type, a bit for every old type that it can stand in for: backward, forward.

    Rules of types that no message has do not count, so at most one per pair of types comes
    to the driver.
    """
    known = rules.where(F.col("old_type").isin(TYPES) & F.col("new_type").isin(TYPES))
    agreed = known.groupBy("old_type", "new_type").agg(F.bool_or("backward").alias("b"), F.bool_or("forward").alias("f"))
    backward, forward = ({t: 1 << i for i, t in enumerate(TYPES)} for _ in range(2))
    for row in agreed.collect():
        bit = 1 << TYPES.index(row["old_type"])
        backward[row["new_type"]] |= bit if row["b"] else 0
        forward[row["new_type"]] |= bit if row["f"] else 0
    return backward, forward


def _mask(masks: dict[str, int], kind: str) -> Column:
    pairs = [F.lit(x) for t, m in masks.items() for x in (t, m)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(kind)), F.lit(0)).cast("bigint")


def _highest(versions: DataFrame) -> int:
    return versions.agg(F.max("rank")).first()[0] or 0


def field_history(registry: DataFrame, fields: DataFrame, width: int = WIDTH, rules: DataFrame | None = None) -> DataFrame:
    """Each declared field of each version with the faults it has against earlier versions.

    ``*_prev`` compares with the live version just before, ``*_any`` with all earlier ones.
    Type faults use a bit per type: the types a number ever had, against those its new
    type can stand in for. ``type_*`` is a fault for new readers of old bytes, ``back_type_*``
    one for old readers of new bytes.
    """
    return _history(cut(ranked(registry, width)), fields, width, rules)


def _history(versions: DataFrame, fields: DataFrame, width: int, rules: DataFrame | None) -> DataFrame:
    masks = _safe_masks(type_rules(versions.sparkSession) if rules is None else rules)
    rows = versions.join(fields, "schema_id").select(
        "subject", "version", "schema_id", "rank", "field_no", "name", "type", "reserved"
    )
    used = ~F.col("reserved")
    bit = F.when(used, _bit("type")).otherwise(F.lit(0))
    numbers = {
        "_prev": ("last", F.struct("rank", "reserved", bit.alias("_type"), "name")),
        "_types": ("bit_or", bit),
        "_low_name": ("min", F.when(used, F.col("name"))),
        "_high_name": ("max", F.when(used, F.col("name"))),
        "_last_used": ("max", F.when(used, F.col("rank"))),
        "_ever_reserved": ("max", F.col("reserved").cast("int")),
    }
    names = {
        "_placed": ("last", F.struct("rank", "field_no")), "_low_no": ("min", F.col("field_no")), "_high_no": ("max", F.col("field_no")),
    }
    top = _highest(versions)
    if top < width:
        by_number = before(rows, ["subject", "field_no"], "rank", numbers, width, top=top)
        by_name = before(by_number.where(used), ["subject", "name"], "rank", names, width, top=top)
    else:
        # With carrying, the rows are read more than once: write them down, do not compute them again.
        histories = [(["field_no"], numbers, F.lit(True)), (["name"], names, used)]
        by_name = before_all(cut(rows), ["subject"], "rank", histories, width).where(used)
    just_before = F.col("rank") - 1
    prev_here = F.col("_prev.rank") == just_before
    prev_live = prev_here & ~F.col("_prev.reserved")
    backward, forward = (F.bitwise_not(_mask(m, "type")) for m in masks)
    other_name = (F.col("_low_name") != F.col("name")) | (F.col("_high_name") != F.col("name"))

    def yes(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    return by_name.select(
        "subject", "version", "schema_id", "field_no", "name", "type",
        yes(prev_live & (F.col("_prev._type").bitwiseAND(backward) != 0)).alias("type_prev"),
        yes(F.col("_types").bitwiseAND(backward) != 0).alias("type_any"),
        yes(prev_live & (F.col("_prev._type").bitwiseAND(forward) != 0)).alias("back_type_prev"),
        yes(F.col("_types").bitwiseAND(forward) != 0).alias("back_type_any"),
        yes((F.col("_placed.rank") == just_before) & (F.col("_placed.field_no") != F.col("field_no"))).alias("moved_prev"),
        yes((F.col("_low_no") != F.col("field_no")) | (F.col("_high_no") != F.col("field_no"))).alias("moved_any"),
        yes(prev_here & F.col("_prev.reserved")).alias("reused_prev"),
        (
            yes(F.col("_ever_reserved") == 1)
            | yes((F.col("_last_used") < just_before) & other_name)
        ).alias("reused_any"),
        yes(prev_live & (F.col("_prev.name") != F.col("name"))).alias("renamed"),
    )


def compat(registry: DataFrame, fields: DataFrame, width: int = WIDTH, rules: DataFrame | None = None) -> DataFrame:
    """SCH-6: verdict of every version under every mode, one row per live version.

    Each is compared with the live version before it, or with all earlier live ones; fields
    of dropped versions do not count. Moving a name to another number and reusing a number
    fail in both directions, retyping in the directions that ``rules`` (SCH-5) does not
    allow; renames and deletions do not. ``source_break`` says that code would not compile.
    """
    def fault(*names: str) -> Column:
        hit = F.lit(False)
        for n in names:
            hit = hit | F.col(n)
        return F.coalesce(F.bool_or(hit), F.lit(False))

    prev, any_ = ["moved_prev", "reused_prev"], ["moved_prev", "reused_prev", "moved_any", "reused_any"]
    versions = cut(ranked(registry, width))
    seen = _history(versions, fields, width, rules).groupBy("subject", "version").agg(
        fault("type_prev", *prev).alias("_prev"), fault("back_type_prev", *prev).alias("_back_prev"),
        fault("type_prev", "type_any", *any_).alias("_any"), fault("back_type_prev", "back_type_any", *any_).alias("_back_any"),
        fault("reused_prev", "reused_any").alias("number_reused"),
        fault("renamed").alias("source_break"),
    )
    no = F.lit(False)
    ok = {c: ~F.coalesce(c, no) for c in ("_prev", "_back_prev", "_any", "_back_any")}
    return versions.select("subject", "version", "schema_id").join(seen, ["subject", "version"], "left").select(
        "subject", "version", "schema_id",
        ok["_prev"].alias("backward"), ok["_back_prev"].alias("forward"), (ok["_prev"] & ok["_back_prev"]).alias("full"),
        ok["_any"].alias("transitive_backward"), ok["_back_any"].alias("transitive_forward"),
        (ok["_any"] & ok["_back_any"]).alias("transitive_full"),
        F.lit(True).alias("none"),
        F.coalesce("number_reused", no).alias("number_reused"),
        F.coalesce("source_break", no).alias("source_break"),
    )


def reserved_use(registry: DataFrame, fields: DataFrame) -> DataFrame:
    """SCH-8: fields whose number or name an earlier version of the subject reserved.

    The first version that reserved a number (or name) decides, so each field meets one row.
    """
    rows = _declared(registry, fields)
    first = rows.where("reserved")
    by_no = first.groupBy("subject", "field_no").agg(F.min("version").alias("no_reserved_in"))
    by_name = first.where(F.col("name").isNotNull()).groupBy("subject", "name").agg(
        F.min("version").alias("name_reserved_in")
    )
    early_no = F.coalesce(F.col("no_reserved_in") < F.col("version"), F.lit(False))
    early_name = F.coalesce(F.col("name_reserved_in") < F.col("version"), F.lit(False))
    return (
        rows.where(~F.col("reserved"))
        .join(by_no, ["subject", "field_no"], "left")
        .join(by_name, ["subject", "name"], "left")
        .where(early_no | early_name)
        .select(
            "subject", "version", "field_no", "name",
            early_no.alias("number_reserved"), early_name.alias("name_reserved"),
        )
    )


def schema_drift(wire: DataFrame, fields: DataFrame) -> DataFrame:
    """SCH-9: numbers and wire types on the log against the declared fields.

    ``wire`` comes from ``wire_fields`` with ``schema_id``; it is reduced to one row per
    schema, number and wire type before the join.
    """
    from tidelog.schemas import WIRE

    pairs = [F.lit(x) for t, (w, _) in WIRE.items() for x in (t, w)]
    declared = fields.where(~F.col("reserved")).select(
        "schema_id", "field_no", "name",
        F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("type")), F.lit(2)).alias("declared_wire"),
    )
    seen = wire.where(F.col("decode_error").isNull()).groupBy("schema_id", "field_no", "wire_type").agg(
        F.count("*").alias("n_seen")
    )
    verdict = (
        F.when(F.col("declared_wire").isNull(), "unknown")
        .when(F.col("wire_type").isNull(), "never_seen")
        .when(F.col("wire_type") != F.col("declared_wire"), "mismatch")
        .otherwise("as_declared")
    )
    return declared.join(seen, ["schema_id", "field_no"], "full").select(
        "schema_id", "field_no", "name", "declared_wire", "wire_type",
        F.coalesce("n_seen", F.lit(0)).alias("n_seen"), verdict.alias("verdict"),
    )


def schemas_needed(df: DataFrame) -> DataFrame:
    """SCH-10: schema ids each reader meets. ``df(topic, reader, schema_id)``."""
    return df.groupBy("topic", "reader").agg(F.sort_array(F.collect_set("schema_id")).alias("schema_ids"))
