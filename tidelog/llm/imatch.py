"""I-Match fingerprints with randomised lexicons (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import block_of, quantiles, table

# Share of documents that a term of the lexicon occurs in. There are at most
# (mean distinct terms of a document) / LOW such terms, however large the corpus is.
LOW, HIGH = 0.001, 0.2
# Bits of the lexicon's filter; a term outside the band passes with the chance of a set bit.
BITS = 1 << 22
# Subsets keep from a quarter of the terms, so that short texts fill most hashes and four of
# five terms are in some subset, to one in 4,096, so that some hash of a very long text
# survives an edit.
SUBSETS, COARSEST, SCALES = 33, 2, 11
BLOCK_ROWS, BLOCKS = 2_000, 4_096
EMPTY = "-"


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased runs of letters and digits."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH, bits: int = BITS) -> Column:
    """A filter of the terms whose document share lies in the band, as a constant array.

    Frequencies are counted over all documents, terms in at least two. The filter is a
    bitmap of fixed size, made in Spark; only its words come to the driver.
    """
    found = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").count()
    total = docs.count()
    chosen = found.filter((F.col("count") >= max(2.0, low * total)) & (F.col("count") <= max(2.0, high * total)))
    slot = F.pmod(F.col("term"), F.lit(bits))
    marked = chosen.select(F.shiftright(slot, 6).alias("at"), F.expr(f"shiftleft(1L, cast(pmod(term, {bits}) % 64 as int))").alias("bit"))
    words = [0] * (bits // 64)
    for row in marked.groupBy("at").agg(F.bit_or("bit").alias("bit")).collect():
        words[row["at"]] = row["bit"]
    return F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")


def fingerprint(text: Column, known: Column, bits: int = BITS) -> Column:
    """One hash for each randomised subset of the lexicon; null where no term is in it.

    Subset i keeps one term in ``2 ** (COARSEST + i % SCALES)``, so that some subset is small enough
    to survive an edit, whatever the length of the text. A text with no term of the lexicon
    is judged by all its terms, one without terms by itself.
    """
    def member(t: Column) -> Column:
        slot = F.pmod(t, F.lit(bits))
        word = F.get(known, F.shiftright(slot, 6).cast("int"))
        return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))) != 0

    def choose(every: Column) -> Column:
        return _with(
            F.filter(every, member),
            lambda inside: F.when(F.size(inside) > 0, inside).when(F.size(every) > 0, every).otherwise(F.array(F.xxhash64(text))),
        )

    # A value that is used twice is the argument of a one-element transform: computed once.
    return _with(_with(F.sort_array(terms(text)), choose), _hashes)


def _hashes(used: Column) -> Column:
    """All subsets' hashes; a text too short for any subset has those of all its terms."""
    whole = F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda i: F.xxhash64(used, i))
    found = F.array(*[_hash(used, i) for i in range(SUBSETS)])
    return _with(found, lambda h: F.when(F.exists(h, lambda x: x.isNotNull()), h).otherwise(whole))


def _hash(used: Column, i: int) -> Column:
    mask = (1 << (COARSEST + i % SCALES)) - 1
    kept = F.filter(used, lambda t: F.xxhash64(t, F.lit(i)).bitwiseAND(F.lit(mask).cast("long")) == 0)
    return _with(kept, lambda k: F.when(F.size(k) > 0, F.xxhash64(k, F.lit(i))))


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shown(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda h: F.coalesce(F.lpad(F.lower(F.hex(h)), 16, "0"), F.lit(EMPTY))), ":")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that are not empty in both."""
    pairs = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: p["a"].isNotNull() | p["b"].isNotNull())
    same = F.filter(pairs, lambda p: p["a"] == p["b"])
    return F.when(F.size(pairs) > 0, F.size(same) / F.size(pairs)).otherwise(F.lit(1.0))


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``next_<c>``: the values in the row with the next ``doc_id``, after the last the first.

    Rows ``doc_id, text, ...`` are dealt to blocks of ``doc_id``; the first row of a block is
    also sent to the end of the block before, and the first of all to the last block. Null
    ids come first, equal ids in order of their text.
    """
    facts = rows.agg(F.count("*").alias("n"), F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    bounds = quantiles(rows, "doc_id", min(BLOCKS, 1 + facts["n"] // BLOCK_ROWS))
    if bounds and bounds[0] == facts["least"] and not facts["nulls"]:
        bounds = bounds[1:]
    own = block_of("doc_id", bounds)

    def place(block: Column, late: int) -> Column:
        return F.struct(block.cast("int").alias("block"), F.lit(late).alias("late"))

    opens = F.col("doc_id").isin(*bounds)
    first = F.col("doc_id").isNull() if facts["nulls"] else F.coalesce(F.col("doc_id") == F.lit(facts["least"]), F.lit(False))
    places = F.filter(
        F.array(
            place(own, 0),
            F.when(F.coalesce(opens, F.lit(False)), place(own - 1, 1)),
            F.when(first, place(F.lit(len(bounds)), 2)),
        ),
        lambda p: p.isNotNull(),
    )
    dealt = rows.withColumn("place", F.explode(places)).select("*", "place.block", "place.late").drop("place")
    order = Window.partitionBy("block").orderBy("late", F.col("doc_id").asc_nulls_first(), "text")
    out = dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return out.filter("late = 0").drop("block", "late")


def fingerprints(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last quarter replaced by the beginning of the next document in
    order of ``doc_id``. Equal texts have equal fingerprints; a null text is an empty one,
    and empty texts are alike. Repeated rows follow one another; other columns are ignored;
    no rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = lexicon(rows, low, high)
    printed = rows.withColumn("print", fingerprint(F.col("text"), known))
    followed = with_next(printed, ["text", "print"]).withColumn("n_chars", F.char_length("text").cast("long"))
    moved = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - moved), F.substring("next_text", F.lit(1), moved))
    done = followed.withColumn("edited", edited).withColumn("edited_print", fingerprint(F.col("edited"), known))
    return done.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), shown(F.col("print")).alias("fingerprint"),
        shown(F.col("edited_print")).alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
