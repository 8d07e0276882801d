"""A training corpus from raw documents: identify, deduplicate, mask, mix, tokenise.

Each stage takes ``(spark, docs, sf_dir)``, is written as Parquet and read again as the next
one's documents. All but the last return the columns of ``documents``. Every stage works on
null, empty and very long texts, repeated rows, no rows, and tables with further columns,
which it carries along; what it does with them is said in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm import bpe, jaccard, language, mixing, pii
from tidelog.scratch import fresh_path

# A document stays if its language is at least so likely.
LEAST_SCORE = 0.5


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that the labelled ones teach; fill in a missing ``lang``.

    Null texts and texts without a letter or without any known n-gram go, and so do ties. The
    score compares the languages learned and is near 1 for almost any longer text, so one in
    a language that was never learned passes as the nearest. Repeated rows are judged alike.
    """
    model = language.train(docs)
    found = language.identify(docs.select(F.struct("*").alias("row_"), "text"), model, ["row_"])
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[
        F.coalesce("row_.lang", "lang_pred").alias("lang") if c == "lang" else F.col(f"row_.`{c}`") for c in docs.columns
    ])


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles at a similarity of 0.8.

    The smallest ``doc_id`` stays, then the smallest hash of the text; an id counts for its
    own text only, and rows without an id are judged like others, after those with one. Rows
    of equal id (or none) and equal text are one document, of which the first in order of the
    other columns stays. Documents without words are in no group, so each of them stays.
    """
    groups = jaccard.jaccard_groups(docs, words=5, percent=80)
    heads = groups.filter("n_shingles > 0").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("head")
    )
    alone = groups.filter("n_shingles = 0").select("doc_id", "h")
    keys = heads.select("head.doc_id", "head.h").union(alone).distinct().select(F.struct("doc_id", "h").alias("key_"))
    rest = [c for c in docs.columns if c != "text"]
    # Maps have no order.
    ordered = [c for c, kind in docs.dtypes if c != "text" and "map<" not in kind and "variant" not in kind]
    keyed = docs.select(
        F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h")).alias("key_"), "text",
        F.struct(*rest).alias("rest_"), F.struct(*ordered).alias("order_"),
    )
    stay = keyed.join(keys, "key_", "left_semi").groupBy("key_", "text").agg(F.min_by("rest_", "order_").alias("rest_"))
    return stay.select(*[F.col("text") if c == "text" else F.col(f"rest_.`{c}`") for c in docs.columns])


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in every text by its kind, and count the characters anew.

    No document goes; a null text stays null, and so does its ``n_chars``.
    """
    found = pii.scan(docs.select(F.struct("*").alias("row_"), "text"), pii.train(docs), ["row_"])
    new = {"text": F.col("masked"), "n_chars": F.when(F.col("spans") == "", F.col("row_.n_chars")).otherwise(F.char_length("masked").cast("long"))}
    return found.select(*[new[c].alias(c) if c in new else F.col(f"row_.`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture of the sources takes it (not at all, once or twice).

    Documents without words are never taken. Rows that share an id, a source and a size are
    taken in their order of text.
    """
    plan = mixing.mix(docs).filter("times > 0").select(
        F.struct("doc_id", "source", "size").alias("key_"), "times"
    )
    same = Window.partitionBy("key_").orderBy(F.desc("times"))
    plan = plan.withColumn("nth_", F.row_number().over(same))
    size = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)).cast("long")
    keyed = docs.select(F.struct("*").alias("row_"), F.struct("doc_id", "source", size.alias("size")).alias("key_"))
    keyed = keyed.withColumn("nth_", F.row_number().over(Window.partitionBy("key_").orderBy("row_.text")))
    taken = keyed.join(plan, ["key_", "nth_"]).withColumn("turn_", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return taken.select("row_.*")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every document of the mixture."""
    return bpe.encode_documents(docs, texts=True).drop("decoded")


STAGES = [("language", identify), ("near_duplicates", deduplicate), ("pii", mask), ("mixing", mix), ("tokens", tokenise)]
# Models, connected components and vocabularies are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
