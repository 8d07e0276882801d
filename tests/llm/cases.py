"""Awkward documents, shared by the tests of the corpus operators."""

from pyspark.sql import functions as F

WORDS = "the of and to in is that for it was on as with he be at by had not are but from".split()


def long_text(words: int = 20_000) -> str:
    return " ".join(WORDS[(i * i) % len(WORDS)] + str(i % 97) for i in range(words))


def rows():
    base = " ".join(f"w{i}" for i in range(60))
    return [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"),  # copies and a repeated row
        (3, base.replace("w30", "x"), "en", "b"), (4, base.upper(), None, None),
        (5, None, "fr", "b"), (6, "", "fr", None), (7, " \t\n", "de", "c"), (8, "one two", "en", "c"),
        (9, "one two", None, "c"), (10, long_text(), "en", "a"), (11, "mail bob@host.example.com or +1 (988) 555-2485", "en", "b"),
        (12, "日本語 👩‍👩‍👧 é é <|endoftext|> ÀÉ", "fr", "a"), (None, "no id here", "en", None), (None, None, None, None),
        (13, "Released under the MIT license!\nrest", "en", "d"), (14, "12345 67890", "de", "d"),
    ]


def documents(spark, data=None):
    """The rows as a table with further columns whose names the operators use inside."""
    data = rows() if data is None else data
    frame = spark.createDataFrame(
        [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in data],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    clashes = ["size", "rank", "range", "n", "ids", "src", "h", "sig", "node", "cell", "block", "kept", "term", "key", "row_", "score", "print", "unit"]
    return frame.select("*", *[F.lit("x").alias(c) for c in clashes])


def empty(spark):
    return documents(spark, [])
