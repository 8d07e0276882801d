"""Line deduplication against a plain pass over all lines."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import documents, empty, long_text
from tidelog.llm import lines


def plain(data, min_docs, min_chars):
    """``(doc_id, text) -> kept text`` by dictionaries; rows of equal id and text share a place."""
    docs, places = defaultdict(int), defaultdict(set)
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    for doc_id, text in data:
        parts = (text or "").split("\n")
        for k in {key(p) for p in parts}:
            docs[k] += 1
        for pos, p in enumerate(parts):
            places[key(p)].add((doc_id, text, pos))
    gone = set()
    for k, found in places.items():
        if len(k) >= min_chars and docs[k] >= min_docs:
            gone |= found
    out = {}
    for doc_id, text in data:
        parts = (text or "").split("\n")
        out[doc_id, text] = [None if (doc_id, text, pos) in gone else p for pos, p in enumerate(parts)]
    return out, gone, key


def rows(seed=3):
    rng = random.Random(seed)
    pool = [f"line {i}" for i in range(40)] + ["", " ", "\t", "The Common Line", "  the common line ", "ÄRGER", "ärger", "Ärger\r"]
    data = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 12)))) for i in range(150)]
    data += [(i, "the common line\n" * 3 + f"own {i}") for i in range(200, 420)]
    data += [(7, data[7][1])] * 12 + [(None, "null id\nline 1"), (None, "null id\nline 1"), (None, None), (9, None), (9, "")]
    data += [(900, "\n".join(f"line {i % 50}" for i in range(30_000)))]
    return data


def bits(row):
    return np.unpackbits(np.frombuffer(zlib.decompress(row["keep"]), np.uint8))[: row["n_lines"]]


@pytest.mark.parametrize("parts", [1, 25])
@pytest.mark.parametrize("min_docs,min_chars", [(10, 1), (2, 3)])
def test_common_lines_go(spark, parts, min_docs, min_chars):
    data = rows()
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(data, "doc_id long, text string")
        got = lines.apply_bitmaps(frame, lines.keep_bitmaps(frame, min_docs, min_chars), ["doc_id", "text"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, _, _ = plain(data, min_docs, min_chars)
    assert len(got) == len(data)
    for r in got:
        left = want[r["doc_id"], r["text"]]
        assert r["kept"] == "\n".join(p for p in left if p is not None)
        assert (r["n_lines"], r["n_dropped"]) == (len(left), left.count(None))


@pytest.mark.parametrize("width", [1, 25])
@pytest.mark.parametrize("min_docs", [1, 5])
def test_first_occurrences_stay(spark, width, min_docs):
    data = rows(8)
    spark.conf.set("spark.sql.shuffle.partitions", width)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(data, "doc_id long, text string").withColumn("h", F.xxhash64("text"))
        got = lines.keep_bitmaps(frame, min_docs, 1, keep_first=True).collect()
        hashes = {(r["doc_id"], r["text"]): r["h"] for r in frame.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    _, gone, key = plain(data, min_docs, 1)
    order = lambda g: (g[0] is not None, g[0] or 0, hashes[g[0], g[1]], g[2])
    first, parts = {}, {text: (text or "").split("\n") for _, text in data}
    for g in sorted(gone, key=order):
        first.setdefault(key(parts[g[1]][g[2]]), g)
    want = {(g[0], hashes[g[0], g[1]], g[2]) for g in gone - set(first.values())}
    assert {(r["doc_id"], r["text_hash"], int(p)) for r in got for p in np.flatnonzero(bits(r) == 0)} == want


def test_line_cases(spark):
    docs = documents(spark)
    got = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs, 2, 1), ["doc_id", "text", "h", "key", "n"])
    assert got.columns == ["doc_id", "text", "h", "key", "n", "n_lines", "n_dropped", "kept"]
    left = {r["doc_id"]: r for r in got.collect()}
    assert left[1]["kept"] == "" and left[2]["n_dropped"] == 1 and left[5]["n_lines"] == 1 and left[6]["kept"] == ""
    assert left[10]["kept"] == long_text() and left[13]["kept"].endswith("\nrest")
    assert lines.apply_bitmaps(empty(spark), lines.keep_bitmaps(empty(spark)), ["doc_id"]).count() == 0
