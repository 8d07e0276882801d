"""Fill-in-middle against a plain version over code points."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import documents, empty, long_text, rows
from tidelog.llm import middle

MARKED = ["a <P> b", "x<S>", "<M>", "<", "<P", "P>", "<<S", "S>>M"]


def plain(doc_id, text):
    text = text or ""
    found = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(found) + 1), h2 % (len(found) + 1)))
    p, m, s = "".join(found[:a]), "".join(found[a:b]), "".join(found[b:])
    if not text or any(x in text for x in middle.MARKS) or h3 % 100 >= 90:
        return len(found), "plain", None, None, text
    if h4 % 100 < 20:
        return len(found), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(found), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="abZ 1\n<>PSMé日👩́\r", max_size=25), min_size=1, max_size=6))
def test_slices_of_texts(texts):
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    made = middle._transform(
        np.frombuffer(b"".join(raw), np.uint8), offsets, [f"1:{i}" for i in range(len(texts))], middle.CUT, middle.SUFFIX_FIRST,
        [m.encode() for m in middle.MARKS],
    )
    assert [tuple(r.values()) for r in made.to_pylist()] == [plain(i, t) for i, t in enumerate(texts)]


@given(st.text(max_size=60))
def test_places_in_points_and_bytes(text):
    index = middle.Excess(np.frombuffer(text.encode(), np.uint8))
    points = np.arange(len(text) + 1)
    at = np.array([len(text[:i].encode()) for i in points])
    assert index.to_bytes(points).tolist() == at.tolist()
    assert index.to_points(at).tolist() == points.tolist()


def test_documents(spark):
    data = rows() + [(100 + i, t, "en", "a") for i, t in enumerate(MARKED * 5)] + [(10_001 + i, long_text(300) + "é日👩" * i, "en", "a") for i in range(60)]
    frame = documents(spark, data)
    made = middle.fill_in_middle(frame)
    got = made.withColumn("back", middle.restore(F.col("output"), F.col("form"))).collect()
    want = sorted(((i, *plain(i, t), t or "") for i, t, *_ in data), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert middle.fill_in_middle(empty(spark)).count() == 0


def test_a_text_longer_than_a_slice(spark):
    text = "é word 日本 " * 600_000
    frame = spark.createDataFrame([(5, "short"), (6, text), (7, "after it")], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in middle.fill_in_middle(frame).collect()}
    assert got == {i: plain(i, t) for i, t in ((5, "short"), (6, text), (7, "after it"))}
