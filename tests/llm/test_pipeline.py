import re
from collections import Counter

import corpus_pipeline as pipeline
from cases import documents, empty, rows
from tidelog.llm import bpe, jaccard, language, mixing, pii


def test_stages_on_awkward_rows(spark):
    docs = documents(spark)
    kept = pipeline.identify(spark, docs, "")
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert not {5, 6, 7, 14} & ids.keys() and ids[2] == 2 and ids[None] == 1
    alone = pipeline.deduplicate(spark, docs, "")
    assert alone.columns == docs.columns
    left = Counter(r["doc_id"] for r in alone.collect())
    assert left[1] == 1 and not {2, 3, 4, 9} & left.keys() and left[8] == 1 and left[None] == 2 and left[5] == 1
    hidden = {r["doc_id"]: r for r in pipeline.mask(spark, docs, "").collect()}
    assert hidden[11]["text"] == "mail <EMAIL> or <PHONE>" and hidden[11]["n_chars"] == 23
    assert sum(r[0] is not None for r in rows()) <= pipeline.mask(spark, docs, "").count() == len(rows())
    mixed = pipeline.mix(spark, docs, "")
    assert mixed.columns == docs.columns
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"], r["size"]] += r["times"]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], size(r["text"])) for r in mixed.collect()) == +want
    ids = {r["doc_id"]: r for r in pipeline.tokenise(spark, docs, "").collect()}
    made = bpe.loaded(bpe.vocabulary())
    assert all(ids[i]["ids"] == made.encode([t or ""])[0].tolist() for i, t, *_ in rows() if i is not None)


def test_stages_on_no_rows(spark):
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty(spark), "").count() == 0


def test_shared_and_missing_ids(spark):
    text = lambda c, n=60: " ".join(f"{c}{i}" for i in range(n))
    near = lambda c: text(c).replace(f"{c}59", "x")
    data = [
        (1, text("a"), "en", "b"), (1, text("a"), "en", "a"), (7, near("a"), "en", "a"), (7, text("b"), "en", "a"),
        (7, text("c"), "en", "a"), (9, near("c"), "en", "a"), (None, near("b"), "en", "a"), (None, text("d"), "en", "a"),
        (None, text("d"), "en", "a"), (None, near("d"), "en", "a"), (8, "", "en", "a"), (8, " ", "en", "a"),
    ]
    got = [(r["doc_id"], r["text"], r["source"]) for r in pipeline.deduplicate(spark, documents(spark, data), "").collect()]
    alone = [g for g in got if g[0] is None]
    assert len(alone) == 1 and alone[0][1] in (text("d"), near("d"))
    assert sorted(g for g in got if g[0]) == sorted([(1, text("a"), "a"), (7, text("b"), "a"), (7, text("c"), "a"), (8, "", "a"), (8, " ", "a")])
