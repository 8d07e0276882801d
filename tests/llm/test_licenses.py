"""Licence hits belong to a row's own text."""

from cases import documents, empty

from tidelog.llm import licenses


def test_rows_that_share_an_id_keep_their_own_hits(spark):
    long_one = "\n".join(["plain words without any terms"] * 20_000) + "\n\n" + licenses.MIT
    data = [
        (1, "Released under the MIT license!", "en", "a"), (1, "prose of the house", "en", "a"), (1, licenses.ISC, "en", "b"),
        (None, licenses.MIT, "en", "a"), (None, "prose, no terms", "en", "a"), (None, None, "en", "a"),
        (2, licenses.MIT, "en", "a"), (2, licenses.MIT, "en", "a"), (3, long_one, "en", "a"),
    ]
    out = licenses.scan(documents(spark, data), licenses.digests(spark))
    got = sorted((r["doc_id"] or 0, r["licenses"], r["whole"]) for r in out.collect())
    assert got == [
        (0, "", False), (0, "", False), (0, "MIT", True), (1, "", False), (1, "ISC", True), (1, "MIT", True),
        (2, "MIT", True), (2, "MIT", True), (3, "MIT", False),
    ]
    assert licenses.scan(empty(spark), licenses.digests(spark)).count() == 0
